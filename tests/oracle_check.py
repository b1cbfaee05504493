"""Run registered Spark queries against their DuckDB oracle SQL and compare.

Usage: python tests/oracle_check.py [sf_dir] [query ...]

Compares row count, column names and the sorted multiset of rows (doubles
rounded to 9 places, dates/times as ISO text).  Exit status 1 on a mismatch.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, REPO)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{round(v, 9):.9f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def canon(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return cols, out


SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def type_mismatches(df, rel) -> list[str]:
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return [f"{c}: {spark_types[c]} vs {duck_types.get(c)}" for c in spark_types if spark_types[c] != duck_types.get(c)]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict[str, str]:
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.perf_counter()
        df = qs[name](spark, sf_dir)
        s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
        t1 = time.perf_counter()
        if name not in sqls:
            results[name] = f"rows-only {len(s_rows)}"
        else:
            rel = con.sql(sqls[name])
            o_cols, o_rows = canon(rel.columns, rel.fetchall())
            types = type_mismatches(df, rel)
            if s_cols != o_cols:
                results[name] = f"COLUMNS spark={s_cols} oracle={o_cols}"
            elif len(s_rows) != len(o_rows):
                results[name] = f"ROWCOUNT spark={len(s_rows)} oracle={len(o_rows)}"
            elif s_rows != o_rows:
                diff = next(i for i, (a, b) in enumerate(zip(s_rows, o_rows)) if a != b)
                results[name] = f"VALUES first diff spark={s_rows[diff]} oracle={o_rows[diff]}"
            elif types:
                results[name] = f"TYPES {types}"
            else:
                results[name] = f"ok {len(s_rows)}"
        if verbose:
            print(f"{name:32s} {results[name]:40.200s} {t1 - t0:6.2f}s", flush=True)
    return results


def main() -> int:
    from forgelake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf_dir, names)
    bad = {k: v for k, v in res.items() if not (v.startswith("ok") or v.startswith("rows-only"))}
    print(f"{len(res) - len(bad)}/{len(res)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
