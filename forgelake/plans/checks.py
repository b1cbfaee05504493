"""Declared quality checks (not_null, not_negative, unique, unique_key).

``run_checks`` evaluates every per-row check of a table in ONE aggregate
pass and each key check in one grouped pass (the only way to count key
repeats is a shuffle on the key; partial aggregation keeps it one row per key
per map task).  The report has one row per check: table, column, check,
failed_rows.

In pipeline runs the per-row checks cost no pass at all: they are observed
(``column_metrics``) on the rows a merge writes, and only the key checks
read the table.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.operators.dedup import asc, latest_per_key
from forgelake.specs import NOT_NEGATIVE, NOT_NULL, SPECS, UNIQUE, UNIQUE_KEY, TableSpec

#: Column of row-level tags ``kind:column`` that :func:`tagged` adds.
VIOLATIONS = "violations"
REPORT_DDL = "table string, column string, check string, failed_rows bigint"


class QualityCheckError(RuntimeError):
    pass


def _row(table: str, column: str, check: str, failed) -> F.Column:
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.lit(check).alias("check"),
        failed.cast("bigint").alias("failed_rows"),
    )


def _column_checks(spec: TableSpec) -> list[tuple[str, str, F.Column]]:
    """(column, kind, failing-row count) for the per-row checks of a table."""
    out = []
    for column, kind in spec.checks():
        if kind == NOT_NULL:
            out.append((column, kind, F.count_if(F.col(column).isNull())))
        elif kind == NOT_NEGATIVE:
            # NULL passes: the check is about sign only.
            out.append((column, kind, F.count_if(F.col(column) < 0)))
    return out


def column_metrics(spec: TableSpec) -> list[F.Column]:
    """Per-row checks as aggregate columns, for ``DataFrame.observe`` on the rows being written."""
    return [expr.alias(f"{kind}:{column}") for column, kind, expr in _column_checks(spec)]


def column_failures(spec: TableSpec, observed: dict) -> list[tuple[str, str, str, int]]:
    """Failing per-row checks from observed metric values."""
    out = []
    for column, kind, _ in _column_checks(spec):
        n = observed.get(f"{kind}:{column}") or 0
        if n > 0:
            out.append((spec.name, column, kind, int(n)))
    return out


def violations(spec: TableSpec) -> F.Column:
    """The per-row checks that a row fails, as an array of ``kind:column`` tags (empty: a good row)."""
    failing = []
    for column, kind in spec.checks():
        if kind == NOT_NULL:
            failing.append(F.when(F.col(column).isNull(), f"{kind}:{column}"))
        elif kind == NOT_NEGATIVE:
            failing.append(F.when(F.col(column) < 0, f"{kind}:{column}"))
    if not failing:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*failing))


def tagged(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` (a written table) with :data:`VIOLATIONS`, repeats of a key or a unique column included.

    Tags of a kind and column are as many as the check's failed rows: of the rows that share a key
    (NULLs are one, but not for ``unique``) the first by all columns is not tagged.  Equal rows are counted
    together, the first row of a key comes from a limited window, and the rest meet it in an
    equi-join that may be split, so a key that holds a third of all rows is never gathered.
    """
    columns, row = df.columns, F.struct(*df.columns)
    rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    every, tags, first_of = rows, [], {}
    for column, kind in spec.checks():
        if kind not in (UNIQUE, UNIQUE_KEY):
            continue
        keys = column.split(",")
        if tuple(keys) not in first_of:
            mark = f"__first_{len(first_of)}"
            named = [F.col(k).alias(f"{mark}_{k}") for k in keys]
            first = latest_per_key(rows.select(*columns), keys, asc(*columns)).select(row.alias(mark), *named)
            on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{mark}_{k}")) for k in keys])
            every = every.join(first, on, "left")
            first_of[tuple(keys)] = mark
        repeat = ~(row.eqNullSafe(F.col(first_of[tuple(keys)])) & (F.col("__nth") == 1))
        if kind == UNIQUE:
            repeat = repeat & F.col(column).isNotNull()
        tags.append(F.when(repeat, f"{kind}:{column}"))
    each = every.withColumn("__nth", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))))
    found = F.concat(violations(spec), F.array_compact(F.array(*tags))) if tags else violations(spec)
    return each.select(*columns, found.alias(VIOLATIONS))


def key_checks(df: DataFrame, spec: TableSpec) -> DataFrame | None:
    """The uniqueness checks (unique, unique_key): one grouped pass per key set."""
    parts = []
    unique_cols = [c for c, k in spec.checks() if k == UNIQUE]
    for column, kind in spec.checks():
        if kind == UNIQUE_KEY:
            # whole key tuple, NULLs grouped together (a NULL key is a repeat too)
            keys = column.split(",")
            counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            repeats = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
            rows = [_row(spec.name, column, kind, repeats)]
            if keys in [[c] for c in unique_cols]:
                # unique(col) on the key column itself: same grouping, NULL group left out
                nn = F.coalesce(F.sum(F.when(F.col(keys[0]).isNotNull(), F.col("n") - 1)), F.lit(0))
                rows.insert(0, _row(spec.name, keys[0], UNIQUE, nn))
            parts.append(counts.agg(F.array(*rows).alias("r")).select(F.inline("r")))
        elif kind == UNIQUE and [column] != list(spec.keys):
            # rows whose non-NULL value already appeared: count(col) - count(distinct col)
            counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            repeats = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
            parts.append(counts.agg(F.array(_row(spec.name, column, kind, repeats)).alias("r")).select(F.inline("r")))
    return reduce(DataFrame.unionByName, parts) if parts else None


def run_checks(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Every declared check of a table as a report: one aggregate pass + the key passes."""
    col = _column_checks(spec)
    parts = []
    if col:
        rows = [_row(spec.name, column, kind, expr) for column, kind, expr in col]
        parts.append(df.agg(F.array(*rows).alias("r")).select(F.inline("r")))
    keyed = key_checks(df, spec)
    if keyed is not None:
        parts.append(keyed)
    return reduce(DataFrame.unionByName, parts)


def quality_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The full report (one row per declared check) over named medallion tables."""
    return reduce(DataFrame.unionByName, [run_checks(df, SPECS[name]) for name, df in tables.items()])


def failed(report: DataFrame) -> list[tuple[str, str, str, int]]:
    """Failing checks; the report is one row per declared check, so collecting it is bounded."""
    return [tuple(r) for r in report.filter(F.col("failed_rows") > 0).collect()]


def enforce(report: DataFrame) -> None:
    bad = failed(report)
    if bad:
        lines = ", ".join(f"{t}.{c} {k}: {n}" for t, c, k, n in bad)
        raise QualityCheckError(f"quality checks failed: {lines}")
