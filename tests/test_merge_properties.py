"""Keyed merges against a plain Python model, on random sequences of sources.

Sources draw keys from a small alphabet plus NULL and dates from three days,
so keys repeat across runs, move between partitions and NULL keys recur.
"""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from forgelake import specs
from forgelake.session import scratch_path
from forgelake.sinks import parquet as sink
from forgelake.sources.tables import read_table

SPEC = specs.BRONZE_EVENTS
DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]

row = st.tuples(
    st.sampled_from(["1", "2", "3", "4", "5", None]),  # event_id (key)
    st.sampled_from(DAYS),  # date (partition)
    st.sampled_from(["o/a", "o/b"]),  # repo_name (payload)
)


def _unique_keys(rows):
    seen, out = set(), []
    for key, day, repo in rows:
        if key is None or key not in seen:
            out.append((key, day, repo))
            if key is not None:
                seen.add(key)
    return out


sources = st.lists(st.lists(row, min_size=0, max_size=6).map(_unique_keys), min_size=1, max_size=3)


def _model(runs, upsert: bool):
    table: list[tuple] = []
    for src in runs:
        src_keys = {k for k, _, _ in src if k is not None}
        if upsert:
            table = [r for r in table if r[0] is None or r[0] not in src_keys] + list(src)
        else:
            have = {r[0] for r in table if r[0] is not None}
            table = table + [r for r in src if r[0] is None or r[0] not in have]
    return sorted(table, key=repr)


def _frame(spark, rows):
    full = [
        (k, "WatchEvent", dt.datetime.combine(day, dt.time(12)), day, day.month, day.year, repo, "alice")
        for k, day, repo in rows
    ]
    return spark.createDataFrame(full, SPEC.schema)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(runs=sources, upsert=st.booleans())
def test_merge_matches_model(spark, runs, upsert):
    path = scratch_path(spark, "prop")
    for src in runs:
        sink.merge_into(spark, _frame(spark, src), path, SPEC, sink.UPDATE_ALL if upsert else sink.INSERT_ONLY)
    got = sorted(
        ((r.event_id, r.date, r.repo_name) for r in read_table(spark, path, SPEC).collect()), key=repr
    )
    assert got == _model(runs, upsert)


dedup_rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),  # key
        st.sampled_from([1, 2, None]),  # event time (hour)
        st.sampled_from(["x", "y", None]),  # first tie-breaker
        st.sampled_from(["p", "q", None]),  # second tie-breaker
    ),
    min_size=1,
    max_size=12,
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=dedup_rows)
def test_latest_per_key_matches_model(spark, rows):
    from pyspark.sql import functions as F

    from forgelake.operators.dedup import asc, latest_per_key

    df = spark.createDataFrame(rows, "k string, t int, a string, b string")
    got = sorted(
        (tuple(r) for r in latest_per_key(df, ["k"], [F.col("t").desc_nulls_last(), *asc("a", "b")]).collect()),
        key=repr,
    )

    def order(r):  # time descending, NULLs last; tie-breakers ascending, NULLs last
        _, t, a, b = r
        return (t is None, -(t or 0), a is None, a or "", b is None, b or "")

    best: dict = {}
    for r in rows:
        if r[0] not in best or order(r) < order(best[r[0]]):
            best[r[0]] = r
    assert got == sorted(best.values(), key=repr)
