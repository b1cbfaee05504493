"""Parquet sinks (K1-K6), keyed merges (K3) and quality checks (section 2.8)."""

from __future__ import annotations

import os

import pytest
from conftest import d, ts
from pyspark.sql import functions as F

from forgelake import specs
from forgelake.plans import checks
from forgelake.sinks import parquet as sink
from forgelake.sources.tables import read_table


def _bronze_rows(spark, rows):
    return spark.createDataFrame(rows, specs.BRONZE_EVENTS.schema)


def _be(eid, at, repo="o/r", typ="WatchEvent", login="alice"):
    t = ts(at)
    return (eid, typ, t, t.date(), t.month, t.year, repo, login)


def _partitions(path):
    return sorted(n for n in os.listdir(path.replace("file:", "")) if "=" in n)


def _content(spark, path, spec):
    return sorted(tuple(r) for r in read_table(spark, path, spec).select(*spec.columns).collect())


def test_first_merge_creates_table_and_second_is_noop(spark, tmp_table):
    spec, path = specs.BRONZE_EVENTS, tmp_table()
    src = _bronze_rows(spark, [_be("1", "2024-01-01 10:00:00"), _be("2", "2024-01-02 10:00:00")])
    sink.merge_into(spark, src, path, spec)
    first = _content(spark, path, spec)
    sink.merge_into(spark, src, path, spec)
    assert _content(spark, path, spec) == first
    assert _partitions(path) == ["date=2024-01-01", "date=2024-01-02"]


def test_merge_upsert_vs_insert_only(spark, tmp_table):
    spec = specs.BRONZE_EVENTS
    old = _bronze_rows(spark, [_be("1", "2024-01-01 10:00:00", repo="o/old"), _be("2", "2024-01-02 10:00:00")])
    new = _bronze_rows(spark, [_be("1", "2024-01-01 10:00:00", repo="o/new"), _be("3", "2024-01-03 10:00:00")])
    up, ins = tmp_table("up"), tmp_table("ins")
    for path, mode in ((up, sink.UPDATE_ALL), (ins, sink.INSERT_ONLY)):
        sink.merge_into(spark, old, path, spec, mode)
        sink.merge_into(spark, new, path, spec, mode)
    repos_up = {r[0]: r[6] for r in _content(spark, up, spec)}
    repos_ins = {r[0]: r[6] for r in _content(spark, ins, spec)}
    assert repos_up == {"1": "o/new", "2": "o/r", "3": "o/r"}
    assert repos_ins == {"1": "o/old", "2": "o/r", "3": "o/r"}


def test_merge_null_key_is_inserted_again(spark, tmp_table):
    spec, path = specs.BRONZE_EVENTS, tmp_table()
    src = _bronze_rows(spark, [_be(None, "2024-01-01 10:00:00")])
    sink.merge_into(spark, src, path, spec)
    sink.merge_into(spark, src, path, spec)
    assert len(_content(spark, path, spec)) == 2
    report = {(r.column, r.check): r.failed_rows for r in checks.run_checks(read_table(spark, path, spec), spec).collect()}
    assert report[("event_id", "not_null")] == 2
    assert report[("event_id", "unique_key")] == 1  # NULL keys group together for the key check
    assert report[("event_id", "unique")] == 0  # the column check ignores NULLs


def test_merge_key_moving_partition_cleans_old_partition(spark, tmp_table):
    spec, path = specs.BRONZE_EVENTS, tmp_table()
    sink.merge_into(spark, _bronze_rows(spark, [_be("1", "2024-01-01 10:00:00"), _be("2", "2024-01-02 10:00:00")]), path, spec)
    # event 1 is corrected to another day; its old day is left empty and must disappear
    sink.merge_into(spark, _bronze_rows(spark, [_be("1", "2024-01-05 10:00:00")]), path, spec)
    rows = _content(spark, path, spec)
    assert [(r[0], r[3]) for r in rows] == [("1", d("2024-01-05")), ("2", d("2024-01-02"))]
    assert _partitions(path) == ["date=2024-01-02", "date=2024-01-05"]


def test_merge_rejects_duplicate_source_keys(spark, tmp_table):
    spec, path = specs.BRONZE_EVENTS, tmp_table()
    dup = _bronze_rows(spark, [_be("1", "2024-01-01 10:00:00"), _be("1", "2024-01-01 11:00:00")])
    with pytest.raises(sink.DuplicateKeyError):
        sink.merge_into(spark, dup, path, spec)
    assert not sink.path_exists(spark, path)


def test_merge_unpartitioned_monthly_table(spark, tmp_table):
    spec, path = specs.REPO_HEALTH_SCORECARD, tmp_table()
    row = lambda repo, m, ev: (repo, 2024, m, d(f"2024-{m:02d}-01"), ev, 1, 1, 0, 0, None, 0, 1.0)
    sink.merge_into(spark, spark.createDataFrame([row("a", 1, 5), row("b", 1, 1)], spec.schema), path, spec)
    sink.merge_into(spark, spark.createDataFrame([row("a", 1, 9), row("a", 2, 1)], spec.schema), path, spec)
    got = {(r[0], r[2]): r[4] for r in _content(spark, path, spec)}
    assert got == {("a", 1): 9, ("b", 1): 1, ("a", 2): 1}


def test_partition_overwrite_and_append(spark, tmp_table):
    spec = specs.STAGING_EVENTS
    rows = [_be("1", "2024-01-01 10:00:00"), _be("2", "2024-01-02 10:00:00")]
    df = spark.createDataFrame([(r[0], "PushEvent", r[2], r[3], r[4], r[5], r[6], r[7]) for r in rows], spec.schema)
    path = tmp_table()
    sink.overwrite_partitions(df, path, spec)
    sink.overwrite_partitions(df.filter(F.col("event_id") == "2").withColumn("repo_name", F.lit("o/x")), path, spec)
    got = {r[0]: r[6] for r in _content(spark, path, spec)}
    assert got == {"1": "o/r", "2": "o/x"}  # day 1 untouched, day 2 replaced
    app = tmp_table("append")
    sink.append(df, app, spec)
    sink.append(df, app, spec)
    assert len(_content(spark, app, spec)) == 4


def test_ensure_table_creates_typed_empty_table(spark, tmp_table):
    path = tmp_table()
    sink.ensure_table(spark, path, specs.ACTIVITY_BY_DAY)
    empty = read_table(spark, path, specs.ACTIVITY_BY_DAY)
    assert empty.count() == 0 and empty.schema["total_events"].dataType.typeName() == "long"


def test_checks_report_exact_bad_rows(spark):
    spec = specs.BRONZE_PRODUCTIVITY
    rows = [
        ("1", ts("2024-01-01 10:00:00"), d("2024-01-01"), 1, 2024, "o/r", "a", -1, 2, 3, "opened", False),
        ("1", ts("2024-01-01 10:00:00"), d("2024-01-01"), 1, 2024, "o/r", "a", 1, None, 3, "opened", False),
        (None, ts("2024-01-01 10:00:00"), None, 1, 2024, "o/r", "b", 1, 2, -5, "opened", False),
    ]
    report = checks.run_checks(spark.createDataFrame(rows, spec.schema), spec)
    got = {(r.column, r.check): r.failed_rows for r in report.collect()}
    assert got[("event_id", "not_null")] == 1
    assert got[("date", "not_null")] == 1
    assert got[("developer_login", "not_null")] == 0
    assert got[("lines_added", "not_negative")] == 1
    assert got[("lines_deleted", "not_negative")] == 0  # NULL passes
    assert got[("files_changed", "not_negative")] == 1
    assert got[("event_id,developer_login", "unique_key")] == 1
    with pytest.raises(checks.QualityCheckError):
        checks.enforce(report)


def test_declared_check_count():
    declared = [c for s in specs.MEDALLION_TABLES for c in s.checks() if c[1] != specs.UNIQUE_KEY]
    assert len(declared) == 63
    assert sum(k == specs.NOT_NULL for _, k in declared) == 36
    assert sum(k == specs.NOT_NEGATIVE for _, k in declared) == 26


def test_unique_check_fails_on_repeated_value(spark):
    spec = specs.BRONZE_EVENTS
    rows = [_be("1", "2024-01-01 10:00:00"), _be("1", "2024-01-02 10:00:00"), _be(None, "2024-01-01 10:00:00"), _be(None, "2024-01-01 11:00:00")]
    got = {(r.column, r.check): r.failed_rows for r in checks.run_checks(_bronze_rows(spark, rows), spec).collect()}
    assert got[("event_id", "unique")] == 1  # NULLs ignored
    assert got[("event_id", "unique_key")] == 2  # NULL key repeats too
    assert got[("event_id", "not_null")] == 2


def test_written_files_are_clustered(spark, tmp_table):
    import pyarrow.parquet as pq

    spec, path = specs.BRONZE_EVENTS, tmp_table()
    rows = [_be(str(i), f"2024-01-01 {i % 24:02d}:00:00", repo=f"o/r{i % 7}", typ=("PushEvent", "WatchEvent")[i % 2], login=f"u{i % 5}") for i in range(200)]
    sink.write_table(_bronze_rows(spark, rows), path, spec)
    day = os.path.join(path.replace("file:", ""), "date=2024-01-01")
    files = [f for f in os.listdir(day) if f.endswith(".parquet")]
    for f in files:
        t = pq.read_table(os.path.join(day, f), columns=list(spec.cluster_by)).to_pylist()
        keys = [tuple(r[c] for c in spec.cluster_by) for r in t]
        assert keys == sorted(keys)


def test_merge_without_key_moves_reads_only_source_partitions(spark, tmp_table):
    spec, path = specs.BRONZE_EVENTS, tmp_table()
    sink.merge_into(spark, _bronze_rows(spark, [_be("1", "2024-01-01 10:00:00"), _be("2", "2024-01-02 10:00:00")]), path, spec)
    info = sink.merge_into(
        spark, _bronze_rows(spark, [_be("2", "2024-01-02 10:00:00", repo="o/x")]), path, spec, keys_can_move=False
    )
    assert (info["partitions"], info["emptied"]) == (1, 0)
    assert {r[0]: r[6] for r in _content(spark, path, spec)} == {"1": "o/r", "2": "o/x"}


def test_interrupted_swap_is_recovered(spark, tmp_table):
    spec, path = specs.REPO_HEALTH_SCORECARD, tmp_table()
    row = lambda repo, ev: (repo, 2024, 1, d("2024-01-01"), ev, 1, 1, 0, 0, None, 0, 1.0)
    sink.merge_into(spark, spark.createDataFrame([row("a", 1)], spec.schema), path, spec)
    # crash after the new version was written and the old one moved aside, before the final rename
    nxt, prev = sink._versions(path)
    sink.write_table(spark.createDataFrame([row("a", 2)], spec.schema), nxt, spec, "errorifexists")
    sink._rename(spark, path, prev)
    assert not sink.path_exists(spark, path)
    sink.merge_into(spark, spark.createDataFrame([row("b", 3)], spec.schema), path, spec)
    assert {r[0]: r[4] for r in _content(spark, path, spec)} == {"a": 2, "b": 3}
    assert not sink.path_exists(spark, prev) and not sink.path_exists(spark, nxt)
    # crash while the new version was still being written: the old one stays
    sink.write_table(spark.createDataFrame([row("z", 9)], spec.schema), nxt, spec, "errorifexists")
    sink.delete_path(spark, nxt + "/_SUCCESS")
    sink.recover(spark, path)
    assert {r[0] for r in _content(spark, path, spec)} == {"a", "b"}


def test_merge_that_broke_off_is_finished_by_the_next_one(spark, tmp_table, monkeypatch):
    """A touched older partition is lost inside the commit: the copy below the table restores it."""
    spec = specs.BRONZE_EVENTS

    def rows(*items):
        return spark.createDataFrame(
            [(i, "PushEvent", ts(f"{day} 01:00:00"), d(day), 1, 2024, "o/r", who) for i, day, who in items], spec.schema
        )

    path = tmp_table("events")
    sink.merge_into(spark, rows(("1", "2024-01-01", "a"), ("2", "2024-01-01", "b"), ("3", "2024-01-02", "c")), path, spec)
    commit = sink._commit_merge

    def broken(spark_, path_, spec_):
        sink.delete_path(spark_, f"{path_}/date=2024-01-01")  # half of a commit
        raise OSError("lost")

    monkeypatch.setattr(sink, "_commit_merge", broken)
    with pytest.raises(OSError):
        sink.merge_into(spark, rows(("1", "2024-01-03", "x"), ("3", "2024-01-03", "y")), path, spec)
    monkeypatch.setattr(sink, "_commit_merge", commit)
    sink.merge_into(spark, rows(("4", "2024-01-04", "z")), path, spec)
    got = sorted((r.event_id, str(r.date), r.actor_login) for r in sink.read_table(spark, path, spec).collect())
    assert got == [("1", "2024-01-03", "x"), ("2", "2024-01-01", "b"), ("3", "2024-01-03", "y"), ("4", "2024-01-04", "z")]
    assert not sink.path_exists(spark, f"{path}/date=2024-01-02")  # emptied by the moved key
    assert not sink.path_exists(spark, f"{path}/_merge")
