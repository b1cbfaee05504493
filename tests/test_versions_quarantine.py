"""K3 by version and by scope, rows set aside, and the notes of unfinished incremental runs."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import SF_SMALL, d, ts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forgelake import specs
from forgelake.plans import checks, pipeline
from forgelake.plans.pipeline import Unfinished, Warehouse, run_assets, staging_frames, write_staging
from forgelake.operators import staging as stg
from forgelake.session import scratch_path
from forgelake.sinks import parquet as sink
from forgelake.sources import fixture
from forgelake.sources.tables import read_table

EVENTS = specs.BRONZE_EVENTS


def _events(spark, rows):
    """(event_id, day of January 2024 or None, repo)"""
    full = []
    for key, day, repo in rows:
        at = None if day is None else dt.datetime(2024, 1, day, 12)
        full.append((key, "WatchEvent", at, at and at.date(), at and at.month, at and at.year, repo, "alice"))
    return spark.createDataFrame(full, EVENTS.schema)


def _rows(spark, path):
    return sorted(((r.event_id, r.date and r.date.day, r.repo_name) for r in read_table(spark, path, EVENTS).collect()), key=repr)


def _folders(path):
    return {n for n in os.listdir(path.removeprefix("file:")) if "=" in n}


def test_older_version_does_not_come_back(spark, tmp_table):
    path = tmp_table()
    january = _events(spark, [("1", 3, "o/a"), ("2", 4, "o/a"), (None, 5, "o/a")])
    later = _events(spark, [("1", 20, "o/b"), ("3", 21, "o/b")])
    for source in (january, later):
        sink.merge_into(spark, source, path, EVENTS, sink.UPDATE_LATEST)
    assert _rows(spark, path) == sorted([("1", 20, "o/b"), ("2", 4, "o/a"), ("3", 21, "o/b"), (None, 5, "o/a")], key=repr)
    assert "date=2024-01-03" not in _folders(path)  # emptied
    again = sink.merge_into(spark, january.filter("event_id is not null"), path, EVENTS, sink.UPDATE_LATEST)
    assert again["touched"] == set() and again["seen"] == {(d("2024-01-20"),), (d("2024-01-04"),)}
    assert [r for r in _rows(spark, path) if r[0] == "1"] == [("1", 20, "o/b")]
    # a tie in time is settled by the declared columns (repo_name), whichever comes last
    sink.merge_into(spark, _events(spark, [("3", 21, "o/a")]), path, EVENTS, sink.UPDATE_LATEST)
    sink.merge_into(spark, _events(spark, [("3", 21, "o/c")]), path, EVENTS, sink.UPDATE_LATEST)
    assert [r for r in _rows(spark, path) if r[0] == "3"] == [("3", 21, "o/a")]


def test_latest_needs_a_version_order(spark, tmp_table):
    with pytest.raises(ValueError, match="no version order"):
        sink.merge_into(spark, spark.createDataFrame([], specs.ACTIVITY_BY_DAY.schema), tmp_table(), specs.ACTIVITY_BY_DAY, sink.UPDATE_LATEST)
    with pytest.raises(ValueError, match="scope"):
        sink.merge_into(spark, _events(spark, []), tmp_table(), EVENTS, sink.UPDATE_LATEST, scope=F.lit(True))


row = st.tuples(st.sampled_from(["1", "2", "3", "4"]), st.sampled_from([1, 2, 3, None]), st.sampled_from(["o/a", "o/b", None]))
loads = st.lists(st.lists(row, max_size=5, unique_by=lambda r: r[0]), min_size=1, max_size=3)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(loads=loads)
def test_any_order_of_loads_gives_the_latest_rows(spark, loads):
    """Merged forwards, backwards and with the first load repeated: always the best version of each key."""

    def better(r):  # created_at descending, repo ascending, NULLs last
        return (r[1] is None, -(r[1] or 0), r[2] is None, r[2] or "")

    want = {}
    for key, day, repo in (r for load in loads for r in load):
        r = (key, day, repo)
        want[key] = min(want.get(key, r), r, key=better)
    for order in (loads, loads[::-1], [*loads, loads[0]]):
        path = scratch_path(spark, "versions")
        for load in order:
            sink.merge_into(spark, _events(spark, load), path, EVENTS, sink.UPDATE_LATEST)
        assert _rows(spark, path) == sorted(want.values(), key=repr)


def test_scope_replaces_what_no_longer_arises(spark, tmp_table):
    path = tmp_table()
    sink.merge_into(spark, _events(spark, [("1", 1, "o/a"), ("2", 2, "o/a"), ("3", 3, "o/a"), (None, None, "o/x")]), path, EVENTS)
    scope = F.col("date").between(d("2024-01-01"), d("2024-01-02")) | F.col("date").isNull()
    done = sink.merge_into(spark, _events(spark, [("1", 1, "o/b")]), path, EVENTS, scope=scope, keys_can_move=False)
    assert _rows(spark, path) == [("1", 1, "o/b"), ("3", 3, "o/a")]
    assert done["touched"] == {(d("2024-01-01"),), (d("2024-01-02"),), (None,)}
    assert _folders(path) == {"date=2024-01-01", "date=2024-01-03"}
    sink.merge_into(spark, _events(spark, []), path, EVENTS, scope=F.col("date") == d("2024-01-03"), keys_can_move=False)
    assert _rows(spark, path) == [("1", 1, "o/b")]


def test_scope_of_an_unpartitioned_table(spark, tmp_table):
    spec, path = specs.REPO_HEALTH_SCORECARD, tmp_table()
    line = lambda repo, m, n: (repo, 2024, m, m and d(f"2024-{m:02d}-01"), n, 1, 1, 0, 0, None, 0, 1.0)
    frame = lambda *rows: spark.createDataFrame(list(rows), spec.schema)
    sink.merge_into(spark, frame(line("a", 1, 5), line("b", 1, 1), line("a", 2, 2), line("u", None, 9)), path, spec)
    sink.merge_into(spark, frame(line("a", 1, 9)), path, spec, scope=(F.col("month") == 1) | F.col("month").isNull())
    got = {(r.repo_name, r.month): r.total_events for r in read_table(spark, path, spec).collect()}
    assert got == {("a", 1): 9, ("a", 2): 2}


def test_commit_by_renames_is_repeatable(spark, tmp_table, monkeypatch):
    """A commit that breaks off after some partitions is finished by the next merge."""
    path = tmp_table()
    sink.merge_into(spark, _events(spark, [(str(i), i, "o/a") for i in range(1, 6)]), path, EVENTS)
    real, calls = sink._rename, []

    def breaks(spark_, src, dst):
        if "/_merge/rows/" in src:
            calls.append(src)
            if len(calls) == 3:
                raise OSError("gone")
        return real(spark_, src, dst)

    monkeypatch.setattr(sink, "_rename", breaks)
    with pytest.raises(OSError, match="gone"):
        sink.merge_into(spark, _events(spark, [(str(i), i, "o/b") for i in range(1, 6)]), path, EVENTS)
    monkeypatch.setattr(sink, "_rename", real)
    sink.merge_into(spark, _events(spark, [("9", 9, "o/b")]), path, EVENTS)
    assert _rows(spark, path) == [(str(i), i, "o/b") for i in (1, 2, 3, 4, 5, 9)]


def test_commit_by_rewrite_where_renames_are_no_single_step(spark, tmp_table, monkeypatch):
    monkeypatch.setattr(sink, "RENAMING", ())
    path = tmp_table()
    sink.merge_into(spark, _events(spark, [("1", 1, "o/a"), ("2", 2, "o/a")]), path, EVENTS)
    sink.merge_into(spark, _events(spark, [("1", 3, "o/b")]), path, EVENTS)
    assert _rows(spark, path) == [("1", 3, "o/b"), ("2", 2, "o/a")]


# --- months that share ids ---------------------------------------------------------------------


def _load(spark, wh, n):
    raw = fixture.overlapping_month_of(fixture.read_fixture_raw(spark, SF_SMALL), n)
    frames = staging_frames(stg.with_event_dates(raw))
    frames["staging_productivity"] = fixture.with_replayed_pull_requests(frames["staging_productivity"])
    del frames["bot_events"]
    write_staging(wh, frames, source_month=202400 + n)
    return 202400 + n


def _tables(wh, names):
    return {n: sorted(map(repr, wh.read(n).select(*specs.SPECS[n].columns).collect())) for n in names}


TABLES = ["bronze_events", "bronze_commits", "bronze_productivity", "silver_developer_activity", "developer_productivity_monthly"]


def test_overlapping_months_equal_a_rebuild_in_any_order(spark):
    """Months 1, 2; then 1 again; and broken off between bronze and silver: all equal one run over both."""
    options = {"targets": ["developer_productivity_monthly"], "check": False}
    full, wh = (Warehouse(spark, scratch_path(spark, n)) for n in ("wh-full", "wh"))
    for n in (1, 2):
        _load(spark, full, n)
    run_assets(spark, full, **options)
    want = _tables(full, TABLES)
    run_assets(spark, wh, source_month=_load(spark, wh, 1), replace_scope=True, **options)
    second = _load(spark, wh, 2)
    # the run ends after bronze: silver still lacks the dates that bronze rows have left
    run_assets(spark, wh, source_month=second, targets=["bronze_events"], check=False)
    assert _tables(wh, TABLES) != want and Unfinished(wh).events() is not None
    run_assets(spark, wh, source_month=second, replace_scope=True, **options)
    assert _tables(wh, TABLES) == want
    run_assets(spark, wh, source_month=_load(spark, wh, 1), replace_scope=True, **options)
    assert _tables(wh, TABLES) == want


def test_notes_go_when_every_asset_is_built(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh-notes"))
    for n in (1, 2):
        month = _load(spark, wh, n)
        run_assets(spark, wh, source_month=month, targets=["bronze_events"], check=False)
    notes = Unfinished(wh)
    assert notes.dates("bronze_events") and notes.events() is not None
    run_assets(spark, wh, source_month=month, replace_scope=True, quarantine=True)
    assert not sink.path_exists(spark, notes.root) and notes.dates("bronze_events") == set()


# --- rows set aside ---------------------------------------------------------------------------


def test_quarantine_keeps_bad_rows_out_of_the_table(spark, tmp_table):
    spec, path, folder = specs.BRONZE_PRODUCTIVITY, tmp_table(), tmp_table("aside")
    at = ts("2024-01-01 10:00:00")
    line = lambda key, day, lines: (key, at, day, 1, 2024, "o/r", "a", lines, 2, 3, "opened", False)
    rows = [line("1", at.date(), 5), line("2", None, 5), line("3", at.date(), -1), line(None, None, -1)]
    q = sink.Quarantine(checks.violations(spec), f"{folder}/batch=1")
    for _ in range(2):  # a first load, then a merge: the batch is replaced, not added to
        done = sink.merge_into(spark, spark.createDataFrame(rows, spec.schema), path, spec, quarantine=q)
        assert done["set_aside"] == 3
        assert [r.event_id for r in read_table(spark, path, spec).collect()] == ["1"]
        bad = {r.event_id: r.violations for r in spark.read.parquet(folder).collect()}
        assert bad == {
            "2": ["not_null:date"],
            "3": ["not_negative:lines_added"],
            None: ["not_null:event_id", "not_null:date", "not_negative:lines_added"],
        }
    done = sink.merge_into(spark, spark.createDataFrame(rows[:1], spec.schema), path, spec, quarantine=q)
    assert done["set_aside"] == 0 and not sink.path_exists(spark, f"{folder}/batch=1")
    none = sink.merge_into(spark, spark.createDataFrame(rows[1:], spec.schema), tmp_table("new"), spec, quarantine=q)
    assert none["set_aside"] == 3 and none["first_load"]


def test_tags_are_as_many_as_the_failed_rows(spark, tmp_table):
    spec = EVENTS
    rows = [("1", 1, "o/a")] * 3 + [("1", 2, "o/a"), ("2", 1, "o/a"), (None, 1, "o/a"), (None, 1, "o/a"), (None, 2, None), ("3", 1, None)]
    path = tmp_table()
    _events(spark, rows).write.parquet(path)
    df = spark.read.schema(EVENTS.schema).parquet(path)
    tagged = checks.tagged(df, spec)
    assert tagged.count() == len(rows) and tagged.columns == [*df.columns, checks.VIOLATIONS]
    assert tagged.drop(checks.VIOLATIONS).exceptAll(df).count() == 0
    got = {r.tag: r["count"] for r in tagged.select(F.explode(checks.VIOLATIONS).alias("tag")).groupBy("tag").count().collect()}
    want = {f"{r.check}:{r.column}": r.failed_rows for r in checks.run_checks(df, spec).collect() if r.failed_rows}
    assert got == want == {"not_null:event_id": 3, "unique:event_id": 3, "unique_key:event_id": 5}


def test_run_over_dirty_input_goes_on(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh-dirty"))
    frames = staging_frames(stg.with_event_dates(fixture.dirty(fixture.read_fixture_raw(spark, SF_SMALL))))
    del frames["bot_events"]
    write_staging(wh, frames)
    with pytest.raises(checks.QualityCheckError):
        run_assets(spark, Warehouse(spark, wh.root), targets=["bronze_events"])
    wh2 = Warehouse(spark, scratch_path(spark, "wh-dirty2"))
    write_staging(wh2, frames)
    report = run_assets(spark, wh2, quarantine=True)
    assert report.failures == [] and report.set_aside["bronze_commits"] > 0
    for name, n in report.set_aside.items():
        rows = wh2.set_aside(name)
        assert (0 if rows is None else rows.count()) == n
    assert wh2.quality_report().filter("failed_rows > 0").count() == 0
    assert pipeline.EVENTS in report.set_aside


def test_version_order_of_two_rows(spark):
    """the comparison of two versions is the declared order, NULLs included."""
    rows = [(None, 4, "o/a"), ("1", None, None), ("1", None, "o/a"), ("1", 4, "o/b"), ("1", 4, "o/a"), ("1", 4, None), ("1", 5, None)]
    both = _events(spark, rows).drop("event_id", "month", "year")
    held = both.select(*(F.col(c).alias(f"{sink._HELD}_{c}") for c in both.columns))
    pairs = both.crossJoin(held).withColumn("before", sink._comes_before(EVENTS)).collect()

    def place(r, prefix=""):
        at, tie = r[f"{prefix}created_at"], r[f"{prefix}repo_name"]
        return (at is None, -at.timestamp() if at else 0, tie is None, tie or "")

    assert len(pairs) == len(rows) ** 2
    assert all(r["before"] == (place(r) < place(r, f"{sink._HELD}_")) for r in pairs)


def test_later_versions_are_found_without_a_sort_of_both_sides(spark, tmp_table, monkeypatch):
    """the target's rows that go are looked up once; a day that keeps a row without an id is not emptied."""
    path = tmp_table()
    sink.merge_into(spark, _events(spark, [("1", 3, "o/a"), (None, 3, "o/a"), ("2", 4, "o/a")]), path, EVENTS, sink.UPDATE_LATEST)
    places = []
    counted = sink._counted
    monkeypatch.setattr(sink, "_counted", lambda df, parts: places.append(counted(df, parts)) or places[-1])
    done = sink.merge_into(spark, _events(spark, [("1", 20, "o/b"), ("2", 21, "o/b")]), path, EVENTS, sink.UPDATE_LATEST)
    assert done["emptied"] == 1 and "date=2024-01-04" not in _folders(path)
    assert _rows(spark, path) == sorted([("1", 20, "o/b"), (None, 3, "o/a"), ("2", 21, "o/b")], key=repr)
    assert places == [{(d("2024-01-03"),): 1, (d("2024-01-04"),): 1}, {(d("2024-01-03"),): 2, (d("2024-01-04"),): 1}]
