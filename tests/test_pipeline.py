"""End-to-end runs on the driver fixture: counts, invariants, idempotence, lookback."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from forgelake import specs
from forgelake.plans.pipeline import Lookback, Warehouse, run_assets, run_month, stage_raw, write_staging
from forgelake.session import scratch_path, scratch_root
from forgelake.sources import fixture
from forgelake.sources.raw import read_raw

# Expected sizes at sf0.001 (from the fixture specification)
EXPECTED = {
    "bronze_events": 701,
    "bronze_commits": 111,
    "bronze_productivity": 163,
    "silver_developer_activity": 678,
    "silver_repo_summary": 460,
    "repo_health_scorecard": 25,
    "developer_productivity_monthly": 126,
    "commit_stats_by_day": 110,
    "activity_by_day": 150,
}


def _snapshot(wh, name):
    spec = specs.SPECS[name]
    return sorted(tuple(r) for r in wh.read(name).select(*spec.columns).collect())


def test_layer_sizes(warehouse):
    for name, n in EXPECTED.items():
        assert warehouse.read(name).count() == n, name


def test_run_report_counts_rows_without_extra_jobs(spark):
    from forgelake.plans.pipeline import fixture_staging

    wh = Warehouse(spark, scratch_path(spark, "warehouse-rows"))
    write_staging(wh, fixture_staging(spark, SF_SMALL))
    report = run_assets(spark, wh, targets=["activity_by_day"], check=False)
    assert report.rows["activity_by_day"] == EXPECTED["activity_by_day"]
    assert report.rows["bronze_events"] == EXPECTED["bronze_events"]


def test_warehouse_quality_report_is_clean(warehouse):
    report = warehouse.quality_report()
    assert report.count() == 72
    assert report.filter(F.col("failed_rows") > 0).count() == 0


def test_staging_split_accounts_for_every_raw_row(spark, warehouse):
    raw = fixture.read_fixture_raw(spark, SF_SMALL)
    null_login = raw.filter(F.col("actor.login").isNull()).count()
    assert warehouse.read("staging_events").count() + spark.read.parquet(warehouse.path("bot_events")).count() + null_login == raw.count()


def test_invariants(warehouse):
    silver_rows = warehouse.read("silver_developer_activity").count()
    total = warehouse.read("activity_by_day").agg(F.sum("total_events")).first()[0]
    assert total == silver_rows
    monthly = warehouse.read("developer_productivity_monthly")
    assert monthly.filter(F.col("merged_prs") > F.col("total_prs")).count() == 0
    card = warehouse.read("repo_health_scorecard")
    assert card.filter(F.col("merged_prs") > F.col("total_prs")).count() == 0
    stamps = warehouse.read("silver_repo_summary").select("ingested_at").distinct().count()
    assert stamps == 1  # one load time per run


def test_rerun_is_idempotent(spark, warehouse):
    before = {n: _snapshot(warehouse, n) for n in EXPECTED}
    run_assets(spark, warehouse)
    for n in EXPECTED:
        assert _snapshot(warehouse, n) == before[n], n


def test_lookback_run_keeps_tables_whole(spark, warehouse):
    before = {n: _snapshot(warehouse, n) for n in EXPECTED}
    run_assets(spark, warehouse, lookback=Lookback(days=3, as_of=dt.date(2024, 1, 30)))
    for n in EXPECTED:
        assert _snapshot(warehouse, n) == before[n], n


def test_json_archive_path_matches_direct_mapping(spark, warehouse):
    path = scratch_path(spark, "raw-json")
    fixture.to_archive_json(fixture.read_fixture_raw(spark, SF_SMALL)).write.option("compression", "gzip").json(path)
    frames = stage_raw(spark, read_raw(spark, f"{path}/*.json.gz"))
    direct = warehouse.read("staging_events").select(*specs.STAGING_EVENTS.columns)
    via_json = frames["staging_events"]
    assert via_json.exceptAll(direct).count() == 0 and direct.exceptAll(via_json).count() == 0


def test_monthly_job_from_archive_json(spark, warehouse):
    """E1 + E2 from gzip JSON in the archive's month layout equals the direct build."""
    base = scratch_path(spark, "archive")
    raw = fixture.to_archive_json(fixture.read_fixture_raw(spark, SF_SMALL))
    raw.write.option("compression", "gzip").json(f"{base}/2024-01")
    wh = Warehouse(spark, scratch_path(spark, "warehouse-json"))
    report = run_month(spark, base, 2024, 1, wh)
    assert report.failures == []
    # the direct build also replays PR rows, so compare the layers the replay does not reach
    for name in ("bronze_events", "bronze_commits"):
        assert _snapshot(wh, name) == _snapshot(warehouse, name), name
    again = run_month(spark, base, 2024, 1, wh, incremental=True)
    assert again.failures == []
    assert _snapshot(wh, "bronze_events") == _snapshot(warehouse, "bronze_events")


def test_results_do_not_depend_on_session_time_zone(spark):
    from forgelake.plans.assets import Layers
    from forgelake.plans.pipeline import fixture_staging

    def build():
        layers = Layers(spark, fixture_staging(spark, SF_SMALL), materialize=())
        return {n: sorted(tuple(r) for r in layers[n].collect()) for n in ("silver_repo_summary", "activity_by_day")}

    utc = build()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert build() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_observed_checks_fail_the_run_on_bad_rows(spark):
    from forgelake.plans import checks
    from forgelake.plans.pipeline import fixture_staging
    from forgelake.sinks import parquet as sink

    wh = Warehouse(spark, scratch_path(spark, "warehouse-bad"))
    frames = fixture_staging(spark, SF_SMALL)
    write_staging(wh, frames)
    # one PR row of a known event, replayed with a negative line count and a fresh developer
    bad = frames["staging_productivity"].limit(1).withColumns(
        {"lines_added": F.lit(-7).cast("bigint"), "developer_login": F.lit("zz-new-dev")}
    )
    sink.append(bad, wh.path("staging_productivity"), specs.STAGING_PRODUCTIVITY)
    with pytest.raises(checks.QualityCheckError):
        run_assets(spark, wh, targets=["bronze_productivity"])
    report = run_assets(spark, Warehouse(spark, wh.root), targets=["silver_developer_activity"], strict=False)
    assert ("bronze_productivity", "lines_added", "not_negative", 1) in report.failures
    assert ("silver_developer_activity", "lines_added", "not_negative", 1) in report.failures


def _write_months(spark, base, months=(1, 2)):
    raw = fixture.read_fixture_raw(spark, SF_SMALL)
    for n in months:
        rows = fixture.to_archive_json(fixture.month_of(raw, n))
        rows.write.option("compression", "gzip").json(f"{base}/2024-{n:02d}")


def test_months_incremental_equal_full_and_leave_no_scratch(spark):
    """Stray and undated rows reach bronze and silver; re-running month 1 changes nothing."""
    base = scratch_path(spark, "archive-months")
    _write_months(spark, base)
    inc, full = (Warehouse(spark, scratch_path(spark, n)) for n in ("wh-inc", "wh-full"))
    names = ["bronze_events", "bronze_commits", "bronze_productivity", "silver_developer_activity"]
    options = {"targets": names, "check": False}
    root = scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    for n in (1, 2):
        run_month(spark, base, 2024, n, inc, **options)
    run_month(spark, base, 2024, 1, full, incremental=False, targets=["bronze_events"], check=False)
    run_month(spark, base, 2024, 2, full, incremental=False, **options)
    own = {wh.root.removeprefix("file:").removeprefix(root).split("/")[1] for wh in (inc, full)}
    assert set(os.listdir(root)) - own == before
    key = repr  # rows hold NULLs
    want = {n: sorted(map(key, full.read(n).select(*specs.SPECS[n].columns).collect())) for n in names}
    for n in names:
        assert sorted(map(key, inc.read(n).select(*specs.SPECS[n].columns).collect())) == want[n], n
    assert inc.read("bronze_events").filter("date is null").count() > 0
    run_month(spark, base, 2024, 1, inc, **options)
    for n in names:
        assert sorted(map(key, inc.read(n).select(*specs.SPECS[n].columns).collect())) == want[n], n


def test_lookback_prunes_year_month_layout(spark, warehouse):
    df = Lookback(days=3, as_of=dt.date(2024, 1, 30)).daily(warehouse.read("staging_productivity"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :].split("], ")[0]
    assert "year" in filters and "month" in filters
