"""

``entry`` runs the flagship query on sf0.001; ``queries`` registers one
callable per operator / table of the survey inventory, each building its
result from the driver's ``events`` table through the whole pipeline;
``oracle_sql`` gives the independent DuckDB SQL for each of them.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


import oracle_sql as oracle  # noqa: E402
from forgelake import specs  # noqa: E402
from forgelake.operators import bronze, gold, reports, silver  # noqa: E402
from forgelake.operators import staging as stg  # noqa: E402
from forgelake.plans import checks  # noqa: E402
from forgelake.plans.assets import ASSETS, Layers  # noqa: E402
from forgelake.plans.distinct_index import DistinctIndex  # noqa: E402
from forgelake.plans.pipeline import (  # noqa: E402
    EventTimes,
    Lookback,
    Warehouse,
    fixture_staging,
    run_assets,
    stage_raw,
    staging_frames,
    write_staging,
)
from forgelake.session import scratch_path  # noqa: E402
from forgelake.sinks import parquet as sink  # noqa: E402
from forgelake.sources import fixture  # noqa: E402
from forgelake.sources.raw import read_raw  # noqa: E402
from forgelake.sources.tables import read_source_month, read_table, since  # noqa: E402


def _left_out(part: str, missing: ModuleNotFoundError) -> None:
    """Say which package the optional part lacks; nothing to say when the part itself is not installed."""
    name = missing.name or ""
    if name != "corpus_pipeline" and not name.startswith("forgelake.llm"):
        warnings.warn(f"{part} left out: no package {name}", stacklevel=2)


try:  # the training-data operators are an optional part: the rest stands without them
    from forgelake.llm import queries as llm
except ModuleNotFoundError as missing:
    _left_out("forgelake.llm", missing)
    llm = None
try:
    import corpus_pipeline
except ModuleNotFoundError as missing:
    _left_out("corpus_pipeline", missing)
    corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"


def _layers(spark: SparkSession, sf_dir: str, materialize="shared") -> Layers:
    return Layers(spark, fixture_staging(spark, sf_dir), materialize=materialize)


def _built_once(build: Callable[[SparkSession, str], Warehouse]) -> Callable[[SparkSession, str], Warehouse]:
    """Warehouses that several queries read are loaded once a session and scale."""
    built: dict[tuple[str, str], Warehouse] = {}

    def get(spark: SparkSession, sf_dir: str) -> Warehouse:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in built:
            built[key] = build(spark, sf_dir)
        return built[key]

    return get


# --- sources ---------------------------------------------------------------------

def q_raw_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write archive-shaped gzip JSON lines, read them back with the explicit schema."""
    path = scratch_path(spark, "raw-json")
    fixture.to_archive_json(fixture.read_fixture_raw(spark, sf_dir)).write.option("compression", "gzip").json(path)
    dated = stg.with_event_dates(read_raw(spark, f"{path}/*.json.gz"))
    pr = F.col("payload.pull_request")
    return dated.select(
        F.col("id").alias("event_id"),
        "type",
        "created_at",
        "date",
        "month",
        "year",
        F.col("repo.name").alias("repo_name"),
        F.col("actor.login").alias("actor_login"),
        F.col("payload.head").alias("commit_sha"),
        F.col("payload.action").alias("pr_state"),
        pr["additions"].alias("lines_added"),
        pr["deletions"].alias("lines_deleted"),
        pr["changed_files"].alias("files_changed"),
        "is_bot",
    )


def q_classify_bots(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = stg.with_event_dates(fixture.read_fixture_raw(spark, sf_dir))
    return dated.select(F.col("id").alias("event_id"), F.col("actor.login").alias("actor_login"), "is_bot")


def q_bot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg.staging_events(fixture_staging(spark, sf_dir)["bot_events"])


def _staging(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fixture_staging(spark, sf_dir)[name]

    run.__name__ = f"q_{name}"
    return run


def q_staging_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the staging append run twice (non-idempotent), repaired by bronze deduplication."""
    events = fixture_staging(spark, sf_dir)["staging_events"]
    path = scratch_path(spark, "staging_events")
    sink.append(events, path, specs.STAGING_EVENTS)
    sink.append(events, path, specs.STAGING_EVENTS)
    return bronze.bronze_events(read_table(spark, path, specs.STAGING_EVENTS))


def q_lookback_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze events recomputed over the last whole days only."""
    events = fixture_staging(spark, sf_dir)["staging_events"]
    return bronze.bronze_events(since(events, oracle.LOOKBACK_DAYS, oracle.LOOKBACK_AS_OF))


def q_lookback_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly productivity recomputed from the month in which the window starts, across a year end."""
    frames = staging_frames(stg.with_event_dates(fixture.over_a_year_end(fixture.read_fixture_raw(spark, sf_dir))))
    frames["staging_productivity"] = fixture.with_replayed_pull_requests(frames["staging_productivity"])
    silver_rows = Layers(spark, frames)["silver_developer_activity"]
    window = Lookback(days=oracle.YEAR_END_DAYS, as_of=dt.date.fromisoformat(oracle.YEAR_END_AS_OF))
    return gold.developer_productivity_monthly(window.monthly(silver_rows))


# --- medallion tables ------------------------------------------------------------------

def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _layers(spark, sf_dir)[name]

    run.__name__ = f"q_{name}"
    return run


def q_event_time_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.event_time_by_id(_layers(spark, sf_dir)["bronze_events"])


def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _layers(spark, sf_dir, materialize="all")
    return checks.quality_report({name: layers[name] for name in ASSETS})


# --- dirty input -----------------------------------------------------------------------

def _dirty_staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    frames = staging_frames(stg.with_event_dates(fixture.dirty(fixture.read_fixture_raw(spark, sf_dir))))
    frames["staging_productivity"] = fixture.with_replayed_pull_requests(frames["staging_productivity"])
    return frames


def _delivered_twice(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The layers over dirty input, some rows of each delivered a second time."""
    layers = Layers(spark, _dirty_staging(spark, sf_dir), materialize="all")
    return {name: layers[name].unionByName(layers[name].filter(oracle.TWICE[name])) for name in ASSETS}


def q_quality_report_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section 2.8 on failing rows: all four kinds of check count some."""
    return checks.quality_report(_delivered_twice(spark, sf_dir))


def q_dirty_row_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by row: tags of each table's rows, counted."""
    out = None
    for name, df in _delivered_twice(spark, sf_dir).items():
        rows = checks.tagged(df, specs.SPECS[name]).select(F.lit(name).alias("table"), F.explode(checks.VIOLATIONS).alias("tag"))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("table", "tag").agg(F.count(F.lit(1)).alias("failed_rows"))


@_built_once
def _quarantined_run(spark: SparkSession, sf_dir: str) -> Warehouse:
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    frames = _dirty_staging(spark, sf_dir)
    del frames["bot_events"]
    write_staging(wh, frames)
    run_assets(spark, wh, targets=["silver_developer_activity"], quarantine=True)
    return wh


def q_quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a checked run over dirty input sets aside, by table and tags."""
    wh = _quarantined_run(spark, sf_dir)
    out = None
    for name in ("bronze_events", "bronze_commits", "bronze_productivity", "silver_developer_activity"):
        rows = wh.set_aside(name)
        if rows is not None:
            rows = rows.select(F.lit(name).alias("table"), F.array_join(checks.VIOLATIONS, " ").alias("tags"))
            out = rows if out is None else out.unionByName(rows)
    return out.groupBy("table", "tags").agg(F.count(F.lit(1)).alias("rows"))


def q_quarantined_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What that run puts into silver."""
    return _quarantined_run(spark, sf_dir).read("silver_developer_activity").select(*specs.SILVER_DEVELOPER_ACTIVITY.columns)


def q_dirty_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 + P12: '' logins and NULL types through the guards."""
    return Layers(spark, _dirty_staging(spark, sf_dir))["silver_developer_activity"]


# --- sinks -----------------------------------------------------------------------------

def q_partition_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: write every day, then re-run the later days; other days stay, re-run days are replaced."""
    events = fixture_staging(spark, sf_dir)["staging_events"]
    path = scratch_path(spark, "staging_events")
    sink.overwrite_partitions(events, path, specs.STAGING_EVENTS)
    sink.overwrite_partitions(
        events.filter(F.col("date") >= F.lit(oracle.OVERWRITE_SECOND_RUN_FROM).cast("date")), path, specs.STAGING_EVENTS
    )
    return read_table(spark, path, specs.STAGING_EVENTS)


def _merge_scenario(spark: SparkSession, sf_dir: str, update) -> DataFrame:
    """K3: a mid-day first run, then a whole-day re-run of the later days merged on (repo_name, date)."""
    spec = specs.SILVER_REPO_SUMMARY
    activity = _layers(spark, sf_dir)["silver_developer_activity"]
    cutoff = F.lit(oracle.MERGE_FIRST_RUN_CUTOFF).cast("timestamp_ntz")
    first = silver.repo_summary(activity.filter(F.col("created_at") < cutoff))
    second = silver.repo_summary(activity.filter(F.col("date") >= F.lit(oracle.MERGE_SECOND_RUN_FROM).cast("date")))
    path = scratch_path(spark, spec.name)
    sink.merge_into(spark, first, path, spec, update)
    sink.merge_into(spark, second, path, spec, update)
    return read_table(spark, path, spec).select(*spec.columns)


def q_merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge_scenario(spark, sf_dir, sink.INSERT_ONLY)


def q_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge_scenario(spark, sf_dir, sink.UPDATE_ALL)


def _load_month(spark: SparkSession, sf_dir: str, wh: Warehouse, n: int, month=fixture.month_of) -> int:
    frames = staging_frames(stg.with_event_dates(month(fixture.read_fixture_raw(spark, sf_dir), n)))
    frames["staging_productivity"] = fixture.with_replayed_pull_requests(frames["staging_productivity"])
    write_staging(wh, frames, source_month=202400 + n)
    return 202400 + n


def q_rerun_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 as the monthly job uses it: months 1 and 2 loaded, month 1 loaded again; no row of either is lost."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    for n in (1, 2, 1):
        _load_month(spark, sf_dir, wh, n)
    spec = specs.STAGING_EVENTS
    loaded = [202401, 202402]
    rows = [
        read_source_month(spark, wh.path(spec.name), spec, m).withColumn("source_month", F.lit(m)) for m in loaded
    ]
    return rows[0].unionByName(rows[1])


def q_incremental_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + K3: two months, each merged incrementally up to silver, stray and undated rows included."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    for n in (1, 2):
        month = _load_month(spark, sf_dir, wh, n)
        # undated rows are meant to be here, so the not_null checks would stop the run
        run_assets(spark, wh, targets=["silver_developer_activity"], source_month=month, check=False)
    return wh.read("silver_developer_activity").select(*specs.SPECS["silver_developer_activity"].columns)


@_built_once
def _overlapping_months(spark: SparkSession, sf_dir: str) -> Warehouse:
    """K3 by version and by scope: months that share ids and SHAs, the older one loaded again after the newer."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    targets = ["silver_repo_summary", "developer_productivity_monthly"]
    for n in (1, 2, 1):
        month = _load_month(spark, sf_dir, wh, n, fixture.overlapping_month_of)
        # undated rows are meant to be here, so the not_null checks would stop the run
        report = run_assets(spark, wh, targets=targets, source_month=month, replace_scope=True, check=False)
        DistinctIndex(wh).update(report.touched["silver_developer_activity"])
    return wh


def q_distinct_rollup_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 over months: distinct counts from daily bitmaps, kept through the re-run of the older month."""
    index = DistinctIndex(_overlapping_months(spark, sf_dir))
    return index.distinct({"year": F.year("date"), "month": F.month("date"), "event_type": F.col("event_type")})


def q_clustered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: bronze events dealt to files by ranges of the cluster columns; the rows stay as they are."""
    spec, path = specs.BRONZE_EVENTS, scratch_path(spark, "bronze_events")
    sink.merge_into(spark, _layers(spark, sf_dir)["bronze_events"], path, spec)
    sink.cluster(spark, path, spec, F.col("date") >= F.lit(oracle.OVERWRITE_SECOND_RUN_FROM).cast("date"), file_bytes=16 << 10)
    sink.check_schema(spark, path, spec, every_file=True)
    return read_table(spark, path, spec).select(*spec.columns)


def q_bucketed_event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 over event times that lie bucketed by id."""
    layers = _layers(spark, sf_dir)
    times = EventTimes(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return bronze.bronze_commits(fixture_staging(spark, sf_dir)["staging_commits"], times.of(layers["bronze_events"]))


def q_raw_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P4: lines of a dirty archive that a staging scan reads, cannot parse, or that have no login."""
    path = scratch_path(spark, "raw-json")
    lines = fixture.to_archive_json(fixture.read_fixture_raw(spark, sf_dir)).select("id", F.to_json(F.struct("*")).alias("value"))
    broken = lines.filter(F.col("id").cast("bigint") % oracle.BROKEN_EVERY == 0).select(F.substring("value", 1, 40).alias("value"))
    lines.select("value").unionByName(broken).write.option("compression", "gzip").text(path)
    scanned = Observation("raw_scan")
    stage_raw(spark, read_raw(spark, f"{path}/*.gz", corrupt=True), persist_base=scratch_path(spark, "raw-base"), scanned=scanned)
    counts = F.map_from_entries(F.array(*(F.struct(F.lit(k), F.lit(v).cast("bigint")) for k, v in scanned.get.items())))
    return spark.range(1).select(F.explode(counts).alias("kind", "rows"))


def _of_overlapping_months(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _overlapping_months(spark, sf_dir).read(table).select(*specs.SPECS[table].columns)

    run.__name__ = f"q_overlapping_months_{table}"
    return run


def q_merge_key_moves_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: a second run carries every event of the moved days to a later date; the old dates end up empty."""
    spec = specs.BRONZE_EVENTS
    first = _layers(spark, sf_dir)["bronze_events"]
    late = F.col("created_at") + F.expr(f"INTERVAL '{oracle.MOVED_BY_DAYS}' DAY")
    moved = first.filter(F.col("date") >= F.lit(oracle.MOVED_FROM).cast("date")).withColumns(
        {
            "created_at": late,
            "date": late.cast("date"),
            "month": F.month(late),
            "year": F.year(late),
        }
    )
    path = scratch_path(spark, spec.name)
    sink.merge_into(spark, first, path, spec)
    sink.merge_into(spark, moved, path, spec)
    return read_table(spark, path, spec).select(*spec.columns)


# --- reports -----------------------------------------------------------------------------

def _report(fn, table: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_layers(spark, sf_dir)[table])

    run.__name__ = f"q_{fn.__name__}"
    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the monthly repository health scorecard, built from raw events through every layer."""
    return _layers(spark, SMOKE_DIR)["repo_health_scorecard"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "raw_json_scan": q_raw_json_scan,
        "classify_bots": q_classify_bots,
        "bot_events": q_bot_events,
        "staging_events": _staging("staging_events"),
        "staging_commits": _staging("staging_commits"),
        "staging_productivity": _staging("staging_productivity"),
        "staging_append": q_staging_append,
        "event_time_by_id": q_event_time_by_id,
    }
    for name in ASSETS:
        q[name] = _table(name)
    q.update(
        {
            "quality_report": q_quality_report,
            "quality_report_dirty": q_quality_report_dirty,
            "dirty_row_tags": q_dirty_row_tags,
            "dirty_silver": q_dirty_silver,
            "quarantined_rows": q_quarantined_rows,
            "quarantined_silver": q_quarantined_silver,
            "partition_overwrite_roundtrip": q_partition_overwrite_roundtrip,
            "merge_insert_only": q_merge_insert_only,
            "merge_upsert": q_merge_upsert,
            "merge_key_moves_partition": q_merge_key_moves_partition,
            "rerun_month": q_rerun_month,
            "incremental_months": q_incremental_months,
            "rerun_older_month": _of_overlapping_months("silver_repo_summary"),
            "rerun_older_month_events": _of_overlapping_months("bronze_events"),
            "rerun_older_month_commits": _of_overlapping_months("bronze_commits"),
            "rerun_older_month_productivity": _of_overlapping_months("bronze_productivity"),
            "rerun_older_month_silver": _of_overlapping_months("silver_developer_activity"),
            "distinct_rollup_monthly": q_distinct_rollup_monthly,
            "clustered_events": q_clustered_events,
            "bucketed_event_times": q_bucketed_event_times,
            "raw_accounting": q_raw_accounting,
            "merge_unpartitioned_monthly": _of_overlapping_months("developer_productivity_monthly"),
            "lookback_events": q_lookback_events,
            "lookback_monthly": q_lookback_monthly,
            "rpt_top_developers": _report(reports.top_developers_by_commits, "commit_stats_by_day"),
            "rpt_commits_by_repo": _report(reports.commits_by_repo, "commit_stats_by_day"),
            "rpt_event_share": _report(reports.event_share, "activity_by_day"),
            "rpt_daily_volume": _report(reports.daily_volume, "activity_by_day"),
            "rpt_top_pr_developers": _report(reports.top_pr_developers, "developer_productivity_monthly"),
            "rpt_merge_rate_vs_volume": _report(reports.merge_rate_vs_volume, "developer_productivity_monthly"),
            "rpt_merged_by_month": _report(reports.merged_by_month, "developer_productivity_monthly"),
            "rpt_pr_size_by_month": _report(reports.pr_size_by_month, "silver_developer_activity"),
            "rpt_loc_churn_by_month": _report(reports.loc_churn_by_month, "developer_productivity_monthly"),
        }
    )
    if llm is not None:
        q.update(llm.QUERIES)
    if corpus_pipeline is not None:
        q["pipeline"] = corpus_pipeline.run
    return q


def oracle_sql() -> dict[str, str]:
    sql = dict(oracle.oracle_queries())
    if llm is not None:
        sql.update(llm.ORACLE_SQL)
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
