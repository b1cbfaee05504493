"""Pruned key search (K3), bucketed event times (J1, J2), distinct counts that merge (A2, A6), clustering
across files (K5), schema checks of existing tables (K6) and accounting for raw lines (S1, P4)."""

from __future__ import annotations

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL, d
from pyspark.sql import functions as F

from forgelake import specs
from forgelake.operators import bronze, distinct
from forgelake.plans.distinct_index import DistinctIndex
from forgelake.plans.pipeline import EventTimes, Warehouse, fixture_staging, run_assets, run_month, stage_raw, write_staging
from forgelake.session import scratch_path
from forgelake.sinks import parquet as sink
from forgelake.sources import fixture
from forgelake.sources.raw import read_raw
from forgelake.sources.tables import read_table

EVENTS = specs.BRONZE_EVENTS


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


def _events(spark, n=4000, days=20):
    """Ids grow with time, as an archive's do."""
    at = F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(days=F.floor(F.col("id") * days / n).cast("int"))
    rows = spark.range(n).select(
        F.format_string("%08d", "id").alias("event_id"),
        F.element_at(F.array(F.lit("PushEvent"), F.lit("WatchEvent")), (F.col("id") % 2 + 1).cast("int")).alias("type"),
        at.alias("created_at"),
        F.concat(F.lit("org/repo-"), (F.col("id") * 7919 % 50).cast("string")).alias("repo_name"),
        F.concat(F.lit("u"), (F.col("id") % 31).cast("string")).alias("actor_login"),
    )
    date = F.col("created_at").cast("date")
    return rows.select("*", date.alias("date"), F.month(date).alias("month"), F.year(date).alias("year")).select(*EVENTS.columns)


# --- K3: moved keys ------------------------------------------------------------------------------


def _rows_scanned(spark, df) -> int:
    """Rows that the scan of the target gave (statistics have passed over the others)."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fresh = df.select("*")
        fresh.collect()
        leaves = fresh._jdf.queryExecution().executedPlan().collectLeaves()
        return max(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_key_search_passes_over_row_groups_outside_the_source(spark, tmp_table):
    path, source = tmp_table(), tmp_table("source")
    sink.merge_into(spark, _events(spark), path, EVENTS)
    _events(spark).filter("event_id between '00003900' and '00003950'").write.parquet(source)
    staged = spark.read.schema(EVENTS.schema).parquet(source)
    target = read_table(spark, path, EVENTS).select("event_id", "date")
    whole = target.join(staged.select("event_id"), "event_id", "left_semi")
    found = sink._within_keys(target, staged, ["event_id"])
    assert sorted(found.collect()) == sorted(whole.collect()) and found.count() == 51
    assert "GreaterThanOrEqual(event_id,00003900)" in _plan(found) and "LessThanOrEqual(event_id,00003950)" in _plan(found)
    assert _rows_scanned(spark, whole) == 4000
    assert _rows_scanned(spark, found) == 200  # the one day whose files can hold the ids


def test_key_search_sends_a_bloom_filter_into_a_large_scan(spark, tmp_table):
    path, source = tmp_table(), tmp_table("source")
    sink.merge_into(spark, _events(spark), path, EVENTS)
    _events(spark).filter("event_id in ('00000007', '00003950')").write.parquet(source)
    settings = {
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        staged = spark.read.schema(EVENTS.schema).parquet(source)
        found = sink._within_keys(read_table(spark, path, EVENTS).select("event_id", "date"), staged, ["event_id"])
        assert "might_contain" in _plan(found)
        assert sorted(r.event_id for r in found.collect()) == ["00000007", "00003950"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_key_search_without_complete_keys(spark, tmp_table):
    path = tmp_table()
    sink.merge_into(spark, _events(spark, 40), path, EVENTS)
    null = _events(spark, 1).withColumn("event_id", F.lit(None).cast("string"))
    target = read_table(spark, path, EVENTS).select("event_id", "date")
    assert sink._within_keys(target, null, ["event_id"]).count() == 0
    assert sink._within_keys(target, null.limit(0), ["event_id"]).count() == 0


# --- J1, J2: bucketed event times ---------------------------------------------------------------


def test_event_side_of_the_joins_is_not_exchanged(spark, warehouse):
    events = warehouse.read("bronze_events")
    staged = warehouse.read("staging_commits")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    times = EventTimes(spark, 4)
    try:
        joined = staged.join(times.of(events).select("event_id", "created_at"), "event_id")
        plan = joined._jdf.queryExecution().sparkPlan().toString() and joined._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        assert plan.count("Exchange") == 1  # the staging side alone
        plain = staged.join(events.select("event_id", "created_at"), "event_id")
        assert plain._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
        got, want = (sorted(map(repr, bronze.bronze_commits(staged, e).collect())) for e in (times.of(events), events))
        assert got == want
    finally:
        times.drop()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not spark.catalog.tableExists(times.name) and not sink.path_exists(spark, times.path)


def test_run_with_bucketed_event_times_gives_the_same_tables(spark, warehouse):
    wh = Warehouse(spark, scratch_path(spark, "wh-buckets"))
    write_staging(wh, fixture_staging(spark, SF_SMALL))
    run_assets(spark, wh, targets=["bronze_commits", "bronze_productivity"], event_buckets=4)
    for name in ("bronze_commits", "bronze_productivity"):
        columns = specs.SPECS[name].columns
        assert sorted(map(repr, wh.read(name).select(*columns).collect())) == sorted(map(repr, warehouse.read(name).select(*columns).collect()))


# --- A2, A6: distinct counts that merge ------------------------------------------------------------


def test_dictionary_grows_and_never_renumbers(spark, tmp_table):
    values = lambda *v: spark.createDataFrame([(x,) for x in v], "value string")
    first = {r.value: r.id for r in distinct.dictionary(values(*map(str, range(2000)), None, "7")).collect()}
    assert len(first) == 2000 and len(set(first.values())) == 2000 and max(first.values()) < 20 * distinct.STRIPES
    path = tmp_table()
    spark.createDataFrame(list(first.items()), "value string, id long").write.parquet(path)
    known = spark.read.parquet(path)
    grown = {r.value: r.id for r in distinct.dictionary(values("5", "new", "other", "é"), known).collect()}
    assert {k: grown[k] for k in first} == first and len(set(grown.values())) == 2003
    assert {r.value: r.id for r in distinct.dictionary(values("é", "other", "new", "5"), known).collect()} == grown


def test_merged_bitmaps_count_distinct(spark):
    rows = spark.range(30_000).select(
        (F.col("id") % 7).alias("day"), F.when(F.col("id") % 11 != 0, (F.col("id") * 31 % 4001).cast("string")).alias("who")
    )
    ids = distinct.dictionary(rows.select(F.col("who").alias("value")))
    parts = distinct.bitmaps(rows, ["day"], "who", ids)
    daily = {r.day: r.n for r in distinct.counted(parts, ["day"], "n").collect()}
    assert daily == {r.day: r.n for r in rows.groupBy("day").agg(F.count_distinct("who").alias("n")).collect()}
    week = distinct.counted(parts.withColumn("all", F.lit(0)), ["all"], "n").first().n
    assert week == rows.agg(F.count_distinct("who")).first()[0]
    # merging the same part again changes nothing
    assert distinct.counted(parts.unionByName(parts), ["day"], "n").agg(F.sum("n")).first()[0] == sum(daily.values())


def test_index_follows_changed_days(spark, warehouse):
    """Days rebuilt, emptied and added; other days' bitmaps are not touched."""
    wh = Warehouse(spark, scratch_path(spark, "wh-index"))
    spec = specs.SILVER_DEVELOPER_ACTIVITY
    silver = warehouse.read(spec.name)
    sink.merge_into(spark, silver, wh.path(spec.name), spec)
    index = DistinctIndex(wh)
    index.update()
    by = {"month": F.month("date"), "event_type": F.col("event_type")}

    def expected():
        rows = wh.read(spec.name).groupBy(F.month("date").alias("month"), "event_type")
        counts = rows.agg(F.count_distinct("developer_login").alias("unique_actors"), F.count_distinct("repo_name").alias("unique_repos"))
        return sorted(map(tuple, counts.collect()))

    assert sorted(map(tuple, index.distinct(by).collect())) == expected()
    gone, changed = d("2024-01-03"), d("2024-01-05")
    scope = F.col("date").isin(gone, changed)
    fresh = silver.filter(F.col("date") == changed).withColumn("developer_login", F.concat(F.lit("new-"), "developer_login"))
    done = sink.merge_into(spark, fresh, wh.path(spec.name), spec, scope=scope, keys_can_move=False)
    index.update({v[0] for v in done["touched"]})
    assert sorted(map(tuple, index.distinct(by).collect())) == expected()
    daily = {r.date for r in index.distinct({"date": F.col("date")}).collect()}
    assert gone not in daily and changed in daily


# --- K5: clustering across files --------------------------------------------------------------------


def _admitting(path, column, value):
    """Files whose statistics admit a value."""
    out = 0
    for file in glob.glob(f"{path.removeprefix('file:')}/date=*/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        out += any(s.min <= value <= s.max for s in stats)
    return out


def test_clustered_files_admit_few_values(spark, tmp_table):
    path = tmp_table()
    rows = _events(spark, 6000, 2)
    # as merges leave a busy day: many files, each sorted, each with every repository
    sink.write_table(rows.repartition(12), path, EVENTS)
    scattered = tmp_table("scattered")
    rows.repartition(12).sortWithinPartitions(*EVENTS.cluster_by).write.partitionBy("date").parquet(scattered)
    sink.delete_path(spark, path)
    sink._rename(spark, scattered, path)
    before = sorted(map(repr, read_table(spark, path, EVENTS).select(*EVENTS.columns).collect()))
    assert _admitting(path, "repo_name", "org/repo-17") == 24
    ranges = sink.cluster(spark, path, EVENTS, file_bytes=4 << 10)
    files = len(glob.glob(f"{path.removeprefix('file:')}/date=*/*.parquet"))
    assert ranges >= 10 and files >= 10
    # the first cluster column parts the types, so a repository lies in a file or two of each
    assert _admitting(path, "repo_name", "org/repo-17") <= files // 2
    assert sorted(map(repr, read_table(spark, path, EVENTS).select(*EVENTS.columns).collect())) == before


def test_clustering_chosen_partitions_and_unpartitioned_tables(spark, tmp_table):
    path = tmp_table()
    sink.merge_into(spark, _events(spark, 400, 4), path, EVENTS)
    names = lambda: {f for f in glob.glob(f"{path.removeprefix('file:')}/date=*/*.parquet")}
    before = names()
    sink.cluster(spark, path, EVENTS, F.col("date") == d("2024-01-02"))
    assert {f for f in before - names()} == {f for f in before if "2024-01-02" in f}
    assert read_table(spark, path, EVENTS).count() == 400
    assert sink.cluster(spark, path, EVENTS, F.col("date") == d("2030-01-01")) == 1
    spec, monthly = specs.REPO_HEALTH_SCORECARD, tmp_table("monthly")
    rows = [(f"r{i}", 2024, 1, d("2024-01-01"), i, 1, 1, 0, 0, None, 0, 1.0) for i in range(50)]
    sink.merge_into(spark, spark.createDataFrame(rows, spec.schema), monthly, spec)
    sink.cluster(spark, monthly, spec, file_bytes=1 << 10)
    assert read_table(spark, monthly, spec).count() == 50


# --- K6: schema of an existing table ------------------------------------------------------------------


def test_missing_and_retyped_columns_stop_a_merge(spark, tmp_table):
    rows = _events(spark, 20, 2)
    for change, fault in (
        (lambda df: df.drop("repo_name"), "no repo_name"),
        (lambda df: df.withColumn("repo_name", F.lit(1)), "repo_name is int, not string"),
        (lambda df: df.withColumn("extra", F.lit(1)), "unknown extra"),
    ):
        path = tmp_table()
        change(sink.conform(rows, EVENTS)).write.partitionBy("date").parquet(path)
        for _ in range(2):
            with pytest.raises(sink.SchemaDriftError, match=fault):
                sink.merge_into(spark, rows, path, EVENTS)
        assert spark.read.parquet(path).count() == 20
    path = tmp_table()
    sink.conform(rows, EVENTS).write.partitionBy("type").parquet(path)
    with pytest.raises(sink.SchemaDriftError, match="laid out by type="):
        sink.merge_into(spark, rows, path, EVENTS)
    path = tmp_table()
    sink.conform(rows, EVENTS).write.parquet(path)
    with pytest.raises(sink.SchemaDriftError, match="not laid out by"):
        sink.merge_into(spark, rows, path, EVENTS)


def test_drift_in_an_older_file_is_found_when_all_are_read(spark, tmp_table):
    path = tmp_table()
    sink.merge_into(spark, _events(spark, 20, 2), path, EVENTS)
    old = sink.conform(_events(spark, 1), EVENTS).withColumn("month", F.lit("x")).withColumn("date", F.lit("2023-01-01"))
    old.write.mode("append").partitionBy("date").parquet(path)
    sink.check_schema(spark, path, EVENTS)  # the newest partition is as declared
    with pytest.raises(sink.SchemaDriftError):
        sink.check_schema(spark, path, EVENTS, every_file=True)


def test_empty_table_has_no_drift(spark, tmp_table):
    for spec in (EVENTS, specs.REPO_HEALTH_SCORECARD):
        path = tmp_table(spec.name)
        sink.ensure_table(spark, path, spec)
        sink.check_schema(spark, path, spec)
        sink.check_schema(spark, path, spec, every_file=True)
    sink.merge_into(spark, _events(spark, 20, 2), tmp_table("later"), EVENTS)


# --- S1, P4: raw lines ----------------------------------------------------------------------------------


def test_monthly_job_reports_bad_lines_and_rows_without_login(spark):
    base = scratch_path(spark, "archive-dirty")
    raw = fixture.to_archive_json(fixture.read_fixture_raw(spark, SF_SMALL))
    lines = raw.select(F.to_json(F.struct("*")).alias("value"))
    bad = spark.createDataFrame([('{"id": "1", "type"',), ("not json",), ('{"id": "2", "actor": 5}',)], "value string")
    month = f"{base}/2024-01"
    raw.write.option("compression", "gzip").json(month)
    bad.coalesce(1).write.mode("append").option("compression", "gzip").text(f"{month}/broken")
    for file in glob.glob(f"{month.removeprefix('file:')}/broken/*.gz"):
        sink._rename(spark, file, f"{month}/broken.json.gz")
    wh = Warehouse(spark, scratch_path(spark, "wh-dirty-lines"))
    report = run_month(spark, base, 2024, 1, wh, targets=["bronze_events"])
    no_login = raw.filter(F.col("actor.login").isNull()).count()
    assert report.scanned == {"lines": lines.count() + 3, "bad_lines": 3, "no_login": no_login}
    assert report.touched["bronze_events"] >= {dt.date(2024, 1, 1)}


def test_rows_of_uneven_gzip_files_are_spread(spark):
    """One large file and a few small ones: the base is dealt by size, not by file."""
    path = scratch_path(spark, "archive-uneven")
    raw = fixture.to_archive_json(fixture.read_fixture_raw(spark, SF_SMALL))
    raw.coalesce(1).write.option("compression", "gzip").json(path)
    raw.limit(20).repartition(3).write.mode("append").option("compression", "gzip").json(path)
    sizes = {}
    merging = "spark.sql.adaptive.coalescePartitions.enabled"  # rows this few would be merged to one part again
    old = spark.conf.get(merging)
    spark.conf.set(merging, "false")
    try:
        for spread in (False, True):
            base = scratch_path(spark, f"base-{spread}")
            frames = stage_raw(spark, read_raw(spark, f"{path}/*.json.gz"), persist_base=base, spread=spread)
            assert frames["staging_events"].count() > 0
            files = glob.glob(f"{base.removeprefix('file:')}/*.parquet")
            sizes[spread] = sorted(pq.ParquetFile(f).metadata.num_rows for f in files)
    finally:
        spark.conf.set(merging, old)
    assert sum(sizes[True]) == sum(sizes[False]) and sizes[False][-1] >= raw.count()
    assert len(sizes[True]) > 1 and sizes[True][-1] < 0.7 * raw.count()


def test_columns_of_the_distinct_index_are_updated_side_by_side(warehouse, monkeypatch):
    """the dictionary of either column is merged while the other one is."""
    import threading

    both, merge = threading.Barrier(2, timeout=120), sink.merge_into

    def merged(spark, source, path, spec, *args, **how):
        if spec.name.startswith("ids_"):
            both.wait()
        return merge(spark, source, path, spec, *args, **how)

    monkeypatch.setattr(sink, "merge_into", merged)
    DistinctIndex(warehouse).update()
