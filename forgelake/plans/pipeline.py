"""E1 + E2: the staging job and the ordered medallion run.

Staging job: raw events are parsed once into a Parquet base in the scratch
folder (JSON parsing is the expensive part and gzip is not splittable), then
the bot split and the three staging tables are cut from that base with column
pruning and pushed-down type filters, and written partition by partition.

Medallion run: assets run upstream first; each reads its inputs from the
warehouse, is merged into its table by key, then checked.  Every layer is a
written table, so no plan recomputes an upstream layer and a lost executor
only re-runs the current stage.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelake import specs
from forgelake.operators import staging as stg
from forgelake.plans import checks
from forgelake.plans.assets import ASSETS, STAGING_NAMES, topological_order, waves
from forgelake.session import scratch_path
from forgelake.sinks import parquet as sink
from forgelake.sources import fixture
from forgelake.sources.raw import CORRUPT, month_glob, read_raw
from forgelake.sources.tables import read_source_month, read_table, since_month

BOT_EVENTS = "bot_events"
#: The table whose replaced rows recall the staging rows of their events.
EVENTS = "bronze_events"
#: Assets whose build ends in one row per key.
DEDUPED = ("bronze_events", "bronze_commits")
#: Assets that read nothing of it but event times (the silver timeline reads whole rows).
TIMED = ("bronze_commits", "bronze_productivity")


def staging_frames(base: DataFrame) -> dict[str, DataFrame]:
    """Bot split + the three staging projections over a dated raw base."""
    bots, clean = stg.split_bots(base)
    return {
        "staging_events": stg.staging_events(clean),
        "staging_commits": stg.staging_commits(clean),
        "staging_productivity": stg.staging_productivity(clean),
        BOT_EVENTS: bots,
    }


def scan_metrics(raw: DataFrame) -> list[Column]:
    """What becomes of the lines of a scan: all, those that don't parse, those that do and lack a login (in neither split)."""
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(bad).alias("bad_lines"),
        F.count_if(~bad & F.col("actor.login").isNull()).alias("no_login"),
    ]


def stage_raw(
    spark: SparkSession,
    raw: DataFrame,
    *,
    persist_base: str | None = None,
    scanned: Observation | None = None,
    spread: bool = False,
) -> dict[str, DataFrame]:
    """Raw events -> staging frames.

    With ``persist_base`` (a new shared folder) the dated raw records are
    written there once, so the four outputs read Parquet instead of parsing
    text four times; the caller deletes it when the outputs are written.
    ``scanned`` observes that one pass (:func:`scan_metrics`).  gzip files cannot be split and Spark deals
    them to tasks by their compressed size; with ``spread`` the parsed rows are dealt anew
    before they are written (a shuffle), so few or uneven files don't make as few or uneven a base.
    Leave it out for a columnar input, which is cheaper to re-read than to copy.
    """
    if scanned is not None:
        if not persist_base:
            raise ValueError("a scan is accounted for where it is written once: persist_base")
        raw = raw.observe(scanned, *scan_metrics(raw))
    base = stg.with_event_dates(raw.drop(CORRUPT))
    if persist_base:
        (base.hint("rebalance") if spread else base).write.mode("errorifexists").parquet(persist_base)
        base = spark.read.schema(base.schema).parquet(persist_base)
    return staging_frames(base)


def fixture_staging(spark: SparkSession, sf_dir: str, *, replay: bool = True) -> dict[str, DataFrame]:
    """Staging frames from the driver's ``events`` table (lazy; the mapping is a cheap narrow scan)."""
    frames = staging_frames(stg.with_event_dates(fixture.read_fixture_raw(spark, sf_dir)))
    if replay:
        frames["staging_productivity"] = fixture.with_replayed_pull_requests(frames["staging_productivity"])
    return frames


@dataclass
class Warehouse:
    """Table folders under one root: ``<root>/<table name>``."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name), specs.SPECS[name])

    def exists(self, name: str) -> bool:
        return sink.path_exists(self.spark, self.path(name))

    def quarantine(self, name: str) -> str:
        return self.path(f"_quarantine/{name}")

    def set_aside(self, name: str) -> DataFrame | None:
        """Quarantined rows of a table with their ``violations`` and ``batch``; None without any."""
        if not sink.folder_names(self.spark, self.quarantine(name)):
            return None
        schema = specs.SPECS[name].stored_schema.add(checks.VIOLATIONS, T.ArrayType(T.StringType())).add("batch", "string")
        return self.spark.read.schema(schema).parquet(self.quarantine(name))

    def quality_report(self) -> DataFrame:
        """Every declared check over every medallion table in the warehouse."""
        return checks.quality_report({name: self.read(name) for name in ASSETS})


def _run_all(spark: SparkSession, tasks: dict[str, Callable[[], None]], parallel: int) -> dict[str, float]:
    """Run independent Spark actions, up to ``parallel`` at a time; seconds per task.

    Each action is its own Spark job; submitting independent ones from
    threads lets their stages share the executors, and one job's commit
    (driver-side renames) overlaps another's tasks.
    """

    def timed(item):
        name, fn = item
        if parallel > 1:  # FAIR shares executors between pools, not inside one
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        t0 = time.perf_counter()
        fn()
        return name, time.perf_counter() - t0

    if parallel <= 1 or len(tasks) == 1:
        return dict(map(timed, tasks.items()))
    with ThreadPoolExecutor(max_workers=min(parallel, len(tasks))) as pool:
        return dict(pool.map(timed, tasks.items()))


def write_staging(
    warehouse: Warehouse,
    frames: dict[str, DataFrame],
    *,
    append: bool = False,
    source_month: int | None = None,
    parallel: int = 4,
) -> dict[str, float]:
    """Write staging tables and the bot side output.

    With ``source_month`` (YYYYMM) the rows form that month's own partition and
    replace all of it, and no row of another month, whatever dates they carry.
    Without it: K1 overwrite of the dates present, or K2 append.  A warehouse
    keeps to one of the two layouts.
    """
    if source_month is not None and append:
        raise ValueError("a source month is replaced, not appended to")
    write = sink.append if append else sink.overwrite_partitions
    spark = warehouse.spark

    def table(name: str) -> Callable[[], None]:
        path, spec = warehouse.path(name), specs.SPECS[name]
        if source_month is None:
            return lambda: write(frames[name], path, spec)
        return lambda: sink.replace_month(
            spark, path, source_month, lambda new: sink.write_table(frames[name], new, spec, "errorifexists")
        )

    def bots() -> None:
        path = warehouse.path(BOT_EVENTS)
        if source_month is None:
            write_bots(path, "append" if append else "overwrite")
        else:
            sink.replace_month(spark, path, source_month, lambda new: write_bots(new, "errorifexists"))

    def write_bots(path: str, mode: str) -> None:
        (
            frames[BOT_EVENTS]
            .hint("rebalance", "year", "month", "date")
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("year", "month", "date")
            .parquet(path)
        )

    tasks = {name: table(name) for name in STAGING_NAMES}
    if BOT_EVENTS in frames:
        tasks[BOT_EVENTS] = bots
    return _run_all(warehouse.spark, tasks, parallel)


@dataclass
class Lookback:
    """Recompute only recent whole days (daily tables) / whole months (monthly tables).

    Rows without a date go along where the key does not hold the date (the merge replaces them by
    key); groups by day or month never match without one, so lookback runs leave those as they are.
    """

    days: int
    as_of: dt.date

    def daily(self, df: DataFrame, undated: bool = True) -> DataFrame:
        """Rows of the window's days; ``undated`` rows, which belong to no window, for tables whose key finds them again."""
        start = self.as_of - dt.timedelta(days=self.days)
        keep = F.col("date") >= F.lit(start)
        df = df.filter(keep | F.col("date").isNull() if undated else keep)
        if {"year", "month"} <= set(df.columns):
            # derived from date, so the same cut: it prunes tables laid out by year and month only
            later = (F.col("year") > start.year) | ((F.col("year") == start.year) & (F.col("month") >= start.month))
            df = df.filter(later | F.col("year").isNull() if undated else later)
        return df

    def monthly(self, df: DataFrame) -> DataFrame:
        start = (self.as_of - dt.timedelta(days=self.days)).replace(day=1)
        if "date" in df.columns:
            # year / month derive from date, so this is the same cut, and it prunes partitions
            return df.filter(F.col("date") >= F.lit(start))
        return since_month(df, 0, start)


def _dated(columns: Iterable[str], dates: set, whole_months: bool) -> Column:
    """Whether a row lies on the given dates (None: without a date), or in the months that hold them."""
    if not whole_months:
        return sink._partition_filter(["date"], {(d,) for d in dates})
    months = {(None, None) if d is None else (d.year, d.month) for d in dates}
    if "date" in columns:  # months as date ranges prune tables laid out by date
        keep = F.lit(False)
        for y, m in months:
            first = None if y is None else F.lit(dt.date(y, m, 1))
            keep = keep | (F.col("date").isNull() if y is None else F.col("date").between(first, F.last_day(first)))
        return keep
    return sink._partition_filter(["year", "month"], months)


def _on_dates(df: DataFrame, dates: set, whole_months: bool) -> DataFrame:
    return df.filter(_dated(df.columns, dates, whole_months))


def _upstream(name: str) -> set[str]:
    deps = {d for d in ASSETS[name].deps if d in ASSETS}
    return deps.union(*(_upstream(d) for d in deps))


class EventTimes:
    """``(event_id, created_at)`` as a table of the session catalog, bucketed and sorted by id.

    Plain paths carry no bucketing, the catalog does: joins on ``event_id`` read it without an exchange or a sort.
    """

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.name = f"event_times_{uuid.uuid4().hex[:12]}"
        self.path, self.lock, self.written = scratch_path(spark, self.name), threading.Lock(), False

    def of(self, events: DataFrame) -> DataFrame:
        """The table, written from the first frame that is asked for (rows without an id join nothing)."""
        with self.lock:
            if not self.written:
                rows = events.select("event_id", "created_at").filter(F.col("event_id").isNotNull())
                dealt = rows.repartition(self.buckets, "event_id")  # a file a bucket
                dealt.write.bucketBy(self.buckets, "event_id").sortBy("event_id").option("path", self.path).saveAsTable(self.name)
                self.written = True
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        sink.delete_path(self.spark, self.path.rpartition("/")[0])


class Unfinished:
    """What incremental runs have changed and not yet carried through every asset.

    Each merge of a run notes, before it commits, the dates it changes and the events whose row
    it replaces; a run takes up the notes of earlier ones that broke off (or built some assets
    only), and drops them when all assets are built.  Dates are folder names, events a small table.
    """

    def __init__(self, warehouse: Warehouse):
        self.spark, self.root = warehouse.spark, f"{warehouse.root.rstrip('/')}/_unfinished"

    def note(self, asset: str, outcome: dict) -> None:
        for (day, *_) in outcome["seen"]:
            sink.make_folder(self.spark, f"{self.root}/dates/{asset}/{day}")
        if asset == EVENTS and "replaced" in outcome:
            path = f"{self.root}/events/{uuid.uuid4().hex}"
            outcome["replaced"].select("event_id").write.parquet(path)

    def dates(self, asset: str) -> set:
        names = sink.folder_names(self.spark, f"{self.root}/dates/{asset}")
        return {None if n == str(None) else dt.date.fromisoformat(n) for n in names}

    def events(self) -> DataFrame | None:
        """Ids of replaced events; None without any."""
        names = sink.folder_names(self.spark, f"{self.root}/events")
        paths = [p for p in (f"{self.root}/events/{n}" for n in names) if sink.path_exists(self.spark, f"{p}/_SUCCESS")]
        if not paths:
            return None
        ids = self.spark.read.schema("event_id string").parquet(*paths).distinct()
        return None if ids.isEmpty() else ids

    def clear(self) -> None:
        sink.delete_path(self.spark, self.root)


@dataclass
class RunReport:
    seconds: dict[str, float] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)  # rows each asset built this run
    failures: list[tuple] = field(default_factory=list)
    set_aside: dict[str, int] = field(default_factory=dict)  # rows quarantined
    touched: dict[str, set] = field(default_factory=dict)  # dates whose rows each partitioned asset changed or found unchanged
    scanned: dict[str, int] = field(default_factory=dict)  # lines of the raw scan, see scan_metrics


def run_assets(
    spark: SparkSession,
    warehouse: Warehouse,
    *,
    targets: Iterable[str] | None = None,
    ingested_at: Column | None = None,
    update: str | tuple = sink.UPDATE_ALL,
    lookback: Lookback | None = None,
    source_month: int | None = None,
    replace_scope: bool = False,
    keys_can_move: dict[str, bool] | None = None,
    check: bool = True,
    strict: bool = True,
    quarantine: bool = False,
    event_buckets: int | None = None,
    parallel: int = 4,
) -> RunReport:
    """Build, merge and check every asset needed for ``targets``, upstream first.

    Assets run in waves of equal DAG depth; the assets of one wave only read
    earlier waves' tables, so they run side by side.  ``ingested_at``
    defaults to one literal load time for the whole run.  With ``strict`` a
    failing check raises after that wave, before any downstream asset runs.

    ``source_month`` (YYYYMM) makes the run incremental: the first layer reads
    the staging rows of that month, whatever their dates, with those of other
    months whose event has got a later version, and every later
    asset recomputes the dates (monthly tables: whole months) of the rows that
    the merges before it changed or found unchanged.  Tables with a version order keep the
    latest version of a key, whichever month is loaded last.  Groups that no longer arise
    stay, as by the merge rule; with ``replace_scope`` the recomputed dates and months
    of silver and gold are replaced whole, so the tables equal a rebuild.  ``keys_can_move``
    goes to :func:`sink.merge_into` by asset name.

    ``quarantine`` sets rows that fail a per-row check aside (:meth:`Warehouse.set_aside`), one batch a
    source month (other runs: ``all``), and merges the others, so the run goes on.

    ``event_buckets`` writes the events' ids and times once, bucketed by id (:class:`EventTimes`), for the
    two joins that look them up: one shuffle and sort of the events instead of two.  Take at
    least ``spark.sql.shuffle.partitions``; with fewer buckets Spark may deal both sides anew.
    """
    if lookback is not None and source_month is not None:
        raise ValueError("lookback and source_month exclude each other")
    if replace_scope and source_month is None:
        raise ValueError("replace_scope needs a source_month")
    touched: dict[str, set] = {}
    unfinished = Unfinished(warehouse) if source_month is not None else None
    if unfinished:
        touched = {name: unfinished.dates(name) for name in ASSETS}
    if ingested_at is None:
        ingested_at = F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp")
    report = RunReport()
    needed = set(topological_order(targets))
    times = EventTimes(spark, event_buckets) if event_buckets else None

    def one(name: str) -> Callable[[], None]:
        asset = ASSETS[name]

        def run() -> None:
            inputs = []
            dates = set().union(*(touched.get(a, set()) for a in _upstream(name)))
            for dep in asset.deps:
                df = warehouse.read(dep)
                if source_month is not None and dep in STAGING_NAMES:
                    # Pushes and pull requests take their event's time, so a replaced event recalls its rows of every month.
                    recalled = unfinished.events() if EVENTS in asset.deps else None
                    df = read_source_month(spark, warehouse.path(dep), specs.SPECS[dep], source_month, recalled)
                elif source_month is not None:
                    df = _on_dates(df, dates, whole_months=not asset.spec.partition_by)
                elif lookback is not None:
                    keyed = "date" not in asset.spec.keys
                    df = lookback.daily(df, undated=keyed) if asset.spec.partition_by else lookback.monthly(df)
                if times and dep == EVENTS and name in TIMED:
                    df = times.of(df)
                inputs.append(df)
            # Row count of the build and the per-row checks of what is written are
            # observed while the merge writes: neither costs a pass of its own.
            built = Observation(f"{name}_rows")
            result = asset.build(*inputs, ingested_at=ingested_at).observe(built, F.count(F.lit(1)).alias("rows"))
            row_checks = Observation(f"{name}_checks") if check else None
            metrics = checks.column_metrics(asset.spec) if check else []

            def observe(df: DataFrame) -> DataFrame:
                return df.observe(row_checks, *metrics) if metrics else df

            how, scope = update, None
            if unfinished and asset.spec.latest_by and update == sink.UPDATE_ALL:
                how = sink.UPDATE_LATEST
            elif replace_scope:
                monthly = not asset.spec.partition_by
                scope = _dated(asset.spec.columns, dates, whole_months=monthly)

            # Builders end in a group-by or dedup on the key, and the unique_key check below covers
            # the result, so the merge skips its own source key pass; without checks it takes that pass
            # but for the builds that end in the dedup itself.
            outcome = sink.merge_into(
                spark,
                result,
                warehouse.path(name),
                asset.spec,
                how,
                check_source_keys=not check and name not in DEDUPED,
                # A scope holds every date that a recomputed key was on, so no key is left elsewhere.
                keys_can_move=(keys_can_move or {}).get(name, False if scope is not None else None),
                observe=observe,
                scope=scope,
                quarantine=(
                    sink.Quarantine(checks.violations(asset.spec), f"{warehouse.quarantine(name)}/batch={source_month or 'all'}")
                    if quarantine
                    else None
                ),
                before_commit=(lambda found: unfinished.note(name, found)) if unfinished and asset.spec.partition_by else None,
            )
            report.set_aside[name] = outcome.get("set_aside", 0)
            if asset.spec.partition_by:
                touched[name] = touched.get(name, set()) | {value[0] for value in outcome["seen"]}
            if outcome.get("empty"):  # nothing was written, so no row was checked
                report.rows[name] = built.get["rows"] if outcome["seen"] else 0
                return
            report.rows[name] = built.get["rows"]
            if check:
                if metrics:
                    report.failures.extend(checks.column_failures(asset.spec, row_checks.get))
                table = warehouse.read(name)
                if lookback is not None and asset.spec.partition_by:
                    # Only the window's partitions were rewritten; older ones passed when
                    # written, and merges remove moved keys, so no duplicate can span both.
                    table = lookback.daily(table)
                elif source_month is not None and asset.spec.partition_by:
                    table = _on_dates(table, touched[name], whole_months=False)
                keyed = checks.key_checks(table, asset.spec)
                if keyed is not None:
                    report.failures.extend(checks.failed(keyed))

        return run

    try:
        for wave in waves():
            names = [n for n in wave if n in needed]
            if not names:
                continue
            report.seconds.update(_run_all(spark, {n: one(n) for n in names}, parallel))
            if strict and report.failures:
                raise checks.QualityCheckError(f"quality checks failed: {report.failures}")
    finally:
        if times:
            times.drop()
    report.touched = {n: touched[n] for n in needed if n in touched}
    if unfinished and needed == set(ASSETS):
        unfinished.clear()
    return report


def run_month(
    spark: SparkSession,
    raw_base: str,
    year: int,
    month: int,
    warehouse: Warehouse,
    *,
    incremental: bool = True,
    spread: bool = False,
    **run_options,
) -> RunReport:
    """The monthly job: one archive month -> staging -> medallion run.

    The month is a partition of its own in staging: running it again replaces
    its rows and no other month's, rows without a date or dated elsewhere
    included.  ``incremental`` recomputes what that month touches (see
    :func:`run_assets`); without it the assets recompute their whole history.
    ``spread`` goes to :func:`stage_raw`.
    """
    source_month = year * 100 + month
    base = scratch_path(spark, "raw-base")
    scanned = Observation("raw_scan")
    try:
        raw = read_raw(spark, month_glob(raw_base, year, month), corrupt=True)
        frames = stage_raw(spark, raw, persist_base=base, scanned=scanned, spread=spread)
        staging_seconds = write_staging(warehouse, frames, source_month=source_month)
    finally:
        sink.delete_path(spark, base.rpartition("/")[0])
    if incremental:
        run_options["source_month"] = source_month
    report = run_assets(spark, warehouse, **run_options)
    report.scanned = scanned.get
    report.seconds.update(staging_seconds)
    return report
