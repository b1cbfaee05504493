"""Hot-key probe: one key holds a third of all rows; how balanced are the reducers?

Usage: python tools/skew_probe.py [sf_dir] [cpus] [shuffle_partitions=64]

Builds staging events from the driver fixture, then makes a third of the rows
share one event_id (a burst of re-delivered copies) and one repository (a hot
repo).  It runs the bronze dedup (W1), the event-time join (J1, reading bronze
events from a written table as the pipeline does, with AQE's skew thresholds
scaled down to this data size) and the daily repository summary (A2, two
exact distinct counts) into Spark's ``noop`` sink, with an event log in a
fresh scratch folder.  It then prints, for every stage that reads a shuffle,
the task count and the largest and mean shuffle-read records per task.  No
UI or REST server is used.
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from forgelake.operators import bronze, silver  # noqa: E402
from forgelake.plans.pipeline import fixture_staging  # noqa: E402
from forgelake.session import build_session, scratch_path  # noqa: E402
from stage_times import events as log_events  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    # many reducers, as on a cluster: a key holding a third of the rows is then far
    # above the median partition, which is what AQE's skew rules look for
    reducers = int(sys.argv[3]) if len(sys.argv) > 3 else 64
    log_dir = tempfile.mkdtemp(prefix="run-")
    spark = build_session(
        f"local[{cpus}]",
        app="forgelake-skew-probe",
        conf={
            "spark.sql.shuffle.partitions": str(reducers),
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            # keep every reducer visible: no coalescing of small partitions
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            # joins: no broadcast (as for large tables), skew thresholds scaled to this data size
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    staged = fixture_staging(spark, sf_dir)["staging_events"].repartition(cpus)
    hot = (F.xxhash64("event_id") % 3) == 0  # a third of the rows
    skewed = staged.withColumns(
        {
            "event_id": F.when(hot, F.lit("hot-event")).otherwise(F.col("event_id")),
            "repo_name": F.when(hot, F.lit("org/hot")).otherwise(F.col("repo_name")),
        }
    )
    n_rows = skewed.count()
    n_hot = skewed.filter(F.col("event_id") == "hot-event").count()

    spark.sparkContext.setJobDescription("W1 dedup")
    bronze.bronze_events(skewed).write.format("noop").mode("overwrite").save()

    # J1 + W2: the hot event's copies are pushes; bronze events hold one row for it
    frames = fixture_staging(spark, sf_dir)
    commits = frames["staging_commits"].repartition(cpus)
    hot_push = (F.xxhash64("event_id") % 3) == 0
    commits = commits.withColumn("event_id", F.when(hot_push, F.lit("hot-event")).otherwise(F.col("event_id")))
    # as in a pipeline run, the join reads bronze events from a written table
    written = scratch_path(spark, "skew-bronze-events")
    spark.sparkContext.setJobDescription("write bronze")
    bronze.bronze_events(skewed).write.parquet(written)
    deduped = spark.read.parquet(written)
    spark.sparkContext.setJobDescription("J1 join")
    bronze.bronze_commits(commits, deduped).write.format("noop").mode("overwrite").save()

    activity = skewed.select(
        "event_id",
        F.col("actor_login").alias("developer_login"),
        "created_at",
        "date",
        "month",
        "year",
        "repo_name",
        F.col("type").alias("event_type"),
        F.lit(None).cast("bigint").alias("lines_added"),
        F.lit(None).cast("bigint").alias("lines_deleted"),
        F.lit(None).cast("boolean").alias("is_merged"),
    )
    spark.sparkContext.setJobDescription("A2 repo summary")
    silver.repo_summary(activity).write.format("noop").mode("overwrite").save()
    spark.stop()

    desc, reads = {}, {}
    for e in log_events(log_dir):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            d = e.get("Properties", {}).get("spark.job.description")
            for sid in e["Stage IDs"]:
                desc[sid] = d
        elif kind == "SparkListenerTaskEnd":
            r = e.get("Task Metrics", {}).get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            if r:
                reads.setdefault(e["Stage ID"], []).append(r)
    print(f"{n_rows} rows, {n_hot} ({n_hot / n_rows:.0%}) on the hot event_id and the hot repository")
    for sid, r in sorted(reads.items()):
        if desc.get(sid):
            mean = sum(r) / len(r)
            print(f"{desc[sid]:16s} stage {sid:3d}: {len(r):3d} tasks, max {max(r):6d} / mean {mean:7.0f} shuffle records read")


if __name__ == "__main__":
    main()
