"""Bronze: deduplicated events, pushes and pull-request rows.

Ties on the event time are broken by the remaining columns (ascending, NULLs
last) so every run keeps the same row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.operators.common import stamp
from forgelake.operators.dedup import asc, latest_per_key, version_order
from forgelake.specs import BRONZE_COMMITS, BRONZE_EVENTS, BRONZE_PRODUCTIVITY


def bronze_events(staging_events: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Latest row per event_id."""
    latest = latest_per_key(staging_events, ["event_id"], version_order(BRONZE_EVENTS))
    return stamp(latest, BRONZE_EVENTS.columns, ingested_at)


def event_time_by_id(bronze: DataFrame) -> DataFrame:
    """A1: ``MAX(created_at)`` per event_id.

    The layer builders join on ``bronze.select(event_id, created_at)``
    directly: bronze_events is unique on event_id (a declared, checked key),
    so this aggregate would repeat work without changing a value.
    """
    return bronze.groupBy("event_id").agg(F.max("created_at").alias("created_at"))


def _event_times(bronze: DataFrame) -> DataFrame:
    return bronze.select("event_id", "created_at")


def bronze_commits(
    staging_commits: DataFrame, bronze: DataFrame, ingested_at: Column | None = None
) -> DataFrame:
    """J1 + W2: attach the event time (inner join drops pushes with unknown events), then latest row per SHA.

    The SHA alone is the key: a SHA pushed to two repositories keeps only the
    later push.
    """
    joined = staging_commits.join(_event_times(bronze), "event_id", "inner")
    latest = latest_per_key(joined, ["commit_sha"], version_order(BRONZE_COMMITS))
    return stamp(latest, BRONZE_COMMITS.columns, ingested_at)


def bronze_productivity(
    staging_productivity: DataFrame, bronze: DataFrame, ingested_at: Column | None = None
) -> DataFrame:
    """P11 + W3 + J2: drop empty developers, latest row per (event, developer), attach the event time.

    The event time is constant per event_id, so replayed copies always tie and
    the tie-breakers alone decide: they collapse before the join's shuffle.
    """
    rows = staging_productivity.filter(F.col("developer_login").isNotNull() & (F.col("developer_login") != ""))
    latest = latest_per_key(rows, ["event_id", "developer_login"], asc(*BRONZE_PRODUCTIVITY.ties))
    return stamp(latest.join(_event_times(bronze), "event_id", "inner"), BRONZE_PRODUCTIVITY.columns, ingested_at)
