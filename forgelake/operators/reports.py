"""Dashboard queries over gold / silver tables.

Top-k reports end in ``orderBy(...).limit(n)``, which Spark plans as
TakeOrderedAndProject: every task keeps its own top n, so only n rows per
task move.  Ties are broken by name.  Shares use a scalar subquery for the
grand total (no cross join, no single-partition window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.functions.columns import ratio
from forgelake.operators.staging import PULL_REQUEST, PUSH

# --- fixed values: the event types charted in the daily-volume report --------
DAILY_VOLUME_TYPES = {
    "push_events": PUSH,
    "create_events": "CreateEvent",
    "pull_request_events": PULL_REQUEST,
    "watch_events": "WatchEvent",
}
# -----------------------------------------------------------------------------
TOP_N = 10


def _top(df: DataFrame, key: str, measure: str, n: int) -> DataFrame:
    return (
        df.groupBy(key)
        .agg(F.sum(measure).cast("bigint").alias(measure))
        .orderBy(F.col(measure).desc_nulls_last(), F.col(key).asc_nulls_last())
        .limit(n)
    )


def top_developers_by_commits(commit_stats: DataFrame, n: int = TOP_N) -> DataFrame:
    """R1."""
    return _top(commit_stats, "actor_login", "total_commits", n)


def commits_by_repo(commit_stats: DataFrame, n: int = TOP_N) -> DataFrame:
    """R2."""
    return _top(commit_stats, "repo_name", "total_commits", n)


def event_share(activity_by_day: DataFrame) -> DataFrame:
    """Events per type and their share of all events."""
    per_type = activity_by_day.groupBy("event_type").agg(F.sum("total_events").cast("bigint").alias("total_events"))
    total = activity_by_day.select(F.sum("total_events")).scalar()
    return per_type.withColumn("share", ratio(F.col("total_events"), total))


def daily_volume(activity_by_day: DataFrame) -> DataFrame:
    """One row per day, one column per charted event type (0 when absent)."""
    cols = [
        F.sum(F.when(F.col("event_type") == t, F.col("total_events")).otherwise(F.lit(0))).cast("bigint").alias(name)
        for name, t in DAILY_VOLUME_TYPES.items()
    ]
    return activity_by_day.groupBy("date").agg(*cols)


def top_pr_developers(monthly: DataFrame, n: int = TOP_N) -> DataFrame:
    """R5."""
    return _top(monthly, "developer_login", "total_prs", n)


def merge_rate_vs_volume(monthly: DataFrame) -> DataFrame:
    """Per developer, PR volume and the ratio of merged to all PR events."""
    return monthly.groupBy("developer_login").agg(
        F.sum("total_prs").cast("bigint").alias("total_prs"),
        F.sum("merged_prs").cast("bigint").alias("merged_prs"),
        ratio(F.sum("merged_prs"), F.sum("total_prs")).alias("merge_rate"),
    )


def merged_by_month(monthly: DataFrame) -> DataFrame:
    """R7."""
    return monthly.groupBy("year", "month", "month_start_date").agg(
        F.sum("merged_prs").cast("bigint").alias("merged_prs"),
        (F.sum("total_prs") - F.sum("merged_prs")).cast("bigint").alias("unmerged_prs"),
    )


def pr_size_by_month(activity: DataFrame) -> DataFrame:
    """Mean lines touched per PR event, over all PR events of the month (not a mean of means)."""
    size = F.coalesce(F.col("lines_added"), F.lit(0)) + F.coalesce(F.col("lines_deleted"), F.lit(0))
    return (
        activity.filter(F.col("event_type") == PULL_REQUEST)
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("total_prs"), F.avg(size).alias("avg_pr_size"))
    )


def loc_churn_by_month(monthly: DataFrame) -> DataFrame:
    """R9."""
    return monthly.groupBy("year", "month").agg(
        F.sum("total_lines_added").cast("bigint").alias("lines_added"),
        F.sum("total_lines_deleted").cast("bigint").alias("lines_deleted"),
    )
