"""Gold: monthly productivity, repository scorecard, daily commit stats and activity.

Plain grouped aggregates; Spark aggregates partially on the map side, so a
hot group costs one partial row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions.columns import count_where, month_start, ratio
from forgelake.operators.common import stamp
from forgelake.operators.staging import PULL_REQUEST, PUSH
from forgelake.specs import (
    ACTIVITY_BY_DAY,
    COMMIT_STATS_BY_DAY,
    DEVELOPER_PRODUCTIVITY_MONTHLY,
    REPO_HEALTH_SCORECARD,
)


def _zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def developer_productivity_monthly(activity: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """A3: PR events per (year, month, developer, repo).

    ``total_prs`` counts PR events; averages treat missing line counts as 0.
    The ``least(.., 1.0)`` cap never binds but is kept as declared.
    """
    merged = count_where(F.col("is_merged") == F.lit(True))
    total = F.count(F.lit(1))
    added = _zero_if_null(F.sum("lines_added")).cast("bigint")
    deleted = _zero_if_null(F.sum("lines_deleted")).cast("bigint")
    agg = (
        activity.filter(F.col("event_type") == PULL_REQUEST)
        .groupBy("year", "month", "developer_login", "repo_name")
        .agg(
            total.alias("total_prs"),
            merged.alias("merged_prs"),
            F.least(ratio(merged, total), F.lit(1.0)).alias("merge_rate"),
            added.alias("total_lines_added"),
            deleted.alias("total_lines_deleted"),
            (added - deleted).alias("net_loc"),
            F.avg(_zero_if_null(F.col("files_changed"))).alias("avg_files_changed"),
            F.avg(_zero_if_null(F.col("lines_added")) + _zero_if_null(F.col("lines_deleted"))).alias("avg_pr_size"),
        )
        .withColumn("month_start_date", month_start(F.col("year"), F.col("month")))
    )
    return stamp(agg, DEVELOPER_PRODUCTIVITY_MONTHLY.columns, ingested_at)


def repo_health_scorecard(summary: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """A4: month roll-up of the daily repository summary.

    ``unique_contributors`` is the peak daily value and divides the commits;
    ``merge_rate`` is a ratio of sums.
    """
    peak = F.max("unique_contributors")
    commits = F.sum("total_commits")
    agg = (
        summary.groupBy("repo_name", "year", "month")
        .agg(
            F.sum("total_events").alias("total_events"),
            peak.alias("unique_contributors"),
            commits.alias("total_commits"),
            F.sum("total_prs").alias("total_prs"),
            F.sum("merged_prs").alias("merged_prs"),
            ratio(F.sum("merged_prs"), F.sum("total_prs")).alias("merge_rate"),
            (F.sum("total_lines_added") - F.sum("total_lines_deleted")).alias("net_loc"),
            ratio(commits, peak).alias("avg_commits_per_contributor"),
        )
        .withColumn("month_start_date", month_start(F.col("year"), F.col("month")))
    )
    return stamp(agg, REPO_HEALTH_SCORECARD.columns, ingested_at)


def commit_stats_by_day(activity: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """A5: pushes per (date, repo, actor, author); the match flag is computed on the group keys."""
    agg = (
        activity.filter(F.col("event_type") == PUSH)
        .groupBy("date", "repo_name", F.col("developer_login").alias("actor_login"), "author_name")
        .agg(F.count(F.lit(1)).alias("total_commits"))
        .withColumn("is_author_actor_match", F.col("actor_login") == F.col("author_name"))
    )
    return stamp(agg, COMMIT_STATS_BY_DAY.columns, ingested_at)


def activity_by_day(activity: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Rows, distinct repositories and distinct developers per (date, event_type)."""
    agg = activity.groupBy("date", "month", "year", "event_type").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("repo_name").alias("unique_repos"),
        F.count_distinct("developer_login").alias("unique_actors"),
    )
    return stamp(agg, ACTIVITY_BY_DAY.columns, ingested_at)
