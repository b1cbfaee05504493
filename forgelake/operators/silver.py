"""Silver: the unified developer timeline (U1) and daily repository summary (A2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions.columns import count_where, has_bot_marker, ratio, typed_null
from forgelake.operators.common import stamp
from forgelake.operators.staging import PULL_REQUEST, PUSH
from forgelake.specs import SILVER_DEVELOPER_ACTIVITY, SILVER_REPO_SUMMARY


def _human(login: str, repo: str = "repo_name") -> Column:
    """P9 + P10: login and repository present, login without the literal ``[bot]`` marker."""
    return F.col(login).isNotNull() & F.col(repo).isNotNull() & ~has_bot_marker(F.col(login))


def developer_activity(
    commits: DataFrame,
    productivity: DataFrame,
    events: DataFrame,
    ingested_at: Column | None = None,
) -> DataFrame:
    """UNION ALL of pushes, PR rows and all other events, 17 aligned columns.

    Narrow only: three filtered projections, no shuffle.  The third branch
    excludes push and PR types (a NULL type is dropped too).
    """
    cols = SILVER_DEVELOPER_ACTIVITY.columns
    pushes = commits.filter(_human("actor_login")).select(
        "event_id",
        F.col("actor_login").alias("developer_login"),
        "created_at",
        "date",
        "month",
        "year",
        "repo_name",
        F.lit(PUSH).alias("event_type"),
        "commit_sha",
        "author_name",
        typed_null("bigint").alias("lines_added"),
        typed_null("bigint").alias("lines_deleted"),
        typed_null("bigint").alias("files_changed"),
        typed_null("bigint").alias("net_loc"),
        typed_null("string").alias("pr_state"),
        typed_null("boolean").alias("is_merged"),
    )
    prs = productivity.filter(_human("developer_login")).select(
        "event_id",
        "developer_login",
        "created_at",
        "date",
        "month",
        "year",
        "repo_name",
        F.lit(PULL_REQUEST).alias("event_type"),
        typed_null("string").alias("commit_sha"),
        typed_null("string").alias("author_name"),
        "lines_added",
        "lines_deleted",
        "files_changed",
        (F.col("lines_added") - F.col("lines_deleted")).alias("net_loc"),
        "pr_state",
        "is_merged",
    )
    others = events.filter(_human("actor_login") & ~F.col("type").isin(PUSH, PULL_REQUEST)).select(
        "event_id",
        F.col("actor_login").alias("developer_login"),
        "created_at",
        "date",
        "month",
        "year",
        "repo_name",
        F.col("type").alias("event_type"),
        typed_null("string").alias("commit_sha"),
        typed_null("string").alias("author_name"),
        typed_null("bigint").alias("lines_added"),
        typed_null("bigint").alias("lines_deleted"),
        typed_null("bigint").alias("files_changed"),
        typed_null("bigint").alias("net_loc"),
        typed_null("string").alias("pr_state"),
        typed_null("boolean").alias("is_merged"),
    )
    timeline = pushes.select(*cols).unionByName(prs.select(*cols)).unionByName(others.select(*cols))
    return stamp(timeline, cols, ingested_at)


def repo_summary(activity: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """A2: one row per (repo_name, date).

    month / year depend on date, so grouping by them adds no groups.  The two
    exact distinct counts plan one Expand; its first shuffle is keyed by the
    distinct value too, so a hot repository-day spreads over all reducers.
    """
    etype = F.col("event_type")
    is_pr = etype == PULL_REQUEST
    merged = count_where(is_pr & (F.col("is_merged") == F.lit(True)))
    prs = count_where(is_pr)
    agg = activity.groupBy("repo_name", "date", "month", "year").agg(
        F.max("created_at").alias("created_at"),
        F.count_distinct("event_id").alias("total_events"),
        F.count_distinct("developer_login").alias("unique_contributors"),
        count_where(etype == PUSH).alias("total_commits"),
        prs.alias("total_prs"),
        merged.alias("merged_prs"),
        ratio(merged, prs).alias("merge_rate"),
        F.coalesce(F.sum("lines_added"), F.lit(0)).cast("bigint").alias("total_lines_added"),
        F.coalesce(F.sum("lines_deleted"), F.lit(0)).cast("bigint").alias("total_lines_deleted"),
    )
    return stamp(agg, SILVER_REPO_SUMMARY.columns, ingested_at)
