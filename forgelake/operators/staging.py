"""Raw events -> bot split -> three flat staging tables.

All of it is narrow (filter + project); the only cost is the raw scan, which
the staging job runs once (see :mod:`forgelake.plans.pipeline`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.functions.columns import event_date_parts, is_bot_login, typed_null
from forgelake.specs import STAGING_COMMITS, STAGING_EVENTS, STAGING_PRODUCTIVITY

PUSH = "PushEvent"
PULL_REQUEST = "PullRequestEvent"


def with_event_dates(raw: DataFrame) -> DataFrame:
    """P2 + P3: add date / month / year / is_bot; ``created_at`` becomes UTC ``timestamp_ntz``."""
    parts = event_date_parts(F.col("created_at"), raw.schema["created_at"].dataType)
    parts["is_bot"] = is_bot_login(F.col("actor.login"))
    return raw.withColumns(parts)


def split_bots(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bots, humans).  A NULL ``is_bot`` (NULL login) lands in neither."""
    return base.filter(F.col("is_bot")), base.filter(~F.col("is_bot"))


def staging_events(clean: DataFrame) -> DataFrame:
    """One flat row per event."""
    return clean.select(
        F.col("id").alias("event_id"),
        "type",
        "created_at",
        "date",
        "month",
        "year",
        F.col("repo.name").alias("repo_name"),
        F.col("actor.login").alias("actor_login"),
    ).select(*STAGING_EVENTS.columns)


def staging_commits(clean: DataFrame) -> DataFrame:
    """P5: one row per push; the SHA is the head after the push, the pusher stands in for the author."""
    return clean.filter(F.col("type") == PUSH).select(
        F.col("id").alias("event_id"),
        "date",
        "month",
        "year",
        F.col("repo.name").alias("repo_name"),
        F.col("actor.login").alias("actor_login"),
        F.col("payload.head").alias("commit_sha"),
        typed_null("string").alias("commit_message"),
        F.col("actor.login").alias("author_name"),
    ).select(*STAGING_COMMITS.columns)


def staging_productivity(clean: DataFrame) -> DataFrame:
    """P6 + P7: one row per pull-request event.

    ``is_merged`` is the proxy ``action = 'closed'`` (declined PRs count too;
    NULL action gives NULL).  Line counts come from the payload when the
    archive carries them, else they are NULL.
    """
    pr = F.col("payload.pull_request")
    return clean.filter(F.col("type") == PULL_REQUEST).select(
        F.col("id").alias("event_id"),
        "date",
        "month",
        "year",
        F.col("repo.name").alias("repo_name"),
        F.col("actor.login").alias("developer_login"),
        pr["additions"].cast("bigint").alias("lines_added"),
        pr["deletions"].cast("bigint").alias("lines_deleted"),
        pr["changed_files"].cast("bigint").alias("files_changed"),
        F.col("payload.action").alias("pr_state"),
        (F.col("payload.action") == F.lit("closed")).alias("is_merged"),
    ).select(*STAGING_PRODUCTIVITY.columns)

