"""Table contracts: schema, key, layout and declared quality checks.

One ``TableSpec`` per staging and medallion table.  Spark does not enforce
keys, so they are verified by :mod:`forgelake.plans.checks`; partition and
cluster columns drive the Parquet layout in :mod:`forgelake.sinks.parquet`.

``created_at`` is kept as ``timestamp_ntz`` holding the UTC wall-clock time
of the event, so no result depends on the session time zone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

NOT_NULL = "not_null"
NOT_NEGATIVE = "not_negative"
UNIQUE = "unique"
UNIQUE_KEY = "unique_key"


@dataclass(frozen=True)
class TableSpec:
    name: str
    ddl: str
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    not_negative: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    #: Which row of a key is the latest: these descending (NULLs last), then the ties ascending (NULLs last).
    latest_by: tuple[str, ...] = ()
    ties: tuple[str, ...] = ()
    comments: dict[str, str] = field(default_factory=dict)
    stamped: bool = True  # stored with the run's ``ingested_at`` load time

    @property
    def schema(self) -> T.StructType:
        """Logical columns (what the builders produce and queries return)."""
        parsed = T.StructType.fromDDL(self.ddl)
        return T.StructType(
            [
                T.StructField(f.name, f.dataType, True, {"comment": self.comments[f.name]} if f.name in self.comments else {})
                for f in parsed.fields
            ]
        )

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def stored_schema(self) -> T.StructType:
        """Columns as written: the logical ones plus ``ingested_at`` when stamped."""
        s = self.schema
        if self.stamped:
            s = s.add("ingested_at", T.TimestampType(), True, {"comment": "Load time of the run that wrote the row."})
        return s

    @property
    def stored_columns(self) -> list[str]:
        return [f.name for f in self.stored_schema.fields]

    def checks(self) -> list[tuple[str, str]]:
        """(column, kind) pairs in declaration order, plus one key check."""
        out = [(c, NOT_NULL) for c in self.not_null]
        out += [(c, NOT_NEGATIVE) for c in self.not_negative]
        out += [(c, UNIQUE) for c in self.unique]
        if self.keys:
            out.append((",".join(self.keys), UNIQUE_KEY))
        return out


_DATE_PARTS = "date date, month int, year int"

STAGING_EVENTS = TableSpec(
    name="staging_events",
    ddl=f"event_id string, type string, created_at timestamp_ntz, {_DATE_PARTS}, repo_name string, actor_login string",
    partition_by=("year", "month", "date"),
    cluster_by=("type", "repo_name"),
    stamped=False,
)

STAGING_COMMITS = TableSpec(
    name="staging_commits",
    ddl=(
        f"event_id string, {_DATE_PARTS}, repo_name string, actor_login string, "
        "commit_sha string, commit_message string, author_name string"
    ),
    partition_by=("year", "month", "date"),
    cluster_by=("repo_name", "actor_login"),
    stamped=False,
)

STAGING_PRODUCTIVITY = TableSpec(
    name="staging_productivity",
    ddl=(
        f"event_id string, {_DATE_PARTS}, repo_name string, developer_login string, "
        "lines_added bigint, lines_deleted bigint, files_changed bigint, pr_state string, is_merged boolean"
    ),
    partition_by=("year", "month"),
    cluster_by=("repo_name", "developer_login"),
    stamped=False,
)

BRONZE_EVENTS = TableSpec(
    name="bronze_events",
    ddl=STAGING_EVENTS.ddl,
    keys=("event_id",),
    partition_by=("date",),
    cluster_by=("type", "repo_name", "actor_login"),
    not_null=("event_id",),
    unique=("event_id",),
    latest_by=("created_at",),
    ties=("type", "repo_name", "actor_login", "date"),
    comments={"event_id": "Archive id; one row per id.", "type": "Kind of event, e.g. PushEvent."},
)

BRONZE_COMMITS = TableSpec(
    name="bronze_commits",
    ddl=(
        f"event_id string, created_at timestamp_ntz, {_DATE_PARTS}, repo_name string, actor_login string, "
        "commit_sha string, commit_message string, author_name string"
    ),
    keys=("commit_sha",),
    partition_by=("date",),
    cluster_by=("repo_name", "actor_login"),
    not_null=("event_id", "created_at", "commit_sha"),
    latest_by=("created_at",),
    ties=("event_id", "actor_login", "repo_name", "date"),
    comments={"commit_sha": "Head SHA after the push; one row per SHA."},
)

BRONZE_PRODUCTIVITY = TableSpec(
    name="bronze_productivity",
    ddl=(
        f"event_id string, created_at timestamp_ntz, {_DATE_PARTS}, repo_name string, developer_login string, "
        "lines_added bigint, lines_deleted bigint, files_changed bigint, pr_state string, is_merged boolean"
    ),
    keys=("event_id", "developer_login"),
    partition_by=("date",),
    cluster_by=("repo_name", "developer_login"),
    not_null=("event_id", "date", "developer_login"),
    not_negative=("lines_added", "lines_deleted", "files_changed"),
    latest_by=("created_at",),
    ties=("repo_name", "date", "lines_added", "lines_deleted", "files_changed", "pr_state"),
)

SILVER_DEVELOPER_ACTIVITY = TableSpec(
    name="silver_developer_activity",
    ddl=(
        f"event_id string, developer_login string, created_at timestamp_ntz, {_DATE_PARTS}, repo_name string, "
        "event_type string, commit_sha string, author_name string, lines_added bigint, lines_deleted bigint, "
        "files_changed bigint, net_loc bigint, pr_state string, is_merged boolean"
    ),
    keys=("event_id", "developer_login", "event_type"),
    partition_by=("date",),
    cluster_by=("developer_login", "repo_name", "event_type"),
    not_null=("event_id", "developer_login", "event_type", "created_at", "date", "month", "year", "repo_name"),
    not_negative=("lines_added", "lines_deleted", "files_changed"),
    comments={
        "commit_sha": "Populated only for PushEvents.",
        "net_loc": "lines_added - lines_deleted; PullRequestEvents only.",
    },
)

SILVER_REPO_SUMMARY = TableSpec(
    name="silver_repo_summary",
    ddl=(
        "repo_name string, date date, created_at timestamp_ntz, month int, year int, total_events bigint, "
        "unique_contributors bigint, total_commits bigint, total_prs bigint, merged_prs bigint, merge_rate double, "
        "total_lines_added bigint, total_lines_deleted bigint"
    ),
    keys=("repo_name", "date"),
    partition_by=("date",),
    cluster_by=("repo_name", "year", "month"),
    not_null=("repo_name", "date", "created_at", "month", "year"),
    not_negative=(
        "total_events", "unique_contributors", "total_commits", "total_prs", "merged_prs",
        "total_lines_added", "total_lines_deleted",
    ),
    comments={"created_at": "Most recent event of the repository on this date.", "merge_rate": "NULL without PRs."},
)

DEVELOPER_PRODUCTIVITY_MONTHLY = TableSpec(
    name="developer_productivity_monthly",
    ddl=(
        "year int, month int, month_start_date date, developer_login string, repo_name string, total_prs bigint, "
        "merged_prs bigint, merge_rate double, total_lines_added bigint, total_lines_deleted bigint, net_loc bigint, "
        "avg_files_changed double, avg_pr_size double"
    ),
    keys=("year", "month", "developer_login", "repo_name"),
    cluster_by=("developer_login", "repo_name", "year"),
    not_null=("year", "month", "month_start_date", "developer_login", "repo_name"),
    not_negative=("total_prs", "merged_prs", "total_lines_added", "total_lines_deleted"),
)

REPO_HEALTH_SCORECARD = TableSpec(
    name="repo_health_scorecard",
    ddl=(
        "repo_name string, year int, month int, month_start_date date, total_events bigint, "
        "unique_contributors bigint, total_commits bigint, total_prs bigint, merged_prs bigint, merge_rate double, "
        "net_loc bigint, avg_commits_per_contributor double"
    ),
    keys=("repo_name", "year", "month"),
    cluster_by=("repo_name", "year", "month"),
    not_null=("repo_name", "month_start_date", "year", "month"),
    not_negative=("total_events", "unique_contributors", "total_commits", "total_prs", "merged_prs"),
    comments={"unique_contributors": "Largest of the daily contributor counts."},
)

COMMIT_STATS_BY_DAY = TableSpec(
    name="commit_stats_by_day",
    ddl=(
        "date date, repo_name string, actor_login string, author_name string, total_commits bigint, "
        "is_author_actor_match boolean"
    ),
    keys=("date", "repo_name", "actor_login", "author_name"),
    partition_by=("date",),
    cluster_by=("repo_name", "actor_login"),
    not_null=("date", "repo_name", "actor_login"),
    not_negative=("total_commits",),
)

ACTIVITY_BY_DAY = TableSpec(
    name="activity_by_day",
    ddl="date date, month int, year int, event_type string, total_events bigint, unique_repos bigint, unique_actors bigint",
    keys=("date", "event_type"),
    partition_by=("date",),
    cluster_by=("event_type", "year", "month"),
    not_null=("date", "event_type", "month", "year"),
    not_negative=("total_events", "unique_repos", "unique_actors"),
)

STAGING_TABLES = (STAGING_EVENTS, STAGING_COMMITS, STAGING_PRODUCTIVITY)

MEDALLION_TABLES = (
    BRONZE_EVENTS,
    BRONZE_COMMITS,
    BRONZE_PRODUCTIVITY,
    SILVER_DEVELOPER_ACTIVITY,
    SILVER_REPO_SUMMARY,
    DEVELOPER_PRODUCTIVITY_MONTHLY,
    REPO_HEALTH_SCORECARD,
    COMMIT_STATS_BY_DAY,
    ACTIVITY_BY_DAY,
)

SPECS = {s.name: s for s in STAGING_TABLES + MEDALLION_TABLES}
