"""Driver test tables -> archive-shaped raw events.

The driver ships a flat ``events`` table (event_id, ts, user_id, event_type,
value, props).  This module maps it deterministically onto the nested raw
event record so every layer sees duplicates, bots, NULL logins, NULL repos,
shared SHAs and both NULL and non-NULL line counts.  It is a pure column
mapping: one narrow scan, no shuffle, work grows linearly with ``events``.

``created_at`` stays the table's ``timestamp_ntz`` (UTC wall clock), so no
result depends on the session time zone; :func:`to_archive_json` renders it
as the archive's ISO string for the JSON round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelake.sources.raw import raw_event_schema

# --- fixed values of the fixture mapping ---------------------------------------
EVENT_TYPES = {"click": "PushEvent", "purchase": "PullRequestEvent", "view": "WatchEvent", "signup": "ForkEvent"}
OTHER_EVENT_TYPE = "IssuesEvent"
PR_ACTIONS = ("opened", "closed", "synchronize", "reopened")  # chosen by k % 4
REPO_COUNT = 25  # repo_name = org/repo-{k % 25}
NULL_REPO_K = 99  # k = 99 -> NULL repo
LOGIN_CYCLE = 20  # user_id % 20: 0 "u{id}[bot]", 1 "u{id}-bot", 2 "U{id}[BOT]", 3 NULL, else "u{id}"
NULL_LOC_EVERY = 10  # k % 10 = 0 -> NULL line counts
FILES_MOD = 13  # files_changed = k % 13
SHA_GROUP = 5  # head = md5(floor(event_id / 5)): five neighbouring events share a SHA
ARCHIVE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
# ------------------------------------------------------------------------------


def _struct_like(target: T.StructType, values: dict) -> Column:
    """A struct with every field of ``target``; fields not in ``values`` are typed NULLs."""
    parts = []
    for f in target.fields:
        v = values.get(f.name)
        if isinstance(f.dataType, T.StructType):
            col = _struct_like(f.dataType, v or {}) if v is not None else F.lit(None).cast(f.dataType)
        elif v is None:
            col = F.lit(None).cast(f.dataType)
        else:
            col = v.cast(f.dataType)
        parts.append(col.alias(f.name))
    return F.struct(*parts)


def raw_from_events(events: DataFrame) -> DataFrame:
    """Map the driver ``events`` table onto the raw archive record."""
    # A column of its own, so a row's JSON is parsed once however many fields need it (it is inlined otherwise).
    events = events.withColumn("__k", F.get_json_object("props", "$.k").cast("int"))
    k = F.col("__k")
    uid = F.col("user_id")
    eid = F.col("event_id")
    phase = uid % LOGIN_CYCLE
    login = (
        F.when(phase == 0, F.concat(F.lit("u"), uid.cast("string"), F.lit("[bot]")))
        .when(phase == 1, F.concat(F.lit("u"), uid.cast("string"), F.lit("-bot")))
        .when(phase == 2, F.concat(F.lit("U"), uid.cast("string"), F.lit("[BOT]")))
        .when(phase == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("u"), uid.cast("string")))
    )
    etype = F.lit(OTHER_EVENT_TYPE)
    for source, target in reversed(list(EVENT_TYPES.items())):
        etype = F.when(F.col("event_type") == source, F.lit(target)).otherwise(etype)
    action = F.element_at(F.array(*[F.lit(a) for a in PR_ACTIONS]), (k % len(PR_ACTIONS)) + 1)
    has_loc = (k % NULL_LOC_EVERY) != 0
    schema = raw_event_schema()
    fields = {f.name: f.dataType for f in schema.fields}
    return events.select(
        (eid - F.when(eid % 10 == 9, 1).otherwise(0)).cast("string").alias("id"),
        etype.alias("type"),
        F.col("ts").cast("timestamp_ntz").alias("created_at"),
        _struct_like(fields["actor"], {"id": uid, "login": login, "display_login": login}).alias("actor"),
        _struct_like(
            fields["repo"],
            {"name": F.when(k == NULL_REPO_K, F.lit(None)).otherwise(F.concat(F.lit("org/repo-"), (k % REPO_COUNT).cast("string")))},
        ).alias("repo"),
        _struct_like(
            fields["payload"],
            {
                "head": F.md5(F.floor(eid / SHA_GROUP).cast("bigint").cast("string")),
                "action": action,
                "pull_request": {
                    "additions": F.when(has_loc, F.floor(F.col("value") * 10)),
                    "deletions": F.when(has_loc, F.floor(F.col("value"))),
                    "changed_files": F.when(has_loc, k % FILES_MOD),
                },
            },
        ).alias("payload"),
    )


def read_fixture_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return raw_from_events(events.select("event_id", "ts", "user_id", "event_type", "value", "props"))


def with_replayed_pull_requests(productivity: DataFrame) -> DataFrame:
    """Simulate a non-idempotent re-run of the staging append.

    Every fourth PR row (id % 4 = 0) is appended again as 'reopened' with NULL
    line counts, and the next quarter (id % 4 = 1) again as 'closed'.  The
    copies share event_id, developer and event time with the originals, so
    bronze deduplication must pick one by its tie-breakers.
    """
    n = F.col("event_id").try_cast("bigint") % 4
    reopened = {
        "pr_state": F.lit("reopened"),
        "is_merged": F.lit(False),
        "lines_added": F.lit(None).cast("bigint"),
        "lines_deleted": F.lit(None).cast("bigint"),
        "files_changed": F.lit(None).cast("bigint"),
    }
    closed = {"pr_state": F.lit("closed"), "is_merged": F.lit(True)}
    columns = productivity.columns

    def row(changed: dict) -> Column:
        return F.struct(*(changed.get(c, F.col(c)).alias(c) for c in columns))

    # One scan: every row comes alone or with its copy.
    copies = F.when(n == 0, F.array(row({}), row(reopened))).when(n == 1, F.array(row({}), row(closed))).otherwise(F.array(row({})))
    return productivity.select(F.inline(copies))


def to_archive_json(raw: DataFrame) -> DataFrame:
    """Render ``created_at`` as the archive's ISO string (for the JSON round trip)."""
    return raw.withColumn("created_at", F.date_format("created_at", ARCHIVE_TIME_FORMAT))


#: ids of one month's fixture lie below this; divisible by 4, so the replay rule holds in every month
MONTH_IDS = 1_000_000_000_000


def month_of(raw: DataFrame, n: int) -> DataFrame:
    """Archive month ``n`` (1, 2, ..): the fixture shifted by 31 days a month, with ids and SHAs of its own.

    Ids divisible by 97 carry a time of the month after (strays), ids that
    leave 1 on division by 89 carry none.
    """
    key = F.col("id").cast("bigint")
    days = F.lit(31 * (n - 1)) + F.when(key % 97 == 0, 31).otherwise(0)
    at = F.when(key % 89 != 1, F.col("created_at") + F.make_dt_interval(days=days))
    head = F.concat(F.col("payload.head"), F.lit("" if n == 1 else str(n)))
    return raw.withColumns(
        {
            "created_at": at,
            "payload": F.col("payload").withField("head", head),
            "id": (key + (n - 1) * MONTH_IDS).cast("string"),
        }
    )


def overlapping_month_of(raw: DataFrame, n: int) -> DataFrame:
    """Like :func:`month_of`, but month 2 delivers ids and SHAs of month 1 again.

    Ids divisible by 3 come back 31 days later (a later version of the event), those that
    leave 1 on division by 3 come back with their old time; of the ids that come back, those divisible by 7
    have another login.  An event that comes back keeps its SHA; of the new ones, those divisible by 5
    push a SHA of month 1.
    """
    if n == 1:
        return month_of(raw, 1)
    key = F.col("id").cast("bigint")
    again = key % 3 != 2
    login = F.when(again & (key % 7 == 0), F.concat(F.col("actor.login"), F.lit("x"))).otherwise(F.col("actor.login"))
    head = F.when(again | (key % 5 == 0), F.col("payload.head")).otherwise(F.concat(F.col("payload.head"), F.lit(str(n))))
    days = F.when(key % 3 != 1, 31 * (n - 1)).otherwise(0) + F.when(key % 97 == 0, 31).otherwise(0)
    at = F.when(key % 89 != 1, F.col("created_at") + F.make_dt_interval(days=days))
    return raw.withColumns(
        {
            "created_at": at,
            "actor": F.col("actor").withField("login", login),
            "payload": F.col("payload").withField("head", head),
            "id": F.when(again, key).otherwise(key + (n - 1) * MONTH_IDS).cast("string"),
        }
    )


def dirty(raw: DataFrame) -> DataFrame:
    """The fixture with rows that checks and guards are for: NULL ids, times and types, '' logins, negative line counts."""
    key = F.col("id").cast("bigint")
    lines = F.col("payload.pull_request.additions")
    return raw.withColumns(
        {
            "id": F.when(key % 101 != 7, F.col("id")),
            "type": F.when(key % 19 != 5, F.col("type")),
            "created_at": F.when(key % 89 != 1, F.col("created_at")),
            "actor": F.col("actor").withField("login", F.when(key % 17 == 3, F.lit("")).otherwise(F.col("actor.login"))),
            "payload": F.col("payload").withField("pull_request.additions", F.when(key % 11 == 0, -lines).otherwise(lines)),
        }
    )


def over_a_year_end(raw: DataFrame) -> DataFrame:
    """The fixture spread over three months back: ids by remainder of 3 are 0, 31 or 62 days earlier."""
    days = -31 * (F.col("id").cast("bigint") % 3).cast("int")
    return raw.withColumn("created_at", F.col("created_at") + F.make_dt_interval(days=days))
