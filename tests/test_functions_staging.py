"""Scalar helpers, the raw reader and the staging projections."""

from __future__ import annotations

import json

from conftest import d, ts
from pyspark.sql import functions as F

from forgelake.functions.columns import event_date_parts, has_bot_marker, is_bot_login, month_start, ratio
from forgelake.operators import staging as stg
from forgelake.sources.raw import month_glob, read_raw


def test_bot_rule_is_case_insensitive_and_null_preserving(spark):
    logins = ["builder[bot]", "x-BOT", "Foo[BOT]", "my-bot-x", "robot", "Autopilot", None]
    df = spark.createDataFrame([(x,) for x in logins], "login string")
    got = [r[0] for r in df.select(is_bot_login(F.col("login"))).collect()]
    assert got == [True, True, True, False, False, False, None]


def test_silver_bot_marker_is_literal_and_case_sensitive(spark):
    df = spark.createDataFrame([("a[bot]",), ("A[BOT]",), ("x-bot",), ("b",)], "login string")
    assert [r[0] for r in df.select(has_bot_marker(F.col("login"))).collect()] == [True, False, False, False]


def test_event_time_from_iso_string_ignores_session_zone(spark):
    rows = [("2024-01-01T23:00:07Z",), ("2024-01-01T23:00:07+02:00",), ("not a time",), (None,)]
    df = spark.createDataFrame(rows, "created_at string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        parts = event_date_parts(F.col("created_at"), df.schema["created_at"].dataType)
        got = df.select(*[c.alias(k) for k, c in parts.items()]).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got[0] == (ts("2024-01-01 23:00:07"), d("2024-01-01"), 1, 2024)
    assert got[1].created_at == ts("2024-01-01 21:00:07")  # instant shifted to UTC wall time
    assert got[1].date == d("2024-01-01")  # date is the day as written
    assert tuple(got[2]) == (None, None, None, None)  # malformed: NULL, not a failed job
    assert tuple(got[3]) == (None, None, None, None)


def test_ratio_and_month_start(spark):
    df = spark.createDataFrame([(1, 2, 2024, 3), (1, 0, 2025, 12), (None, 3, None, 1)], "a bigint, b bigint, y int, m int")
    got = df.select(ratio(F.col("a"), F.col("b")), month_start(F.col("y"), F.col("m"))).collect()
    assert [tuple(r) for r in got] == [(0.5, d("2024-03-01")), (None, d("2025-12-01")), (None, None)]


def test_month_glob():
    assert month_glob("hdfs:///raw/events/", 2024, 3) == "hdfs:///raw/events/2024-03/*json.gz"


def _raw_lines(tmp_path):
    events = [
        {"id": "1", "type": "PullRequestEvent", "created_at": "2024-01-05T10:00:00Z",
         "actor": {"id": 7, "login": "alice"}, "repo": {"name": "o/r"},
         "payload": {"action": None, "pull_request": {"number": 3, "additions": 5, "deletions": 2, "changed_files": 1}}},
        {"id": 2, "type": "PushEvent", "created_at": "2024-01-05T11:00:00Z",
         "actor": {"id": "not-a-number", "login": "bob"}, "repo": {"name": "o/r"}, "payload": {"head": "abc"}},
        {"id": "3", "type": "PushEvent", "created_at": "garbage", "actor": {"login": "ci-bot"}, "repo": {"name": "o/r"}},
    ]
    lines = [json.dumps(e) for e in events] + ["{this is not json"]
    p = tmp_path / "2024-01"
    p.mkdir()
    (p / "part.json").write_text("\n".join(lines) + "\n")
    return str(p / "*.json")


def test_raw_reader_is_permissive(spark, tmp_path):
    raw = read_raw(spark, _raw_lines(tmp_path))
    rows = raw.select("id", "actor.id", "actor.login").collect()
    assert len(rows) == 4
    assert rows[1] == ("2", None, "bob")  # numeric id read as text; bad nested value -> NULL field only
    assert tuple(rows[3]) == (None, None, None)  # broken line -> all-NULL row


def test_staging_split_and_projections(spark, tmp_path):
    base = stg.with_event_dates(read_raw(spark, _raw_lines(tmp_path)))
    bots, clean = stg.split_bots(base)
    assert [r.id for r in bots.collect()] == ["3"]
    assert sorted(r.id for r in clean.collect()) == ["1", "2"]  # the all-NULL row lands in neither side
    ev = stg.staging_events(clean).orderBy("event_id").collect()
    assert ev[0].created_at == ts("2024-01-05 10:00:00") and ev[0].date == d("2024-01-05")
    commits = stg.staging_commits(clean).collect()
    assert [(c.commit_sha, c.author_name, c.commit_message) for c in commits] == [("abc", "bob", None)]
    pr = stg.staging_productivity(clean).collect()[0]
    assert (pr.lines_added, pr.lines_deleted, pr.files_changed) == (5, 2, 1)
    assert pr.pr_state is None and pr.is_merged is None  # NULL action -> NULL, not counted as merged
    # a bot whose date cannot be parsed keeps NULL date parts
    assert bots.collect()[0].date is None
