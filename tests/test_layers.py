"""Bronze, silver and gold builders on hand rows."""

from __future__ import annotations

from conftest import d, ts

from forgelake import specs
from forgelake.operators import bronze, gold, silver


def _events(spark, rows):
    return spark.createDataFrame(rows, specs.STAGING_EVENTS.schema)


def _ev(eid, typ, at, repo="o/r", login="alice"):
    t = ts(at)
    return (eid, typ, t, t.date(), t.month, t.year, repo, login)


def test_bronze_events_keeps_latest_and_breaks_ties(spark):
    rows = [
        _ev("1", "PushEvent", "2024-01-01 10:00:00"),
        _ev("1", "PushEvent", "2024-01-01 11:00:00", repo="o/later"),
        _ev("2", "WatchEvent", "2024-01-01 10:00:00", repo="o/b"),
        _ev("2", "WatchEvent", "2024-01-01 10:00:00", repo="o/a"),  # tie on time: repo_name decides
        _ev(None, "WatchEvent", "2024-01-01 10:00:00"),
        _ev(None, "WatchEvent", "2024-01-01 12:00:00"),  # NULL ids form one group
    ]
    out = {r.event_id: r for r in bronze.bronze_events(_events(spark, rows)).collect()}
    assert set(out) == {"1", "2", None}
    assert out["1"].repo_name == "o/later"
    assert out["2"].repo_name == "o/a"
    assert out[None].created_at == ts("2024-01-01 12:00:00")


def test_bronze_commits_join_and_sha_key(spark):
    events = bronze.bronze_events(
        _events(spark, [_ev("1", "PushEvent", "2024-01-01 10:00:00"), _ev("2", "PushEvent", "2024-01-02 10:00:00")])
    )
    commits = spark.createDataFrame(
        [
            ("1", d("2024-01-01"), 1, 2024, "o/one", "alice", "sha", None, "alice"),
            ("2", d("2024-01-02"), 1, 2024, "o/two", "alice", "sha", None, "alice"),  # same SHA, later push wins
            ("9", d("2024-01-02"), 1, 2024, "o/two", "alice", "other", None, "alice"),  # unknown event: dropped
        ],
        specs.STAGING_COMMITS.schema,
    )
    out = bronze.bronze_commits(commits, events).collect()
    assert [(r.event_id, r.repo_name, r.created_at) for r in out] == [("2", "o/two", ts("2024-01-02 10:00:00"))]
    assert bronze.event_time_by_id(events).count() == 2


def test_bronze_productivity_guards_and_replay_ties(spark):
    events = bronze.bronze_events(_events(spark, [_ev("1", "PullRequestEvent", "2024-01-01 10:00:00")]))
    base = ("1", d("2024-01-01"), 1, 2024, "o/r")
    prod = spark.createDataFrame(
        [
            base + ("alice", 10, 2, 3, "opened", False),
            base + ("alice", None, None, None, "reopened", False),  # replayed copy with NULL lines loses
            base + ("", 1, 1, 1, "opened", False),  # empty login dropped
            base + (None, 1, 1, 1, "opened", False),  # NULL login dropped
        ],
        specs.STAGING_PRODUCTIVITY.schema,
    )
    out = bronze.bronze_productivity(prod, events).collect()
    assert len(out) == 1
    assert (out[0].developer_login, out[0].lines_added, out[0].pr_state) == ("alice", 10, "opened")
    assert out[0].created_at == ts("2024-01-01 10:00:00")


def _activity(spark, rows):
    return spark.createDataFrame(rows, specs.SILVER_DEVELOPER_ACTIVITY.schema)


def _act(eid, dev, at, repo, etype, sha=None, author=None, la=None, ld=None, fc=None, state=None, merged=None):
    t = ts(at)
    net = la - ld if la is not None and ld is not None else None
    return (eid, dev, t, t.date(), t.month, t.year, repo, etype, sha, author, la, ld, fc, net, state, merged)


def test_silver_union_filters(spark):
    events = bronze.bronze_events(
        _events(
            spark,
            [
                _ev("1", "WatchEvent", "2024-01-01 10:00:00"),
                _ev("2", None, "2024-01-01 10:00:00"),  # NULL type: dropped by NOT IN
                _ev("3", "ForkEvent", "2024-01-01 10:00:00", login="x[bot]"),  # literal marker: dropped
                _ev("4", "ForkEvent", "2024-01-01 10:00:00", login="X[BOT]"),  # case differs: kept in silver
                _ev("5", "PushEvent", "2024-01-01 10:00:00"),  # comes through the commits branch only
                _ev("6", "IssuesEvent", "2024-01-01 10:00:00", repo=None),  # NULL repo: dropped
            ],
        )
    )
    commits = bronze.bronze_commits(
        spark.createDataFrame([("5", d("2024-01-01"), 1, 2024, "o/r", "alice", "s", None, "alice")], specs.STAGING_COMMITS.schema),
        events,
    )
    prod = bronze.bronze_productivity(spark.createDataFrame([], specs.STAGING_PRODUCTIVITY.schema), events)
    out = silver.developer_activity(commits, prod, events).collect()
    assert sorted((r.event_id, r.event_type) for r in out) == [("1", "WatchEvent"), ("4", "ForkEvent"), ("5", "PushEvent")]


def test_repo_summary_and_scorecard(spark):
    rows = [
        _act("1", "a", "2024-01-01 10:00:00", "o/r", "PushEvent", sha="s1", author="a"),
        _act("2", "b", "2024-01-01 11:00:00", "o/r", "PullRequestEvent", la=10, ld=4, fc=2, state="closed", merged=True),
        _act("3", "b", "2024-01-01 12:00:00", "o/r", "PullRequestEvent", state="opened", merged=None),
        _act("4", "a", "2024-01-02 09:00:00", "o/r", "WatchEvent"),  # a day without PRs
        _act("5", "c", "2024-02-01 09:00:00", "o/r", "PushEvent", sha="s2", author="c"),
        _act("6", "c", "2025-02-01 09:00:00", "o/r", "PushEvent", sha="s3", author="c"),  # another year
    ]
    summary = {(r.repo_name, r.date): r for r in silver.repo_summary(_activity(spark, rows)).collect()}
    day1 = summary[("o/r", d("2024-01-01"))]
    assert (day1.total_events, day1.unique_contributors, day1.total_commits, day1.total_prs, day1.merged_prs) == (3, 2, 1, 2, 1)
    assert day1.merge_rate == 0.5 and day1.created_at == ts("2024-01-01 12:00:00")
    assert (day1.total_lines_added, day1.total_lines_deleted) == (10, 4)
    day2 = summary[("o/r", d("2024-01-02"))]
    assert day2.merge_rate is None and (day2.total_lines_added, day2.total_lines_deleted) == (0, 0)

    card = {(r.year, r.month): r for r in gold.repo_health_scorecard(silver.repo_summary(_activity(spark, rows))).collect()}
    jan = card[(2024, 1)]
    assert jan.unique_contributors == 2  # peak day, not monthly distinct
    assert jan.total_events == 4 and jan.merge_rate == 0.5 and jan.net_loc == 6
    assert jan.avg_commits_per_contributor == 0.5
    assert card[(2025, 2)].month_start_date == d("2025-02-01")
    assert card[(2024, 2)].month_start_date == d("2024-02-01")


def test_productivity_commit_stats_activity(spark):
    rows = [
        _act("1", "a", "2024-01-01 10:00:00", "o/r", "PullRequestEvent", la=10, ld=4, fc=2, state="closed", merged=True),
        _act("2", "a", "2024-01-03 10:00:00", "o/r", "PullRequestEvent", state="opened", merged=False),
        _act("3", "a", "2024-01-01 10:00:00", "o/r", "PushEvent", sha="s1", author="a"),
        _act("4", "a", "2024-01-01 11:00:00", "o/r", "PushEvent", sha="s2", author="someone-else"),
        _act("5", "a", "2024-01-01 12:00:00", "o/r", "PushEvent", sha="s3", author=None),
    ]
    act = _activity(spark, rows)
    m = gold.developer_productivity_monthly(act).collect()
    assert len(m) == 1
    r = m[0]
    assert (r.total_prs, r.merged_prs, r.merge_rate, r.total_lines_added, r.total_lines_deleted, r.net_loc) == (2, 1, 0.5, 10, 4, 6)
    assert (r.avg_files_changed, r.avg_pr_size) == (1.0, 7.0)  # missing counts average as 0
    stats = {r.author_name: r for r in gold.commit_stats_by_day(act).collect()}
    assert stats["a"].is_author_actor_match is True
    assert stats["someone-else"].is_author_actor_match is False
    assert stats[None].is_author_actor_match is None
    days = {(r.date, r.event_type): r for r in gold.activity_by_day(act).collect()}
    assert days[(d("2024-01-01"), "PushEvent")].total_events == 3
    assert days[(d("2024-01-01"), "PushEvent")].unique_actors == 1
