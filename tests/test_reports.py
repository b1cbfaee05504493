"""Report queries R1-R9 on hand rows."""

from __future__ import annotations

from conftest import d

from forgelake import specs
from forgelake.operators import reports


def _stats(spark, rows):
    full = [(d(day), repo, actor, actor, n, True) for day, repo, actor, n in rows]
    return spark.createDataFrame(full, specs.COMMIT_STATS_BY_DAY.schema)


def test_top_k_breaks_ties_by_name(spark):
    rows = [("2024-01-01", "o/r", "bob", 3), ("2024-01-02", "o/r", "bob", 2), ("2024-01-01", "o/r", "amy", 5),
            ("2024-01-01", "o/s", "cid", 5), ("2024-01-01", "o/s", "dan", 1)]
    top = reports.top_developers_by_commits(_stats(spark, rows), n=2).collect()
    assert [(r.actor_login, r.total_commits) for r in top] == [("amy", 5), ("bob", 5)]  # cid also has 5: name decides
    repos = reports.commits_by_repo(_stats(spark, rows), n=1).collect()
    assert [(r.repo_name, r.total_commits) for r in repos] == [("o/r", 10)]


def _activity(spark, rows):
    full = [(d(day), 1, 2024, etype, n, 1, 1) for day, etype, n in rows]
    return spark.createDataFrame(full, specs.ACTIVITY_BY_DAY.schema)


def test_event_share_and_daily_volume(spark):
    act = _activity(spark, [("2024-01-01", "PushEvent", 6), ("2024-01-01", "WatchEvent", 2), ("2024-01-02", "PushEvent", 2)])
    share = {r.event_type: (r.total_events, r.share) for r in reports.event_share(act).collect()}
    assert share == {"PushEvent": (8, 0.8), "WatchEvent": (2, 0.2)}
    vol = {r.date: tuple(r)[1:] for r in reports.daily_volume(act).collect()}
    assert vol[d("2024-01-01")] == (6, 0, 0, 2)  # push, create, pull request, watch
    assert vol[d("2024-01-02")] == (2, 0, 0, 0)


def _monthly(spark, rows):
    full = [(y, m, d(f"{y}-{m:02d}-01"), dev, "o/r", prs, merged, None, la, ld, la - ld, 0.0, 0.0) for y, m, dev, prs, merged, la, ld in rows]
    return spark.createDataFrame(full, specs.DEVELOPER_PRODUCTIVITY_MONTHLY.schema)


def test_monthly_reports(spark):
    m = _monthly(spark, [(2024, 1, "a", 4, 1, 10, 2), (2024, 2, "a", 2, 2, 5, 5), (2024, 1, "b", 1, 0, 0, 0)])
    rate = {r.developer_login: (r.total_prs, r.merged_prs, r.merge_rate) for r in reports.merge_rate_vs_volume(m).collect()}
    assert rate == {"a": (6, 3, 0.5), "b": (1, 0, 0.0)}  # ratio of sums, not mean of monthly rates
    by_month = {(r.year, r.month): (r.merged_prs, r.unmerged_prs) for r in reports.merged_by_month(m).collect()}
    assert by_month == {(2024, 1): (1, 4), (2024, 2): (2, 0)}
    churn = {(r.year, r.month): (r.lines_added, r.lines_deleted) for r in reports.loc_churn_by_month(m).collect()}
    assert churn == {(2024, 1): (10, 2), (2024, 2): (5, 5)}
    assert [(r.developer_login, r.total_prs) for r in reports.top_pr_developers(m, n=1).collect()] == [("a", 6)]


def test_pr_size_is_weighted_over_events(spark):
    from conftest import ts

    def row(eid, at, la, ld):
        t = ts(at)
        return (eid, "a", t, t.date(), t.month, t.year, "o/r", "PullRequestEvent", None, None, la, ld, 1, None, "opened", False)

    act = spark.createDataFrame(
        [row("1", "2024-01-01 10:00:00", 10, 0), row("2", "2024-01-02 10:00:00", None, None), row("3", "2024-01-03 10:00:00", 1, 1)],
        specs.SILVER_DEVELOPER_ACTIVITY.schema,
    )
    r = reports.pr_size_by_month(act).collect()[0]
    assert (r.total_prs, r.avg_pr_size) == (3, 4.0)  # (10 + 0 + 2) / 3, missing counts as 0
