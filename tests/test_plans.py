"""Physical-plan properties that matter at scale, checked on every registered query."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import re

from conftest import SF_SMALL, core_names

from forgelake.operators import bronze, gold
from forgelake.sources.tables import since

FORBIDDEN = (
    "CartesianProduct",  # cross joins
    "BroadcastNestedLoopJoin",  # non-equi joins
    "BatchEvalPython",  # row-at-a-time Python UDFs
    "ArrowEvalPython",  # Pandas UDFs
    "FlatMapGroupsInPandas",
    "MapInPandas",
)


WRITES_FIRST = ("merge_insert_only", "merge_upsert", "merge_key_moves_partition", "rerun_month", "incremental_months")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_no_cross_join_or_python_in_any_registered_query(spark):
    import __spark_entry__ as entry

    for name in core_names():
        if name == "quality_report" or name in WRITES_FIRST:
            continue  # these run jobs while building; covered below on their parts
        text = plan(entry.queries()[name](spark, SF_SMALL))
        for op in FORBIDDEN:
            assert op not in text, (name, op)


def test_dedup_limits_rows_before_the_shuffle(warehouse):
    text = plan(bronze.bronze_events(warehouse.read("staging_events")))
    head, _, tail = text.partition("Exchange")
    assert "WindowGroupLimit" in head and "Partial" in text  # partial limit below the exchange
    assert "Final" in text


def test_filters_and_columns_reach_the_scan(warehouse):
    text = plan(gold.commit_stats_by_day(warehouse.read("silver_developer_activity")))
    assert "EqualTo(event_type,PushEvent)" in text
    scan = text.split("ReadSchema:")[1].splitlines()[0]
    assert "lines_added" not in scan and "commit_sha" not in scan  # unused columns are not read


def test_lookback_prunes_partitions(warehouse):
    text = plan(since(warehouse.read("bronze_events"), 3, dt.date(2024, 1, 30)))
    assert "PartitionFilters: [isnotnull(date" in text and ">= 2024-01-27" in text


def test_aggregates_combine_map_side_before_the_shuffle(warehouse):
    from forgelake.operators import silver

    activity = warehouse.read("silver_developer_activity")
    builders = {
        "repo_summary": silver.repo_summary(activity),
        "monthly": gold.developer_productivity_monthly(activity),
        "commit_stats": gold.commit_stats_by_day(activity),
        "activity": gold.activity_by_day(activity),
        "scorecard": gold.repo_health_scorecard(warehouse.read("silver_repo_summary")),
    }
    for name, df in builders.items():
        text = plan(df)
        below_first_exchange = text.split("Exchange")[-1]  # tree is printed root first
        assert "HashAggregate" in below_first_exchange, name
        assert "partial_" in text, name


def test_writes_rebalance_on_partition_columns(warehouse):
    from forgelake import specs
    from forgelake.sinks.parquet import laid_out

    text = plan(laid_out(warehouse.read("bronze_events"), specs.BRONZE_EVENTS))
    assert "REBALANCE_PARTITIONS_BY_COL" in text
    # in-task sort by partition column, then the declared cluster columns
    assert re.search(r"Arguments: \[date#\d+ ASC NULLS FIRST, type#\d+ ASC NULLS FIRST, repo_name#\d+ ASC NULLS FIRST, actor_login#", text)


def test_monthly_lookback_prunes_partitions(warehouse):
    from forgelake.plans.pipeline import Lookback

    text = plan(Lookback(days=3, as_of=dt.date(2024, 1, 30)).monthly(warehouse.read("silver_developer_activity")))
    assert "PartitionFilters: [isnotnull(date" in text and ">= 2024-01-01" in text
