"""The driver-table mapping reproduces the specified stage sizes at every scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from forgelake.plans.pipeline import fixture_staging
from forgelake.sources import fixture

# (raw, clean, NULL login, staging productivity with replay), FIXTURES.md section 3
SIZES = {
    "sf0.001": (1_000, 756, 65, 245),
    "sf0.01": (10_000, 7_908, 490, 2_320),
    "sf0.1": (100_000, 80_107, 4_962, 24_082),
}


@pytest.mark.parametrize("sf", sorted(SIZES))
def test_fixture_stage_sizes(spark, sf):
    raw_n, clean_n, null_login_n, prod_n = SIZES[sf]
    sf_dir = f"/root/testdata/{sf}"
    raw = fixture.read_fixture_raw(spark, sf_dir)
    frames = fixture_staging(spark, sf_dir)
    assert raw.count() == raw_n
    assert frames["staging_events"].count() == clean_n
    assert raw.filter(F.col("actor.login").isNull()).count() == null_login_n
    assert frames["staging_productivity"].count() == prod_n
    # every raw row is a bot, a human, or has no login
    assert frames["bot_events"].count() + clean_n + null_login_n == raw_n


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_replayed_rows_come_from_one_scan(spark):
    """Each row and its copy leave one pass over the events."""
    frames = fixture_staging(spark, "/root/testdata/sf0.001")
    assert _plan(frames["staging_productivity"]).count("FileScan parquet") == 1


def test_json_of_an_event_is_parsed_once(spark):
    plan = _plan(fixture_staging(spark, "/root/testdata/sf0.001")["staging_events"])
    assert plan.lower().count("get_json_object(") == 1
