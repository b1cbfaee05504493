from __future__ import annotations

import datetime as dt
import os
import re
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, REPO)

SF_SMALL = "/root/testdata/sf0.001"


def core_names() -> list[str]:
    """Every query but the optional training-data ones, which tests/llm covers."""
    import __spark_entry__ as entry

    return [n for n in entry.queries() if not re.fullmatch(r"op\d+_.*|pipeline", n)]


@pytest.fixture(scope="session")
def spark():
    from forgelake.session import build_session

    s = build_session("local[4]", app="forgelake-tests", conf={"spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_table(spark):
    """A fresh folder under the session's scratch root for each test."""
    from forgelake.session import scratch_path

    return lambda name="t": scratch_path(spark, name)


@pytest.fixture(scope="session")
def warehouse(spark):
    """One full pipeline run on the sf0.001 fixture, shared by the pipeline and plan tests."""
    from forgelake.plans.pipeline import Warehouse, run_assets, stage_raw, write_staging
    from forgelake.session import scratch_path
    from forgelake.sources import fixture

    frames = stage_raw(spark, fixture.read_fixture_raw(spark, SF_SMALL))
    frames["staging_productivity"] = fixture.with_replayed_pull_requests(frames["staging_productivity"])
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    write_staging(wh, frames)
    report = run_assets(spark, wh)
    assert report.failures == []
    return wh


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)
