"""Every registered query against its DuckDB oracle (the driver's gate), plus a negative control."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL, core_names
from oracle_check import canon, compare


def test_all_registered_queries_have_an_oracle():
    import __spark_entry__ as entry

    names = core_names()
    assert set(names) <= set(entry.oracle_sql())
    assert len(names) == 34


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() == 25
    assert "avg_commits_per_contributor" in df.columns


def test_queries_match_oracle(spark):
    res = compare(spark, SF_SMALL, core_names(), verbose=False)
    bad = {k: v for k, v in res.items() if not v.startswith("ok")}
    assert not bad, bad


@pytest.mark.parametrize("change", ["value", "row"])
def test_comparator_reports_a_change(change):
    cols = ["a", "b"]
    rows = [(1, 0.5), (2, None)]
    other = [(1, 0.5), (2, 0.25)] if change == "value" else rows[:1]
    assert canon(cols, rows) != canon(cols, other)
