"""Distinct logins and repositories by day and event type, kept as bitmaps beside a warehouse.

After a run, :meth:`DistinctIndex.update` rebuilds the days that it changed (``RunReport.touched``);
:meth:`DistinctIndex.distinct` answers exact distinct counts of any coarser group from the bitmaps alone.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.operators import distinct as ops
from forgelake.plans.pipeline import Warehouse, _dated, _run_all
from forgelake.sinks import parquet as sink
from forgelake.sources.tables import read_table
from forgelake.specs import TableSpec

SOURCE = "silver_developer_activity"
#: Counted column -> name of its distinct count.
COUNTED = {"developer_login": "unique_actors", "repo_name": "unique_repos"}


def _values_spec(column: str) -> TableSpec:
    return TableSpec(f"ids_{column}", "value string, id bigint", keys=("value",), cluster_by=("value",), stamped=False)


def _days_spec(column: str) -> TableSpec:
    return TableSpec(
        f"days_{column}",
        "date date, event_type string, bucket bigint, bitmap binary",
        keys=("date", "event_type", "bucket"),
        partition_by=("date",),
        cluster_by=("event_type", "bucket"),
        stamped=False,
    )


class DistinctIndex:
    def __init__(self, warehouse: Warehouse):
        self.warehouse, self.spark = warehouse, warehouse.spark

    def _path(self, spec: TableSpec) -> str:
        return self.warehouse.path(f"_distinct/{spec.name}")

    def update(self, dates: set | None = None) -> None:
        """Rebuild the bitmaps of the given days (None among them: undated rows) or of all; days without rows go.

        New values are added to the dictionary first; a run that breaks off there leaves ids that no bitmap has yet.
        """
        rows = self.warehouse.read(SOURCE)
        scope = F.lit(True) if dates is None else _dated(rows.columns, dates, whole_months=False)
        rows = rows.filter(scope)

        def one(column: str) -> None:
            values, days = _values_spec(column), _days_spec(column)
            path = self._path(values)
            known = read_table(self.spark, path, values) if sink.path_exists(self.spark, path) else None
            sink.merge_into(self.spark, ops.dictionary(rows.select(F.col(column).alias("value")), known), path, values, sink.INSERT_ONLY)
            built = ops.bitmaps(rows, ["date", "event_type"], column, read_table(self.spark, path, values))
            sink.merge_into(self.spark, built, self._path(days), days, scope=scope, check_source_keys=False)

        # each column has tables of its own, so they are brought up to date side by side
        _run_all(self.spark, {column: partial(one, column) for column in COUNTED}, len(COUNTED))

    def distinct(self, by: dict[str, Column]) -> DataFrame:
        """Distinct logins and repositories of groups given as expressions over ``date`` and ``event_type``."""
        keys = list(by)
        counts = []
        for column, into in COUNTED.items():
            spec = _days_spec(column)
            parts = read_table(self.spark, self._path(spec), spec).withColumns(by)
            counts.append(ops.counted(parts, keys, into))
        return reduce(lambda a, b: _beside(a, b, keys), counts)


def _beside(a: DataFrame, b: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Groups of both sides (NULL keys are groups too); a count that a side lacks is 0."""
    keys = list(keys)
    other = b.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    joined = a.join(other, on, "full")
    here = reduce(lambda x, y: x | y, [F.col(c).isNotNull() for c in a.columns if c not in keys])
    named = [F.when(here, F.col(k)).otherwise(F.col(f"__{k}")).alias(k) for k in keys]
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in (*a.columns, *b.columns) if c not in keys]
    return joined.select(*named, *counts)
