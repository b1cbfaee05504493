"""Keep the latest row per key (``ROW_NUMBER() ... = 1``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgelake.specs import TableSpec

_RN = "__rn"


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per ``keys`` value: the first by ``order_by``.

    NULL keys form one group, as in SQL window partitions.  Catalyst plans a
    partial ``WindowGroupLimit`` before the shuffle, so each map task forwards
    at most one row per key: a hot key (or the NULL key) reaches its reducer as
    one row per map task, not as all its copies.  ``order_by`` must end in
    enough tie-breakers to make the choice deterministic.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def asc(*cols: str) -> list[Column]:
    """Ascending tie-breakers with NULLs last (Spark defaults to NULLS FIRST)."""
    return [F.col(c).asc_nulls_last() for c in cols]


def version_order(spec: TableSpec) -> list[Column]:
    """The declared order of a key's versions, the latest first."""
    return [F.col(c).desc_nulls_last() for c in spec.latest_by] + asc(*spec.ties)
