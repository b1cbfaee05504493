"""Scans of staging / medallion Parquet tables and the lookback window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.specs import TableSpec

#: Physical first partition of staging tables that the monthly job writes: the archive month as YYYYMM.
SOURCE_MONTH = "source_month"


def read_table(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Read a table written by :mod:`forgelake.sinks.parquet` with its declared schema.

    Partition columns are part of the declared schema, so partition discovery
    does not infer their types, and filters on them prune directories.
    """
    return spark.read.schema(spec.stored_schema).parquet(path).select(*spec.stored_columns)


def read_source_month(
    spark: SparkSession, path: str, spec: TableSpec, month: int, recalled: DataFrame | None = None
) -> DataFrame:
    """The rows that one archive month put into a staging table, whatever their dates (NULL included).

    ``recalled`` (event_id) adds the rows of those events that other months hold.
    """
    stored = spec.stored_schema.add(SOURCE_MONTH, "integer")
    rows = spark.read.schema(stored).parquet(path)
    own = rows.filter(F.col(SOURCE_MONTH) == month)
    if recalled is not None:
        own = own.unionByName(rows.filter(F.col(SOURCE_MONTH) != month).join(recalled, "event_id", "left_semi"))
    return own.select(*spec.stored_columns)


def since(df: DataFrame, days: int, as_of: dt.date | str, date_col: str = "date") -> DataFrame:
    """Keep whole days in ``[as_of - days, ...]``.

    On a table partitioned by ``date_col`` this becomes a partition filter;
    cutting at whole days keeps re-merged daily aggregates complete.
    """
    start = F.date_sub(F.lit(as_of).cast("date"), days)
    return df.filter(F.col(date_col) >= start)


def since_month(df: DataFrame, months: int, as_of: dt.date | str) -> DataFrame:
    """Monthly tables: keep whole months from the start of ``as_of - months``.

    One date comparison on the month start, correct across a year end.
    """
    start = F.trunc(F.add_months(F.lit(as_of).cast("date"), -months), "month")
    return df.filter(F.make_date(F.col("year"), F.col("month"), F.lit(1)) >= start)
