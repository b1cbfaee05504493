"""Helpers shared by the layer builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def stamp(df: DataFrame, columns: list[str], ingested_at: Column | None) -> DataFrame:
    """Project to the table's columns, plus the run's load time when one is given.

    The load time is one literal per run (not ``current_timestamp()`` per
    asset), so every table of a run carries the same value; driver queries
    leave it out because it cannot match an oracle.
    """
    if ingested_at is None:
        return df.select(*columns)
    return df.select(*columns, ingested_at.cast("timestamp").alias("ingested_at"))
