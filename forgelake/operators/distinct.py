"""Exact distinct counts that merge (A2, A6): bitmaps over dictionary ids.

A count of distinct logins of a day cannot be added to the next day's; a bitmap of them can be
OR-ed.  Values get small integer ids from a dictionary that only grows; rows of
``(group, bucket, bitmap)`` hold the ids of a group, 32,768 to a bucket (Spark's bitmap functions),
and any roll-up (months, all days, a re-run month) is an OR over rows, without the events.

Ids are dense within ``STRIPES`` parts of the hash space, which are numbered side by side, so the
whole dictionary is numbered without a single ordered pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Parts of the hash space that number their values on their own.
STRIPES = 256
BUCKET, BITMAP = "bucket", "bitmap"


def dictionary(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(value, id)`` for every distinct non-NULL ``value``: those of ``known`` keep their ids, new ones follow.

    A value's stripe is the hash's, its id ``stripe + STRIPES * place``; places go on after the stripe's
    known ones.  The same input gives the same ids.
    """
    new = values.select("value").filter(F.col("value").isNotNull()).distinct()
    if known is not None:
        new = new.join(known.select("value"), "value", "left_anti")
    new = new.withColumn("stripe", F.pmod(F.xxhash64("value"), F.lit(STRIPES)))
    placed = new.withColumn("place", F.row_number().over(Window.partitionBy("stripe").orderBy("value")) - 1)
    if known is None:
        return placed.select("value", (F.col("stripe") + STRIPES * F.col("place")).alias("id"))
    # one row a stripe
    taken = known.groupBy(F.pmod("id", F.lit(STRIPES)).alias("stripe")).agg((F.max("id") + STRIPES).alias("next"))
    fresh = placed.join(taken, "stripe", "left")
    first = F.coalesce("next", F.col("stripe"))
    return known.select("value", "id").unionByName(fresh.select("value", (first + STRIPES * F.col("place")).alias("id")))


def bitmaps(rows: DataFrame, keys: Sequence[str], value: str, ids: DataFrame) -> DataFrame:
    """``(*keys, bucket, bitmap)`` of the distinct non-NULL values of each group.

    Ids come by an equi-join with the dictionary; a bitmap is built from partial ones, so a group
    that holds a third of all rows costs a bitmap per bucket and map task.
    """
    known = ids.select(F.col("value").alias(value), F.col("id").alias("__id"))
    named = rows.select(*keys, value).distinct().join(known, value)
    place = F.col("__id") + 1  # Spark's buckets count from 1
    return named.groupBy(*keys, F.bitmap_bucket_number(place).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(BITMAP)
    )


def rolled_up(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups: rows of ``parts`` OR-ed."""
    return parts.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def counted(parts: DataFrame, keys: Sequence[str], into: str) -> DataFrame:
    """Number of distinct values of each group."""
    merged = rolled_up(parts, keys).select(*keys, F.bitmap_count(BITMAP).alias("__n"))
    return merged.groupBy(*keys).agg(F.sum("__n").alias(into))
