"""Operator 9: mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

Each source's documents, in a seeded hash order, form one stream of words that is cut
into equal blocks.  2**m slots carry the van der Corput points; the cumulative targets
map each point to a source, slots are ranked within their source, and the r-th slot of a
source takes its r-th block (block r mod n in pass r div n).  Targets are weights with a
ceiling, water-filled.

Defined cases: a null text has size 0; a null source is a source of its own (last in
order); a null id counts as empty text in the hash order; repeated rows are separate
documents; sizes of 0 are never taken; an empty table gives no rows.  Other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Joins carry merge hints: the planner's estimates miss what explode adds and would broadcast tables that grow.
from forgelake.llm.common import WORD, free, stored, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CEILING = 2
BLOCK_WORDS = 4096
SEED = "mix"


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, key, size, order, bucket): whole-text word counts and the seeded order; bucket is its prefix."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("~")).alias("key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        order.alias("order"),
        F.substring(order, 1, 3).alias("bucket"),
    )


def targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, ceiling=CEILING) -> DataFrame:
    """(key, source_size, target, low, high): water-filled targets and their cumulative bounds.

    One row per source; the windows without a partition run over that table only.
    """
    per = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    by_key = Window.orderBy("key")
    cycle = F.array(*[F.lit(w).cast("double") for w in weights])
    per = per.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_key) - 1) % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * ceiling
    filling = Window.orderBy(cap / F.col("weight"), "key")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) * share - F.coalesce(F.sum(cap).over(before), F.lit(0))) / F.sum("weight").over(rest)
    per = per.withColumn("level", level).withColumn("at", F.row_number().over(filling))
    fits = F.col("level") * F.col("weight") <= cap
    water = F.min_by(F.when(fits, F.col("level")), F.when(fits, F.col("at"))).over(whole)
    per = per.withColumn("target", F.coalesce(F.least(cap.cast("double"), water * F.col("weight")), cap.cast("double")))
    words = per.withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
    running = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return words.select("key", "source_size", "target", "words", F.sum("words").over(running).alias("high")).withColumn(
        "low", F.col("high") - F.col("words")
    )


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(position, key, pass, block, words): one row per slot that takes words."""
    total = sources.agg(F.coalesce(F.max("high"), F.lit(0))).first()[0]
    bits = max(0, math.ceil(math.log2(max(1, total) / block_words)))
    slots, block = 1 << bits, max(1, math.ceil(total / (1 << bits)))
    cut = lambda c: F.ceil(F.col(c) * F.lit(float(slots)) / F.lit(float(max(1, total)))).cast("long")
    wide = sources.filter("words > 0").select("key", "source_size", "words", cut("low").alias("y0"), cut("high").alias("y1"))
    # Points of a source are the bit-reversed numbers of its interval; spread them before they are spelled out.
    step = 4096
    spread = (
        wide.filter("y1 > y0")
        .withColumn("y", F.explode(F.sequence(F.col("y0"), F.col("y1") - 1, F.lit(step))))
        .repartition("key", "y")
        .select("key", "source_size", "words", F.explode(F.sequence(F.col("y"), F.least(F.col("y") + step, F.col("y1")) - 1)).alias("y"))
    )
    reverse = F.conv(F.reverse(F.lpad(F.bin("y"), max(1, bits), "0")), 2, 10).cast("long")
    points = spread.withColumn("position", reverse if bits else F.lit(0).cast("long"))
    # Rank within the source in two levels: counts of position ranges, then inside a range.
    points = points.withColumn("part", F.shiftright("position", max(0, bits - 10)))
    counts = points.groupBy("key", "part").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("key", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("key", "part").orderBy("position")
    ranked = points.join(counts.hint("merge"), ["key", "part"]).select(
        "key", "source_size", "words", "position", (F.col("ahead") + F.row_number().over(inside) - 1).alias("rank")
    )
    # A source that needs a few blocks more than it has points gets them after all slots.
    per_pass = F.ceil(F.col("source_size") / F.lit(block)).cast("long")
    need = F.floor(F.col("words") / F.col("source_size")) * per_pass + F.ceil((F.col("words") % F.col("source_size")) / F.lit(block))
    have = wide.withColumn("rank", F.explode(F.when(need > F.col("y1") - F.col("y0"), F.sequence(F.col("y1") - F.col("y0"), need - 1))))
    late = have.select("key", "source_size", "words", (F.col("rank") + slots).alias("position"), "rank")
    begin = F.floor(F.col("rank") / per_pass) * F.col("source_size") + (F.col("rank") % per_pass) * block
    return (
        ranked.unionByName(late)
        .select(
            "position",
            "key",
            F.floor(F.col("rank") / per_pass).alias("pass"),
            (F.col("rank") % per_pass).alias("block"),
            F.least(F.lit(block), F.col("source_size") - (F.col("rank") % per_pass) * block, F.col("words") - begin).alias("words"),
            F.lit(block).cast("long").alias("block_words"),
        )
        .filter("words > 0")
    )


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """``sizes`` with each document's first word in its source's stream (two-level running sum)."""
    ahead = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("key", "bucket").agg(F.sum("size").alias("n"))
    parts = parts.select("key", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    parts = parts.join(sources.select("key", "source_size", "target").hint("merge"), "key")
    inside = Window.partitionBy("key", "bucket").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.join(parts.hint("merge"), ["key", "bucket"]).withColumn(
        "start", F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, ceiling=CEILING, block_words=BLOCK_WORDS, seed=SEED, keep_key=False) -> DataFrame:
    """(doc_id, size, source_size, target, taken): words the schedule takes from each document."""
    sizes = stored(sized(docs, seed), "mix-sizes")
    sources = stored(targets(sizes, weights, share, ceiling), "mix-targets")
    slots = schedule(sources, block_words)
    at = placed(sizes, sources)
    block = slots.agg(F.max("block_words")).first()[0] or 1
    pieces = at.filter("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)))
    )
    taken = F.greatest(
        F.lit(0),
        F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("words")) - F.greatest(F.col("start"), F.col("block") * block),
    )
    keys = ["doc_id", "key", "start", "size", "source_size", "target"]
    drawn = (
        pieces.join(slots.select("key", "block", "words").hint("merge"), ["key", "block"], "left")
        .groupBy(*keys)
        .agg(F.sum(F.when(F.col("words").isNotNull(), taken).otherwise(0)).cast("long").alias("taken"))
    )
    columns = ["doc_id", "size", "source_size", "target", "taken", *(["key"] if keep_key else [])]
    return drawn.select(*columns).unionByName(at.filter("size = 0").withColumn("taken", F.lit(0).cast("long")).select(*columns))


def first_words(text, n):
    """The text up to the end of its n-th word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"([\\x20\\x09-\\x0D]*{WORD})"), F.lit(1)), F.lit(1), n), "")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: each as often as the schedule takes it whole, and once more cut after the words that it
    takes beyond that (at most one document of a source, the one at which its target ends, is cut).

    Rows alike in id, source and size share one decision.  All columns are kept (``n_chars``, where
    there is one, is counted anew for a cut text); rows without words are never taken.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("~"))
    drawn = mix(docs, **options, keep_key=True).filter("taken > 0")
    row, source, words, taken, copy = (free(n, docs) for n in ("__id", "__key", "__size", "__taken", "__copy"))
    kept = drawn.groupBy(F.col("doc_id").alias(row), F.col("key").alias(source), F.col("size").alias(words)).agg(
        F.floor(F.avg("taken") + 0.5).cast("long").alias(taken)
    )
    kept = kept.filter(F.col(taken) > 0)
    joined = docs.join(kept.hint("merge"), F.col("doc_id").eqNullSafe(F.col(row)) & (key == F.col(source)) & (size == F.col(words)))
    copies = joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.ceil(F.col(taken) / F.col(words)).cast("int"))))
    left = F.col(taken) - (F.col(copy) - 1) * F.col(words)
    cut = left < F.col(words)
    out = copies.withColumn("text", F.when(cut, first_words(F.col("text").cast("string"), left.cast("int"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_mixing_schedule(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))


ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS l, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source
), w AS (
  SELECT source, l, r, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((r - 1) % 3 + 1)::INT] AS w FROM s
), f AS (
  SELECT *, (sum(l) OVER () * 1.5::DOUBLE - coalesce(sum(2 * l) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, row_number() OVER o AS k
  FROM w WINDOW o AS (ORDER BY 2 * l / w, r)
), t AS (
  SELECT source, l, least(2 * l, coalesce((SELECT arg_min(level, k) FROM f WHERE level * w <= 2 * l) * w, 2 * l))::DOUBLE AS target FROM f
), p AS (
  SELECT d.*, t.l, t.target, floor(t.target + 0.5)::BIGINT AS take,
         (sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, l AS source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE (take // l) * size + greatest(0, least(start + size, take % l) - start) END::BIGINT AS taken
FROM p
"""
