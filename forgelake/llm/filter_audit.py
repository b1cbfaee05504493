"""Operator 11: how quality filters interact, over every order in which they may be applied.

Each document is measured once, by DataFrame functions: a mask with one bit a filter it fails.
A mask decides what happens to the document at each step of each order, so it maps to one wide
integer (``wide_counters``): a field of ``FIELD`` bits for each order, step and outcome (kept,
removed here, failed but removed earlier).  Rows are counted by part and mask before anything is
gathered, and a part's integers, each times the rows of its mask, are summed and unpacked.  No
field can run into the next: a count is a Spark long, below 2**63, and a field has 64 bits.

A group never holds more than one row per mask and flag (2**filters * 4), whatever the input.
The copies filter never brings the copies of a text together: rows are counted by mask whole, and
apart from that the first row of each text is found by a rank (limited before its shuffle); what
is not first is a copy.

Defined cases: a null text is empty; a null lang is the part ''; a null id is never smaller than
another nor has a smaller one, so such a row is no copy; rows that share the least id of a text
are all first; labels without an id or with null values say nothing, and of several labels of an
id any 1 counts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgelake.llm.common import WORD, stored, table

#: Bits of a counter: as wide as a Spark long, so sums of row counts never overflow it.
FIELD = 64
#: Filters that look at a text alone, in order of their letters; COPY is the one that looks at the whole table.
TEXT_FILTERS, COPY = "ABCD", "E"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
MARKUP = r"[#$%&*|]"
OUT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)
OUTCOMES = ("kept", "removed", "redundant")


def text_failures(text: Column) -> Column:
    """The bits of the filters that a text fails by itself: A few words, B repeated words, C capitals, D markup."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    n, chars = F.size(words), F.char_length(text).cast("long")
    capitals = chars - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = [
        n < LEAST_WORDS,
        F.size(F.array_distinct(words)).cast("long") * 100 < n.cast("long") * LEAST_DISTINCT,
        capitals * 100 > chars * MOST_CAPITALS,
        text.rlike(MARKUP),
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)])


def measured(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(name of the text, doc_id, part, mask, good, toxic, n): equal rows counted together, texts read once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = (
        docs.select(
            F.unhex(F.sha2(text, 256)).alias("name"),
            F.col("doc_id"),
            F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
            text_failures(text).alias("mask"),
        )
        .groupBy("name", "doc_id", "part", "mask")
        .agg(F.count("*").alias("n"))
    )
    marks = (
        labels.filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(*(F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c) for c in ("quality", "toxic")))
    )
    flag = [F.coalesce(F.col(c), F.lit(False)).alias(into) for c, into in (("quality", "good"), ("toxic", "toxic"))]
    return rows.join(marks, "doc_id", "left").select("name", "doc_id", "part", "mask", *flag, "n")


def with_copies(rows: DataFrame, bit: int) -> DataFrame:
    """(part, mask, good, toxic, n) with ``bit`` set for the rows whose text has a row of a smaller id.

    Copies are all rows less the first ones: a text copied a million times is never in one task.
    """
    by = ["part", "mask", "good", "toxic"]
    known = rows.filter("doc_id IS NOT NULL")
    first = known.withColumn("nth", F.rank().over(Window.partitionBy("name").orderBy("doc_id"))).filter("nth = 1")
    alone = first.select(*by, "n").unionByName(rows.filter("doc_id IS NULL").select(*by, "n"))
    copies = rows.select(*by, "n").unionByName(alone.withColumn("n", -F.col("n")))
    out = alone.unionByName(copies.withColumn("mask", F.col("mask").bitwiseOR(F.lit(bit))))
    return out.groupBy(*by).agg(F.sum("n").alias("n")).filter("n > 0")


def orders(filters: str) -> list[str]:
    return sorted("".join(p) for p in permutations(filters))


def wide_counters(filters: str) -> list[int]:
    """Per mask one integer: a field for each order, step and outcome, 1 where a document of that mask has that outcome."""
    bit = {f: 1 << i for i, f in enumerate(filters)}
    out = []
    for mask in range(1 << len(filters)):
        fields = []
        for order in orders(filters):
            standing = True
            for f in order:
                fails = bool(mask & bit[f])
                fields += [standing and not fails, standing and fails, fails and not standing]
                standing = standing and not fails
        out.append(sum(1 << FIELD * i for i, x in enumerate(fields) if x))
    return out


def unpacked(total: int, filters: str) -> np.ndarray:
    """(orders, steps, outcomes) of a summed integer."""
    shape = (len(orders(filters)), len(filters), len(OUTCOMES))
    size = int(np.prod(shape))
    return np.frombuffer(total.to_bytes(size * FIELD // 8, "little"), f"<u{FIELD // 8}").astype(np.int64).reshape(shape)


def interactions(counted: DataFrame, filters: str) -> DataFrame:
    """(part, mask, good, toxic, n) to one row per part, order and step (``OUT``).

    Bit i of a mask is filter i of ``filters``, rows of a part distinct in mask and flags.
    """
    wide = counted.sparkSession.sparkContext.broadcast(wide_counters(filters))  # 2**filters integers, whatever the input
    every, most = orders(filters), (1 << len(filters)) * 4

    def report(rows: pd.DataFrame) -> pd.DataFrame:
        assert len(rows) <= most
        sums = {"all": 0, "good": 0, "toxic": 0}
        only = dict.fromkeys(filters, 0)
        for mask, good, toxic, n in zip(rows["mask"].tolist(), rows["good"], rows["toxic"], rows["n"].tolist(), strict=True):
            packed = wide.value[mask] * n
            sums["all"] += packed
            sums["good"] += packed if good else 0
            sums["toxic"] += packed if toxic else 0
            if mask & (mask - 1) == 0 and mask:
                only[filters[mask.bit_length() - 1]] += n
        whole, good, toxic = (unpacked(sums[k], filters) for k in ("all", "good", "toxic"))
        removed = OUTCOMES.index("removed")
        shapley = dict.fromkeys(filters, 0)
        for i, order in enumerate(every):
            for j, f in enumerate(order):
                shapley[f] += int(whole[i, j, removed])
        steps = [f for order in every for f in order]
        size = len(steps)
        return pd.DataFrame(
            {
                "part": [rows["part"].iloc[0]] * size,
                "filter_order": np.repeat(every, len(filters)),
                "step": np.tile(np.arange(1, len(filters) + 1, dtype=np.int32), len(every)),
                **{k: whole[:, :, i].ravel() for i, k in enumerate(OUTCOMES)},
                "unique_fails": [only[f] for f in steps],
                "good_lost": good[:, :, removed].ravel(),
                "toxic_lost": toxic[:, :, removed].ravel(),
                "shapley": [shapley[f] for f in steps],
            }
        )

    return counted.groupBy("part").applyInPandas(report, OUT)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E over ``docs`` (doc_id, text, lang) and ``labels`` (doc_id, quality, toxic)."""
    rows = stored(measured(docs, labels), "filter-masks")
    return interactions(with_copies(rows, 1 << len(TEXT_FILTERS)), TEXT_FILTERS + COPY)


def op11_filter_audit(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
marks AS (
    SELECT doc_id, coalesce(max(CASE WHEN quality = 1 THEN 1 ELSE 0 END), 0) AS good,
           coalesce(max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END), 0) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
firsts AS (SELECT text, min(doc_id) AS least FROM words GROUP BY text),
failing AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           len(w) < 100 AS a,
           100 * len(list_distinct(w)) < 80 * len(w) AS b,
           100 * (length(text) - length(regexp_replace(text, '[A-Z]+', '', 'g'))) > 10 * length(text) AS c,
           regexp_matches(text, '[#$%&*|]') AS d,
           coalesce(words.doc_id > firsts.least, false) AS e
    FROM words JOIN firsts USING (text) LEFT JOIN marks ON words.doc_id = marks.doc_id
),
counted AS (
    SELECT part, good, toxic, a, b, c, d, e, count(*) AS n FROM failing GROUP BY ALL
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
steps AS (
    SELECT p.filter_order, s.step, p.filter_order[s.step] AS f, p.filter_order[1:s.step - 1] AS before
    FROM (
        SELECT q.f || r.f || s.f || t.f || u.f AS filter_order
        FROM letters q JOIN letters r ON r.f <> q.f
        JOIN letters s ON s.f NOT IN (q.f, r.f)
        JOIN letters t ON t.f NOT IN (q.f, r.f, s.f)
        JOIN letters u ON u.f NOT IN (q.f, r.f, s.f, t.f)
    ) p, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s
),
named AS (
    SELECT part, good, toxic, n,
           (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
           || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails
    FROM counted
),
judged AS (
    SELECT part, filter_order, step, f, good, toxic, n, fails,
           contains(fails, f) AS here,
           before <> '' AND length(translate(fails, before, '')) < length(fails) AS earlier
    FROM named, steps
),
summed AS (
    SELECT part, filter_order, step, f,
           sum(CASE WHEN NOT here AND NOT earlier THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN here AND NOT earlier THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN here AND earlier THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN here AND NOT earlier AND good = 1 THEN n ELSE 0 END) AS good_lost,
           sum(CASE WHEN here AND NOT earlier AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
    FROM judged GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM summed
"""
