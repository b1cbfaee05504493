"""Operator 3: language identification by prediction by partial matching (PPM).

Each language has a byte context tree of orders 0 to ``ORDER`` with frozen counts.  A byte
costs -log2 of its probability by method C: c / (n + d) where the longest context has seen
it, else the escape d / (n + d) times the probability one order lower; below order 0 all
256 bytes are alike.  A text's exact code length is the sum over its bytes (three spaces
stand before it); the shortest wins, and the score is its share of 2**-length.

The cost of a byte hangs on the last ``ORDER`` + 1 bytes alone, so the trees are laid out
as sorted tables of the byte strings seen, with one cost per language, and whole batches
are looked up at once.  Counts come from a bounded sample (``SAMPLE`` texts per language,
least hash first, whole texts) and are summed by Spark; every text is scored whole.

Defined cases: a null text or one without a letter is ``und`` with score 0; so is every
text when nothing can be learned; ties go to the language first by code point; ids may be
null (fold of an empty text) or repeated; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from forgelake.llm.common import fold, table, text_chunks

ORDER = 3
SAMPLE = 400
#: Parts of a language that choose their rows side by side.
PARTS = 64
LETTER = regex.compile(r"\p{L}")


def grams(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> np.ndarray:
    """For each byte the number made of it (lowest byte) and the ``order`` bytes before it in its row."""
    n = len(data)
    out = data.astype(np.uint64)
    place = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    for k in range(1, order + 1):
        before = np.full(n, 32, np.uint64)
        before[k:] = data[:-k] if n > k else before[k:]
        before[place < k] = 32
        out |= before << np.uint64(8 * k)
    return out


def _counts(batches):
    """Arrow batches (lang, text) to (lang, gram, count) of the longest strings."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for i, j, data, offsets in text_chunks(batch.column(1)):
            g, per = grams(data, offsets), np.diff(offsets)
            for lang in sorted(set(langs[i:j])):
                mine = np.repeat(np.array([x == lang for x in langs[i:j]]), per)
                keys, n = np.unique(g[mine], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n, pa.int64())],
                    names=["lang", "gram", "n"],
                )


def training_counts(docs: DataFrame, wanted, sample: int = SAMPLE) -> DataFrame:
    """(lang, gram, n) over at most ``sample`` rows of each language."""
    order = [F.xxhash64(F.lit("langid"), "doc_id"), F.col("doc_id")]
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & wanted)
    # The first of the first: a part of a language gives ``sample`` rows at most, so none gathers in one task.
    part = Window.partitionBy("lang", "part").orderBy(*order)
    some = known.select("lang", "doc_id", (F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))).alias("part")).withColumn("at", F.row_number().over(part))
    some = some.filter(F.col("at") <= sample).select("lang", "doc_id")
    whole = Window.partitionBy("lang").orderBy(*order)
    chosen = some.withColumn("at", F.row_number().over(whole)).filter(F.col("at") <= sample).select("lang", "doc_id").distinct()
    # ``sample`` ids per language, a bounded table
    texts = docs.join(F.broadcast(chosen), ["lang", "doc_id"]).select("lang", "text")
    return texts.mapInArrow(_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def model(counts, order: int = ORDER) -> tuple[list[str], list[dict]]:
    """(languages, per order k a table): ``keys`` are the strings of k + 1 bytes that any language has seen;
    ``cost`` the bits of the last byte after the others, ``escape`` the bits of leaving each of the ``contexts``."""
    langs = sorted({r[0] for r in counts})
    tops = []
    for lang in langs:
        rows = [(r[1], r[2]) for r in counts if r[0] == lang]
        tops.append((np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.float64)))
    tables, roots = [], np.zeros(len(langs))
    for k in range(order + 1):
        mask = np.uint64((1 << (8 * (k + 1))) - 1)
        shorter = [np.unique(g & mask, return_inverse=True) for g, _ in tops]
        keys = np.unique(np.concatenate([s[0] for s in shorter])) if langs else np.zeros(0, np.uint64)
        before = np.unique(keys >> np.uint64(8))
        cost, escape = np.empty((len(keys), len(langs))), np.zeros((len(before), len(langs)))
        for i, (own, inverse) in enumerate(shorter):
            n = np.bincount(inverse, tops[i][1], minlength=len(own))
            contexts, at = np.unique(own >> np.uint64(8), return_inverse=True)
            total, kinds = np.bincount(at, n), np.bincount(at)
            # one order lower for every key, escape of this context first (0 where the language never saw it)
            lower = tables[k - 1]["cost"][np.searchsorted(tables[k - 1]["keys"], keys & np.uint64((1 << (8 * k)) - 1)), i] if k else np.full(len(keys), 8.0)
            spot = np.minimum(np.searchsorted(contexts, keys >> np.uint64(8)), len(contexts) - 1)
            leave = np.where(contexts[spot] == keys >> np.uint64(8), -np.log2(kinds / (total + kinds))[spot], 0.0)
            cost[:, i] = lower + leave
            cost[np.searchsorted(keys, own), i] = -np.log2(n / (total + kinds)[at])
            if k:
                escape[np.searchsorted(before, contexts), i] = -np.log2(kinds / (total + kinds))
            else:
                roots[i] = -np.log2(kinds / (total + kinds))[0]
        tables.append({"keys": keys, "cost": cost, "contexts": before, "escape": escape})
    return langs, [{"root": roots}, *tables]


def byte_costs(g: np.ndarray, tables: list[dict]) -> np.ndarray:
    """Bits of each byte in each language, from the longest string downwards."""
    root, levels = tables[0]["root"], tables[1:]
    order = len(levels) - 1
    out = np.zeros((len(g), len(root)))
    rest = np.arange(len(g))
    for k in range(order, -1, -1):
        if not len(rest):
            break
        keys = levels[k]["keys"]
        want = g[rest] & np.uint64((1 << (8 * (k + 1))) - 1)
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        hit = keys[at] == want
        out[rest[hit]] += levels[k]["cost"][at[hit]]
        rest, want = rest[~hit], want[~hit]
        if k:  # leave the context of k bytes
            contexts, seen = want >> np.uint64(8), levels[k]["contexts"]
            at = np.minimum(np.searchsorted(seen, contexts), len(seen) - 1)
            known = seen[at] == contexts
            out[rest[known]] += levels[k]["escape"][at[known]]
        else:
            out[rest] += root + 8.0
    return out


def predictor(spark, langs: list[str], tables: list[dict]):
    shared = spark.sparkContext.broadcast((langs, tables))  # bounded by the training sample

    @pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        langs, tables = shared.value
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        for i, j, data, offsets in text_chunks(pa.Array.from_pandas(texts, type=pa.large_string()), 1 << 18):
            if not langs or not len(data):
                continue
            sums = np.vstack([np.zeros(len(langs)), np.cumsum(byte_costs(grams(data, offsets), tables), axis=0)])
            bits = sums[offsets[1:]] - sums[offsets[:-1]]
            best = bits.argmin(axis=1)
            share = 1 / np.exp2(np.clip(bits.min(axis=1, keepdims=True) - bits, -1000, 0)).sum(axis=1)
            for k in range(i, j):
                if texts.iloc[k] is not None and LETTER.search(texts.iloc[k]):
                    names[k], scores[k] = langs[best[k - i]], share[k - i]
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predict


def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    counts = training_counts(docs, fold("doc_id", 5) != 0).collect()  # bounded by the sample
    predict = predictor(spark, *model(counts))
    out = docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), predict(F.col("text").cast("string")).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")
