"""Operator 4: toxicity by a character n-gram linear classifier with naive Bayes log-count ratios.

A text is the set of its hashed byte n-grams (ASCII lower case).  Each feature present
counts with its log-count ratio r = log((p + a) / |p|) - log((q + a) / |q|), p and q the
numbers of toxic and clean training texts that hold it; a logistic regression over those
scaled features gives the score.  The fit uses a bounded sample of the labelled rows
(``SAMPLE`` per class, chosen by hash); scoring covers every byte of every text.

Defined cases: a null or empty text has no features and scores by the intercept; ids may
be null (fold 0 of an empty text) or repeated; labels that are null are not learned; with
learned rows of one class alone every score is that class's, and 0 without any; an empty table
gives no rows; other columns are ignored (``scored`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from forgelake.llm.common import fold, lower_ascii, mix64, table, text_chunks

SIZES = (3, 4, 5)
BITS = 18
SAMPLE = 3000
SMOOTHING = 1.0
LEAST_ROWS, LEAST_RATIO = 4, 0.5
RIDGE = 1e-4
#: Entries of the training matrix handled at once on the driver.
PIECE = 1 << 20
THRESHOLD = 0.7


def gram_codes(data: np.ndarray, sizes=SIZES, bits: int = BITS) -> list[np.ndarray]:
    """Per n the hashed n-grams that start at each byte of ``data``."""
    low = lower_ascii(data).astype(np.uint64)
    out, code = [], np.zeros(len(low), np.uint64)
    for n in range(1, max(sizes) + 1):
        if len(low) < n:
            code = code[:0]
        else:
            code = code[: len(low) - n + 1] | (low[n - 1 :] << np.uint64(8 * (n - 1)))
        if n in sizes:
            out.append((mix64(code * np.uint64(8) + np.uint64(n % 8)) >> np.uint64(64 - bits)).astype(np.int32))
    return out


def _rows(codes: list[np.ndarray], sizes, a: int, b: int) -> np.ndarray:
    """The hashed n-grams inside bytes [a, b), not crossing rows."""
    return np.concatenate([c[a : max(a, b - n + 1)] for c, n in zip(codes, sizes, strict=True)])


def _packed(squeeze, features: np.ndarray) -> bytes:
    """Sorted features as compressed steps."""
    return squeeze.compress(np.diff(features, prepend=np.int32(0)).astype(np.int32).tobytes())


def _unpacked(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(blob), np.int32))


def _features(batches):
    """Arrow batches (label, text) to (label, distinct features, packed)."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        labels = batch.column(0).to_pylist()
        out = []
        for i, _, data, offsets in text_chunks(batch.column(1)):
            codes = gram_codes(data)
            out += [_packed(squeeze, np.unique(_rows(codes, SIZES, a, b))) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            del i
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(out, pa.binary())], names=["label", "features"])


def training_sample(docs: DataFrame, labels: DataFrame, label: str, wanted, per_class: int) -> DataFrame:
    """(label, text) of at most ``per_class`` labelled rows of each class, least hash first."""
    known = (
        labels.filter(F.col(label).isNotNull() & wanted)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .select("doc_id", "label", F.xxhash64(F.lit(label), "doc_id").alias("order"))
    )
    clean, toxic = (known.filter(F.col("label") == c).orderBy("order").limit(per_class) for c in (0, 1))
    chosen = clean.unionByName(toxic)
    # classes * per_class rows of two numbers: bounded, so it may be broadcast
    return docs.join(F.broadcast(chosen.select("doc_id", "label")), "doc_id").select("label", "text")


def fit(docs: DataFrame, labels: DataFrame, label: str, wanted, per_class: int = SAMPLE, rounds: int = 120) -> tuple[np.ndarray, float]:
    """(weight of each hashed feature, intercept), r already multiplied in."""
    sample = training_sample(docs, labels, label, wanted, per_class)
    weights = np.zeros(1 << BITS, np.float32)
    rows = sample.mapInArrow(_features, "label int, features binary").collect()  # bounded by per_class
    y = np.array([r["label"] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return weights, 40.0 if len(y) and y[0] == 1 else -40.0
    packed, n = [r["features"] for r in rows], len(rows)
    del rows
    # Sets stay packed on the driver; only their telling features are ever held side by side.
    p, q = np.full(1 << BITS, SMOOTHING), np.full(1 << BITS, SMOOTHING)
    for blob, toxic in zip(packed, y, strict=True):
        (p if toxic else q)[_unpacked(blob)] += 1
    r = np.log(p / (y.sum() + 2 * SMOOTHING)) - np.log(q / ((1 - y).sum() + 2 * SMOOTHING))
    # A feature that is rare or as common in either class tells nothing: its r is taken as 0.
    r[(p + q < LEAST_ROWS + 2 * SMOOTHING) | (np.abs(r) < LEAST_RATIO)] = 0
    used = np.flatnonzero(r)
    column_of = np.zeros(1 << BITS, np.int32)
    column_of[used] = np.arange(len(used))
    sets = [column_of[s[r[s] != 0]] for s in map(_unpacked, packed)]
    row = np.repeat(np.arange(n, dtype=np.int32), [len(s) for s in sets])
    column, ratio, size = np.concatenate(sets), r[used], len(used)
    del packed, sets
    pieces = [slice(i, i + PIECE) for i in range(0, len(row), PIECE)]

    def by_text(v: np.ndarray) -> np.ndarray:
        v, out = ratio * v, np.zeros(n)
        for at in pieces:
            out += np.bincount(row[at], v[column[at]], minlength=n)
        return out

    def by_feature(v: np.ndarray) -> np.ndarray:
        out = np.zeros(size)
        for at in pieces:
            out += np.bincount(column[at], v[row[at]], minlength=size)
        return ratio * out

    # Accelerated gradient descent on the ridge logistic loss; power steps bound the curvature.
    v, curve = np.ones(size), 1.0
    for _ in range(12):
        v = by_feature(by_text(v))
        curve = np.linalg.norm(v) or 1.0
        v = v / curve
    balance = np.where(y == 1, n / (2 * y.sum()), n / (2 * (1 - y).sum()))  # either class weighs the same
    rate = 1 / (0.25 * curve / n * 1.1 * balance.max() + RIDGE + 0.25)
    w, b, w0, b0 = np.zeros(size), 0.0, np.zeros(size), 0.0
    for t in range(rounds):
        push = t / (t + 3)
        wy, by = w + push * (w - w0), b + push * (b - b0)
        z = by_text(wy) + by
        error = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        error *= balance
        w0, b0 = w, b
        w = wy - rate * (by_feature(error) / n + RIDGE * wy)
        b = by - rate * error.mean()
    weights[used] = (w * ratio).astype(np.float32)
    return weights, float(b)


def scorer(spark, weights: np.ndarray, intercept: float):
    shared = spark.sparkContext.broadcast(weights)  # 2**BITS floats, whatever the input

    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        w, out = shared.value, np.empty(len(texts))
        seen = np.full(len(w), -1, np.int32)
        for i, j, data, offsets in text_chunks(pa.Array.from_pandas(texts, type=pa.large_string())):
            codes = gram_codes(data)
            for k in range(i, j):
                f = _rows(codes, SIZES, offsets[k - i], offsets[k - i + 1])
                at = np.arange(len(f), dtype=np.int32)
                seen[f] = at  # the last place of each feature: each counts once
                z = float(w[f[seen[f] == at]].sum(dtype=np.float64)) + intercept
                out[k] = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
        return pd.Series(out)

    return score


def scored(docs: DataFrame, labels: DataFrame, into: str = "score") -> DataFrame:
    """``docs`` with the toxicity score of each text; rows of fold 1 of 3 are never learned."""
    weights, intercept = fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), "toxic", fold("doc_id", 3) != 1)
    return docs.withColumn(into, scorer(docs.sparkSession, weights, intercept)(F.col("text").cast("string")))


def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
