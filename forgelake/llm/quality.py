"""Operator 8: quality by hierarchical empirical Bayes over hosts and paths.

A logistic classifier on whole-text statistics gives each document its evidence p.  Sites
are summed by grouped aggregation over all documents: the rate of a host shrinks toward
the global mean, the rate of a path toward its host, each by a prior strength estimated
from the spread between sites (method of moments).  A document's own evidence is left out
of its site's sums.  The final log-odds are the document's plus the path posterior's
against the global mean.

The classifier learns from at most ``SAMPLE`` labelled rows (least hash first) whose
crc32(doc_id as text) mod 5 is not 0; sites use every row.  The host of a document is its
source, the path its language there (``site`` is a parameter).

Defined cases: a null text counts as empty; null hosts and paths are sites of their own;
ids may be null (fold of an empty text) or repeated (each row counts); without labels of
both classes the evidence is the class share (0.5 without labels); an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from forgelake.llm.common import fold, lower_ascii, span_hashes, stored, table, text_chunks, word_spans

SAMPLE = 20_000
KEEP = 0.5
STRENGTH = (2.0, 200.0)
SYMBOLS = b"!*#%&$|@~^<>{}[]\\/=+_"
STATISTICS = 12


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` numbers per text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    per = lambda mask: np.bincount(row[mask], minlength=n) / np.maximum(size, 1)
    before = np.r_[np.zeros(1, np.uint8), data[:-1]] if len(data) else data
    upper = ((data >= 65) & (data <= 90)) | ((before == 0xC3) & (data >= 0x80) & (data <= 0x9E))
    low = lower_ascii(data)
    starts, ends, edge = word_spans(low, offsets)
    words = np.diff(edge)
    h = span_hashes(low, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    at = np.repeat(np.arange(n), words)
    order = np.lexsort((h, at))
    hs, rs = h[order], at[order]
    new = np.r_[True, (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])] if len(hs) else np.zeros(0, bool)
    counts = np.diff(np.r_[np.flatnonzero(new), len(hs)])
    most = np.zeros(n)
    np.maximum.at(most, rs[new], counts)
    same = np.r_[False, (h[1:] == h[:-1]) & (at[1:] == at[:-1])] if len(h) else np.zeros(0, bool)
    w = np.maximum(words, 1)
    symbol = np.isin(data, np.frombuffer(SYMBOLS, np.uint8))
    last = symbol[ends - 1] if len(ends) else np.zeros(0, bool)
    return np.column_stack(
        [
            per(upper),
            per((data >= 48) & (data <= 57)),
            per(symbol),
            per((data == 46) | (data == 44) | (data == 59) | (data == 58)),
            per(data == 10),
            per(data >= 128),
            np.bincount(at, ends - starts, minlength=n) / w,
            np.bincount(rs[new], minlength=n) / w,
            np.bincount(at[same], minlength=n) / w,
            most / w,
            np.log1p(words),
            np.bincount(at[last], minlength=n) / w,
        ]
    )


def _stretched(x: np.ndarray) -> np.ndarray:
    """The statistics and their logarithms, for shares that matter by their order of magnitude."""
    return np.hstack([x, np.log(np.abs(x) + 0.003)])


def _labelled(batches):
    for batch in batches:
        labels = np.array(batch.column(0).to_pylist(), np.int64)
        for i, j, data, offsets in text_chunks(batch.column(1)):
            x = statistics(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels[i:j]), pa.array(list(x), pa.list_(pa.float64()))], names=["label", "x"]
            )


def fit(docs: DataFrame, labels: DataFrame, wanted: Column, sample: int = SAMPLE) -> dict:
    """Ridge logistic regression by Newton steps on the sampled rows."""
    chosen = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & wanted)
        .groupBy("doc_id")
        .agg(F.max("quality").cast("long").alias("label"))
        .orderBy(F.xxhash64(F.lit("quality"), "doc_id"))
        .limit(sample)
    )
    rows = docs.join(F.broadcast(chosen), "doc_id").select("label", "text").mapInArrow(_labelled, "label long, x array<double>").collect()
    y = np.array([r["label"] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        share = y.mean() if len(y) else 0.5
        return {"mean": np.zeros(2 * STATISTICS), "scale": np.ones(2 * STATISTICS), "w": np.zeros(2 * STATISTICS), "b": 30 * (2 * share - 1)}
    x = _stretched(np.array([r["x"] for r in rows]))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    ridge = np.r_[np.full(len(w) - 1, 1.0), 1e-6]
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        move = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return {"mean": mean, "scale": scale, "w": w[:-1], "b": w[-1]}


def classifier(model: dict):
    @pandas_udf("double")
    def evidence(texts: pd.Series) -> pd.Series:
        out = np.empty(len(texts))
        for i, j, data, offsets in text_chunks(pa.Array.from_pandas(texts, type=pa.large_string())):
            x = (_stretched(statistics(data, offsets)) - model["mean"]) / model["scale"]
            out[i:j] = 1 / (1 + np.exp(-np.clip(x @ model["w"] + model["b"], -30, 30)))
        return pd.Series(out)

    return evidence


def _strength(n: str, s: str, mean: Column) -> Column:
    """Prior strength from the spread of the rates s / n around ``mean`` (an aggregate expression over sites)."""
    spread = F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - mean, 2)) / F.sum(n)
    noise = F.sum(mean * (1 - mean)) / F.sum(n)
    between = F.greatest(spread - noise, F.lit(1e-9))
    within = F.sum(F.col(n) * mean * (1 - mean)) / F.sum(n)
    return F.least(F.greatest(within / between - 1, F.lit(STRENGTH[0])), F.lit(STRENGTH[1]))


def shrink(judged: DataFrame) -> DataFrame:
    """(doc_id, host, path, p) to the same with host_posterior, path_posterior and score."""
    paths = judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s")).first()
    mean = total["s"] / total["n"] if total["n"] else 0.5
    mean = min(max(mean, 1e-6), 1 - 1e-6)
    top = hosts.agg(_strength("host_n", "host_s", F.lit(mean)).alias("k")).first()["k"] or STRENGTH[0]
    both = paths.join(hosts.hint("merge"), "host")
    rate = F.least(F.greatest(F.col("host_s") / F.col("host_n"), F.lit(1e-6)), F.lit(1 - 1e-6))
    low = both.agg(_strength("n", "s", rate).alias("k")).first()["k"] or STRENGTH[0]
    joined = judged.join(both.hint("merge"), ["host", "path"])
    host = (top * mean + F.col("host_s") - F.col("p")) / (top + F.col("host_n") - 1)
    path = (low * F.col("host_posterior") + F.col("s") - F.col("p")) / (low + F.col("n") - 1)
    logit = lambda c: F.log(c / (1 - c))
    safe = lambda c: F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    out = joined.withColumn("host_posterior", safe(host)).withColumn("path_posterior", safe(path))
    odds = logit(safe(F.col("p"))) + logit(F.col("path_posterior")) - logit(F.lit(mean))
    return out.withColumn("score", 1 / (1 + F.exp(-odds)))


def judge(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """(doc_id, host, path, p, host_posterior, path_posterior, score, keep) for every row of ``docs``."""
    model = fit(docs.select("doc_id", "text"), labels.select("doc_id", "quality"), fold("doc_id", 5) != 0)
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    judged = docs.select(
        "doc_id", name(host).alias("host"), name(path).alias("path"), classifier(model)(F.col("text").cast("string")).alias("p")
    )
    out = shrink(stored(judged, "quality"))
    return out.select(
        "doc_id",
        F.nullif(F.expr("substring(host, 2)"), F.lit("")).alias("host"),
        F.nullif(F.expr("substring(path, 2)"), F.lit("")).alias("path"),
        "p",
        "host_posterior",
        "path_posterior",
        "score",
        (F.col("score") >= KEEP).cast("int").alias("keep"),
    )


def op8_quality(spark, sf_dir):
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumn("held_out", fold("doc_id", 5) == 0)
