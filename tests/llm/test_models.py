"""The fitted models of operators 4 and 8 against plain versions: dicts, dense matrices, loops over sites."""

from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import words

from forgelake.llm import quality, toxicity
from forgelake.llm.common import fold

MASK = (1 << 64) - 1


def plain_mix(h: int) -> int:
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & MASK
    return h ^ (h >> 31)


def plain_features(text: str) -> set[int]:
    low = bytes(b | 32 if 65 <= b <= 90 else b for b in text.encode())
    grams = {low[i : i + n] for n in toxicity.SIZES for i in range(len(low) - n + 1)}
    return {plain_mix(int.from_bytes(g, "little") * 8 + len(g) % 8) >> (64 - toxicity.BITS) for g in grams}


def plain_fit(rows, rounds=120):
    """(weights, intercept) by a dense matrix; rows: (text, label)."""
    sets, y = [plain_features(t) for t, _ in rows], np.array([label for _, label in rows], float)
    counts = {0: defaultdict(int), 1: defaultdict(int)}
    for s, label in zip(sets, y, strict=True):
        for f in s:
            counts[int(label)][f] += 1
    a, n = toxicity.SMOOTHING, len(rows)
    r = {}
    for f in {*counts[0], *counts[1]}:
        p, q = counts[1][f] + a, counts[0][f] + a
        ratio = math.log(p / (y.sum() + 2 * a)) - math.log(q / ((1 - y).sum() + 2 * a))
        if p + q >= toxicity.LEAST_ROWS + 2 * a and abs(ratio) >= toxicity.LEAST_RATIO:
            r[f] = ratio
    used = sorted(r)
    x = np.array([[r[f] if f in s else 0.0 for f in used] for s in sets])
    v, curve = np.ones(len(used)), 1.0
    for _ in range(12):
        v = x.T @ (x @ v)
        curve = np.linalg.norm(v) or 1.0
        v = v / curve
    balance = np.where(y == 1, n / (2 * y.sum()), n / (2 * (1 - y).sum()))
    rate = 1 / (0.25 * curve / n * 1.1 * balance.max() + toxicity.RIDGE + 0.25)
    w, b, w0, b0 = np.zeros(len(used)), 0.0, np.zeros(len(used)), 0.0
    for t in range(rounds):
        push = t / (t + 3)
        wy, by = w + push * (w - w0), b + push * (b - b0)
        error = (1 / (1 + np.exp(-np.clip(x @ wy + by, -40, 40))) - y) * balance
        w0, b0, w, b = w, b, wy - rate * (x.T @ error / n + toxicity.RIDGE * wy), by - rate * error.mean()
    return {f: w[i] * r[f] for i, f in enumerate(used)}, b


def test_toxicity_weights_and_scores_are_the_plain_ones(spark):
    rng = random.Random(8)
    rows = [(i, words(rng, rng.randint(3, 25)) + (" Vile IDIOT scum" if i % 3 == 0 else " é nice"), int(i % 3 == 0)) for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    learned = [(t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    assert 60 < len(learned) < 110
    weights, b = toxicity.fit(docs, labels, "toxic", fold("doc_id", 3) != 1)
    want, want_b = plain_fit(learned)
    assert len(want) > 50 and set(np.flatnonzero(weights).tolist()) == {f for f, w in want.items() if w}
    assert abs(b - want_b) < 1e-9 and max(abs(float(weights[f]) - w) for f, w in want.items()) < 1e-6  # kept as 32-bit floats
    got = {r.doc_id: r.score for r in toxicity.scored(docs, labels).collect()}
    for i, t, _ in rows:
        z = sum(float(weights[f]) for f in plain_features(t)) + b
        assert abs(got[i] - 1 / (1 + math.exp(-z))) < 1e-9


def plain_strength(sites):
    """sites: (n, s, mean) of each; the prior strength by the method of moments."""
    total = sum(n for n, _, _ in sites)
    spread = sum(n * (s / n - m) ** 2 for n, s, m in sites) / total
    noise = sum(m * (1 - m) for _, _, m in sites) / total
    within = sum(n * m * (1 - m) for n, _, m in sites) / total
    low, high = quality.STRENGTH
    return min(max(within / max(spread - noise, 1e-9) - 1, low), high)


def clipped(x):
    return min(max(x, 1e-6), 1 - 1e-6)


@pytest.mark.parametrize("hosts", [3, 400])
def test_posteriors_of_large_and_of_many_small_sites(spark, hosts):
    rng = random.Random(hosts)
    rows = []
    for i in range(1200):
        h = rng.randrange(hosts)
        rows.append((i, f"h{h}", f"p{rng.randrange(3)}", clipped(rng.betavariate(1 + h % 5, 3))))
    got = {r.doc_id: r for r in quality.shrink(spark.createDataFrame(rows, "doc_id long, host string, path string, p double")).collect()}
    by_host, by_path = defaultdict(list), defaultdict(list)
    for _, h, path, p in rows:
        by_host[h].append(p)
        by_path[h, path].append(p)
    mean = clipped(sum(r[3] for r in rows) / len(rows))
    top = plain_strength([(len(v), sum(v), mean) for v in by_host.values()])
    low = plain_strength([(len(v), sum(v), clipped(sum(by_host[h]) / len(by_host[h]))) for (h, _), v in by_path.items()])
    logit = lambda x: math.log(x / (1 - x))
    for i, h, path, p in rows:
        host = clipped((top * mean + sum(by_host[h]) - p) / (top + len(by_host[h]) - 1))
        site = clipped((low * host + sum(by_path[h, path]) - p) / (low + len(by_path[h, path]) - 1))
        score = 1 / (1 + math.exp(-(logit(clipped(p)) + logit(site) - logit(mean))))
        assert abs(got[i].host_posterior - host) < 1e-9 and abs(got[i].path_posterior - site) < 1e-9 and abs(got[i].score - score) < 1e-9


def test_quality_evidence_is_the_ridge_optimum(spark):
    """At the fitted weights the penalised likelihood has no slope; statistics are those of each text alone."""
    rng = random.Random(9)
    rows = [(i, words(rng, rng.randint(1, 60)) if rng.random() < 0.7 else "BUY!! now 100% 100% " * rng.randint(1, 9), rng.randint(0, 1)) for i in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    model = quality.fit(docs, labels, F.lit(True))
    alone = [quality.statistics(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] for _, t, _ in rows]
    x = np.hstack([alone, np.log(np.abs(alone) + 0.003)])
    z = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-6)
    assert np.abs(model["mean"] - x.mean(axis=0)).max() < 1e-9
    y = np.array([r[2] for r in rows], float)
    p = 1 / (1 + np.exp(-(z @ model["w"] + model["b"])))
    assert np.abs(z.T @ (y - p) - model["w"]).max() < 1e-6 and abs((y - p).sum() - 1e-6 * model["b"]) < 1e-6
    judged = {r.doc_id: r.p for r in docs.select("doc_id", quality.classifier(model)(F.col("text")).alias("p")).collect()}
    assert max(abs(judged[i] - p[i]) for i in judged) < 1e-9
