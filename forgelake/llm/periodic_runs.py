"""Operator 13: periodic runs of words, by seed and extend along diagonals.

A run is a stretch of words that repeats with smallest period q, is at least
``max(LEAST_WORDS, 2 * q)`` words long and cannot grow on either side.  A run laid over itself,
shifted by q, agrees on length - q words; the least such overlap among the periods of a class is
the size of the k-grams that are indexed for that class: 6 words for lags 1 to 7, and 2**j words
for lags 2**j to 2**(j+1) - 1.  Two occurrences of a k-gram in one document, at a lag of that
class, are a seed.  Seeds are taken by lag and place; a seed inside what its lag's earlier seeds
have covered is not extended again; the others grow to the left and right, and of equal stretches
the one with the smallest lag is kept, whose lag is then the smallest period.

k-grams are named exactly (doubling: the name of 2k words is the pair of names of k words), and
only those that occur twice in a document live on, so an ordinary text is done after a few
levels.  Extension steps over named k-grams from long to short.

Not every pair is listed.  Where a k-gram recurs within k/2 words (a passage of a short period),
only its first place in that passage makes pairs.  That loses no run: let a run start at s, with
period q in the class, and say that neither s nor s + q is such a first place.  Then the word
before s is the one that the k-gram's own period asks for, and so is the word before s + q; they
are equal, and the run would start before s.  So pairs stay near-linear in the words, even in a
text that repeats one word.

Defined cases: a null or empty text has no words and no runs; runs that overlap are all reported
and their repeats removed once; ties have no order to choose, as all runs are reported by start,
then period; rows are independent, so null or repeated ids, repeated rows and other columns do not matter;
an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from itertools import compress, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from forgelake.llm.common import row_chunks, table, text_bytes

LEAST_WORDS = 12
#: Lags below FIRST_LAGS share the k-gram size that every run of at least LEAST_WORDS guarantees them.
FIRST_LAGS, FIRST_GRAM = 8, 6
#: One in PLANTED documents of the query gets a periodic tail.
PLANTED = 10

RUN = "struct<start:long,length:long,period:long>"
REPORT = f"struct<runs:array<{RUN}>,collapsed:string>"


def _named(parts: list[np.ndarray], steps: list[int]) -> np.ndarray:
    """Names of the grams made of parts[i] at steps[i]; -1 where a gram occurs once or a part does."""
    n = len(parts[0])
    out = np.full(n, -1, np.int32)
    at = np.flatnonzero(parts[0] >= 0)
    at = at[at + steps[-1] < n]
    for p, s in zip(parts[1:], steps[1:], strict=True):
        at = at[p[at + s] >= 0]
    if not len(at):
        return out
    key = parts[0][at].astype(np.int64)
    for p, s in zip(parts[1:], steps[1:], strict=True):
        key = key * (int(p.max()) + 1) + p[at + s]
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.r_[True, key[1:] != key[:-1]]
    name = np.cumsum(new) - 1
    size = np.diff(np.r_[np.flatnonzero(new), len(key)])
    again = size > 1
    fresh = np.cumsum(again) - 1
    kept = again[name]
    out[at[order[kept]]] = fresh[name[kept]]
    return out


def _levels(codes: np.ndarray) -> dict[int, np.ndarray]:
    """Names of k-grams for k = 1, 2, 4, ... and FIRST_GRAM, as long as any occurs twice."""
    levels = {1: _named([codes], [0])}
    k = 1
    while (levels[k] >= 0).any():
        levels[2 * k] = _named([levels[k], levels[k]], [0, k])
        k *= 2
    if 4 in levels:
        levels[FIRST_GRAM] = _named([levels[4], levels[2]], [0, 4])
    return levels


def _seeds(codes: np.ndarray, names: np.ndarray, k: int, low: int, high: int) -> np.ndarray:
    """lag * n + place of the pairs of equal k-grams at lags low to high - 1 (see the module's text for what is left out)."""
    n = len(codes)
    at = np.flatnonzero(names >= 0)
    if not len(at):
        return np.zeros(0, np.int64)
    key = np.sort(names[at].astype(np.int64) * n + at)
    at, base = key % n, key // n * n
    same = base[1:] == base[:-1]
    gap = np.where(same, at[1:] - at[:-1], n)
    near = np.minimum(np.r_[gap, n], np.r_[n, gap])
    period = np.where(near <= k // 2, near, 0)
    inside = (period > 0) & (at > 0) & (codes[at - 1] == codes[np.minimum(at - 1 + period, n - 1)])
    at, base = at[~inside], base[~inside]
    found = []
    for ahead in (True, False):
        if ahead:
            a, b = base + np.minimum(at + low, n), base + np.minimum(at + high, n)
        else:
            a, b = base + np.maximum(at - high + 1, 0), base + np.maximum(at - low + 1, 0)
        a, b = np.searchsorted(key, a), np.searchsorted(key, b)
        many = b - a
        own = np.repeat(at, many)
        other = key[np.repeat(a - np.cumsum(many) + many, many) + np.arange(many.sum())] % n
        found.append((other - own) * n + own if ahead else (own - other) * n + other)
    return np.unique(np.concatenate(found))


def _reach(levels: dict[int, np.ndarray], i: np.ndarray, lag: np.ndarray, back: bool) -> np.ndarray:
    """How many words agree from i and i + lag on (back: before them)."""
    got = np.zeros(len(i), np.int64)
    for k in sorted((k for k in levels if k & (k - 1) == 0), reverse=True):
        names = levels[k]
        a = i - got - k if back else i + got
        b = a + lag
        ok = np.flatnonzero((a >= 0) & (b < len(names)))
        left = names[a[ok]]
        got[ok[(left >= 0) & (left == names[b[ok]])]] += k
    return got


def _extended(levels: dict[int, np.ndarray], pairs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, lag) of the stretches that the seeds (lag * n + place, ascending) grow to."""
    lag, at = pairs // n, pairs % n
    # A seed one place after another of its lag lies in what that one covers.
    head = np.r_[True, pairs[1:] != pairs[:-1] + 1] if len(pairs) else np.zeros(0, bool)
    lag, at = lag[head], at[head]
    end = at + _reach(levels, at, lag, back=False)
    # The furthest place that each lag's earlier seeds have covered; lags stay apart by their offset.
    furthest = np.maximum.accumulate(np.r_[0, lag * (n + 1) + end])[:-1] if len(lag) else lag
    new = lag * (n + 1) + at >= furthest
    lag, at, end = lag[new], at[new], end[new]
    start = at - _reach(levels, at, lag, back=True)
    return start, end + lag, lag


def periodic_runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run in a sequence of word codes, by start, then period.

    Documents may be laid end to end if no two share a code: then no run crosses them.
    """
    n = len(codes)
    z = np.zeros(0, np.int64)
    if n < LEAST_WORDS:
        return z, z, z
    levels = _levels(codes)
    seeds = [_seeds(codes, levels[FIRST_GRAM], FIRST_GRAM, 1, FIRST_LAGS)] if FIRST_GRAM in levels else []
    seeds += [_seeds(codes, names, k, k, 2 * k) for k, names in levels.items() if k >= FIRST_LAGS and k & (k - 1) == 0]
    pairs = np.sort(np.concatenate(seeds)) if seeds else z
    start, end, lag = _extended(levels, pairs, n)
    long = end - start >= np.maximum(LEAST_WORDS, 2 * lag)
    start, end, lag = start[long], end[long], lag[long]
    order = np.lexsort((lag, end, start))
    start, end, lag = start[order], end[order], lag[order]
    least = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])] if len(start) else np.zeros(0, bool)
    start, end, lag = start[least], end[least], lag[least]
    order = np.lexsort((lag, start))
    return start[order], (end - start)[order], lag[order]


def repeated(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, start + length, -1)
    return np.cumsum(step[:-1]) > 0


def _reports(texts: list[bytes]) -> tuple[list[int], list[np.ndarray], list[bytes]]:
    """Per text its number of runs and the collapsed text; and the runs of all."""
    split, codes, fresh = [t.split() for t in texts], [], count()
    for words in split:
        name = dict(zip(dict.fromkeys(words), fresh, strict=False))
        codes.append(np.fromiter(map(name.__getitem__, words), np.int32, len(words)))
    edges = np.cumsum([0] + [len(c) for c in codes])
    start, length, period = periodic_runs(np.concatenate(codes) if codes else np.zeros(0, np.int32))
    row = np.searchsorted(edges, start, "right") - 1
    keep = ~repeated(int(edges[-1]), start, length, period)
    many = np.bincount(row, minlength=len(texts))
    out = []
    for k, words in enumerate(split):
        out.append(b" ".join(compress(words, keep[edges[k] : edges[k + 1]].tolist()) if many[k] else words))
    return many.tolist(), [start - edges[row], length, period], out


def _scan(texts: pa.Array) -> pa.Array:
    data, offsets = text_bytes(texts)
    many, runs, collapsed = [0], [[], [], []], []
    for i, j in row_chunks(offsets):
        n, found, kept = _reports([data[a:b].tobytes() for a, b in zip(offsets[i:j], offsets[i + 1 : j + 1], strict=True)])
        many += n
        collapsed += kept
        for into, x in zip(runs, found, strict=True):
            into.append(x)
    columns = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in runs]
    lists = pa.ListArray.from_arrays(pa.array(np.cumsum(many), pa.int32()), pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
    return pa.StructArray.from_arrays([lists, pa.array(collapsed, pa.binary()).cast(pa.string())], ["runs", "collapsed"])


def with_runs(text: Column) -> Column:
    """A struct of the ``runs`` (start, length, period, in words) of each text and the text ``collapsed``:
    words that repeat a period before them left out, the others joined by one space."""

    @arrow_udf(REPORT)
    def scan(texts: pa.Array) -> pa.Array:
        return _scan(texts)

    return scan(text.cast("string"))


def _tailed(text: bytes, doc_id: int) -> bytes:
    """The query's planted case: from word a on, the words repeat with period p."""
    h = zlib.crc32(str(doc_id).encode())
    if h % PLANTED:
        return text
    words, g = text.split(), h // PLANTED
    n = len(words)
    if not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)])


def planted(doc_id: Column, text: Column) -> Column:
    """Texts of which one in ten (by the id's crc32; a null id never) ends in a periodic tail."""

    @arrow_udf("string")
    def plant(ids: pa.Array, texts: pa.Array) -> pa.Array:
        raw = pc.fill_null(texts.cast(pa.binary()), b"").to_pylist()
        out = [t if d is None else _tailed(t, d) for d, t in zip(ids.to_pylist(), raw, strict=True)]
        return pa.array(out, pa.binary()).cast(pa.string())

    return plant(doc_id.cast("long"), text.cast("string"))


def op13_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", with_runs(planted(F.col("doc_id"), F.col("text"))).alias("found"))
    runs = F.col("found.runs")
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return docs.select("doc_id", runs.alias("runs"), F.col("found.collapsed").alias("collapsed"), best.alias("best"), lines.alias("lines")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(F.col("best.length") * 1000 / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
