"""Operator 10: document fingerprints by invertible Bloom lookup tables (IBLT).

A text is cut into paragraph digests: paragraphs end at a line break, long ones also after
a word whose hash says so or that repeats the one before, so an edit moves only the cuts beside it.  Every digest (numbered
if it repeats) goes to ``HASHES`` cells of a table that keep a count, the XOR of the digests
and the XOR of their check sums.  Two versions' tables are subtracted cell by cell; peeling
cells that hold a single digest recovers the differing ones.  When cells remain, both tables
are built four times as large and the peeling starts anew.

The fingerprint is the smallest table (``CELLS``), as text.  Likeness is the share of digests
that both versions hold among those that either holds (1 for two empty texts).

Defined cases: a null text is empty; a null id comes after all others, in the order of the
text's hash, as do repeated ids among themselves; a single row is its own next; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from forgelake.llm.common import lower_ascii, mix64, row_chunks, span_hashes, table, word_spans

CELLS = 24
HASHES = 3
GROWTH = 4
CUT = 4
#: Rows in a range of ids; the number of ranges is bounded since their first rows are listed on the driver.
RANGE_ROWS, MOST_RANGES = 1500, 10_000


def digests(texts: list[bytes]) -> list[np.ndarray]:
    """Distinct 64-bit paragraph digests of each text; repeats are numbered."""
    offsets = np.cumsum([0] + [len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(data):
        return [np.zeros(0, np.uint64) for _ in texts]
    low = lower_ascii(data)
    starts, ends, edges = word_spans(low, offsets)
    word = span_hashes(low, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    again = np.r_[np.zeros(min(1, len(word)), bool), word[1:] == word[:-1]]
    again[edges[edges < len(word)]] = False  # the first word of a text follows none
    stop = ends[(word % np.uint64(CUT) == 0) | again]
    cuts = np.unique(np.concatenate([offsets, stop, np.flatnonzero(data == 10) + 1]))
    h = span_hashes(data, cuts[:-1], cuts[1:])
    row = np.searchsorted(offsets, cuts[:-1], "right") - 1
    order = np.lexsort((h, row))
    hs, rs = h[order], row[order]
    first = np.r_[True, (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])]
    at = np.arange(len(hs))
    nth = at - np.maximum.accumulate(np.where(first, at, 0))
    numbered = mix64(hs + nth.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    edges = np.searchsorted(rs, np.arange(len(texts) + 1))
    return [numbered[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _places(keys: np.ndarray, cells: int) -> np.ndarray:
    """(HASHES, n): a cell of each third of the table."""
    part = cells // HASHES
    return np.stack([(mix64(keys ^ np.uint64(0x51ED270B * (i + 1) + cells)) % np.uint64(part)).astype(np.int64) + i * part for i in range(HASHES)])


def _check(keys: np.ndarray) -> np.ndarray:
    return mix64(keys + np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)


def build(sets: list[np.ndarray], cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables (count, key XOR, check XOR) of shape (sets, cells)."""
    keys = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    count = np.zeros(len(sets) * cells, np.int64)
    key, check = np.zeros(len(count), np.uint64), np.zeros(len(count), np.uint64)
    _toggle(count, key, check, row, keys, np.ones(len(keys), np.int64), cells)
    return tuple(x.reshape(len(sets), cells) for x in (count, key, check))


def _toggle(count, key, check, row, keys, sign, cells) -> None:
    places = _places(keys, cells) + row * cells
    marks = _check(keys)
    for p in places:
        np.add.at(count, p, sign)
        np.bitwise_xor.at(key, p, keys)
        np.bitwise_xor.at(check, p, marks)


def peel(count: np.ndarray, key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Peel subtracted tables: (row, digest, sign) of all that was recovered, and which rows came out whole."""
    rows, cells = count.shape
    count, key, check = count.ravel().copy(), key.ravel().copy(), check.ravel().copy()
    out = []
    for _ in range(4 * cells):
        pure = np.flatnonzero((np.abs(count) == 1) & (check == _check(key)))
        if not len(pure):
            break
        row, keys, sign = pure // cells, key[pure], count[pure]
        _, one = np.unique(np.rec.fromarrays([row, keys]), return_index=True)
        row, keys, sign = row[one], keys[one], sign[one]
        _toggle(count, key, check, row, keys, -sign, cells)
        out.append((row, keys, sign))
    whole = ~((count != 0) | (key != 0)).reshape(rows, cells).any(axis=1)
    z = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3)]
    return z[0], z[1], z[2], whole


def differences(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of digests on one side only, per pair; larger tables until each pair peels."""
    out = np.zeros(len(left), np.int64)
    todo, cells = np.arange(len(left)), CELLS
    while len(todo):
        a, b = build([left[i] for i in todo], cells), build([right[i] for i in todo], cells)
        row, _, _, whole = peel(a[0] - b[0], a[1] ^ b[1], a[2] ^ b[2])
        found = np.bincount(row, minlength=len(todo)) if len(row) else np.zeros(len(todo), np.int64)
        out[todo[whole]] = found[whole]
        todo = todo[~whole]
        cells *= GROWTH
    return out


def likeness(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    both = np.array([len(a) + len(b) for a, b in zip(left, right, strict=True)], np.float64)
    differing = differences(left, right)
    return np.where(both > 0, (both - differing) / np.maximum(both + differing, 1), 1.0)


def as_text(count: np.ndarray, key: np.ndarray, check: np.ndarray) -> str:
    return base64.b64encode(count.astype("<i4").tobytes() + key.astype("<u8").tobytes() + check.astype("<u4").tobytes()).decode()


def _fingerprints(rows: list[tuple], nexts: list[str]) -> pa.RecordBatch:
    """rows: (doc_id, text), in order; nexts: the text after each."""
    ids, n_chars, sha, mine, edited, near_e, near_n = [], [], [], [], [], [], []
    texts = [t for _, t in rows]
    changed = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, nexts, strict=True)]
    sizes = np.cumsum([0] + [4 * len(t) for t in texts])
    for i, j in row_chunks(sizes, 1 << 20):
        raw = [t.encode("utf-8", "replace") for t in changed[i:j]]
        a, e, n = (digests(x) for x in ([t.encode("utf-8", "replace") for t in texts[i:j]], raw, [t.encode("utf-8", "replace") for t in nexts[i:j]]))
        ids += [r[0] for r in rows[i:j]]
        n_chars += [len(t) for t in texts[i:j]]
        sha += [hashlib.sha256(r).hexdigest() for r in raw]
        for sets, into in ((a, mine), (e, edited)):
            tables = build(sets, CELLS)
            into += [as_text(*(x[k] for x in tables)) for k in range(len(sets))]
        near_e += likeness(a, e).tolist()
        near_n += likeness(a, n).tolist()
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(n_chars, pa.int64()),
            pa.array(sha, pa.string()),
            pa.array(mine, pa.string()),
            pa.array(edited, pa.string()),
            pa.array(near_e, pa.float64()),
            pa.array(near_n, pa.float64()),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _walk(batches):
    """Rows (range, guest, doc_id, text) in order; each row's next follows it, the guest row ends a range."""
    held = None
    for batch in batches:
        done, nexts = [], []
        columns = [c.to_pylist() for c in batch.columns]
        for part, guest, doc_id, text in zip(*columns, strict=True):
            if held is not None and held[0] == part:
                done.append((held[2], held[3]))
                nexts.append(text)
            held = None if guest else (part, guest, doc_id, text)
            # Further guests of a range (rows that share the id of its first) find no row waiting.
            if sum(map(len, nexts)) > 1 << 22:
                yield _fingerprints(done, nexts)
                done, nexts = [], []
        if done:
            yield _fingerprints(done, nexts)


def in_order(docs: DataFrame) -> DataFrame:
    """(range, guest, doc_id, text) by descending id: each range ends with the first row of the next as a guest.

    Ranges come from approximate percentiles of the ids; the driver sees two numbers a range.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = d.filter("doc_id IS NOT NULL").count()
    parts = int(min(MOST_RANGES, max(1, -(-n // RANGE_ROWS))))
    shares = [i / parts for i in range(1, parts)]
    cuts = []
    if shares and n:
        cuts = sorted(set(d.agg(F.percentile_approx("doc_id", shares, 10 * parts + 10_000)).first()[0]))
    bounds = np.array(cuts, np.int64)
    last = len(cuts)

    @pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        # descending: the largest ids lie in range 0
        return pd.Series(last - np.searchsorted(bounds, ids.to_numpy(np.int64), "left").astype(np.int32))

    # Null ids: ordered by hash, in 32 ranges after the others.
    h = F.xxhash64("text")
    null_part = F.lit(last + 1) + (F.shiftright(h, 59) + 16).cast("int")
    d = d.withColumn("h", h)
    known = d.filter("doc_id IS NOT NULL").withColumn("part", place("doc_id"))
    unknown = d.filter("doc_id IS NULL").withColumn("part", null_part)
    firsts = {r["part"]: ("id", r["x"]) for r in known.groupBy("part").agg(F.max("doc_id").alias("x")).collect()}
    firsts |= {r["part"]: ("h", r["x"]) for r in unknown.groupBy("part").agg(F.min("h").alias("x")).collect()}
    order = sorted(firsts)
    # (range, where its first row goes as a guest)
    into = {p: order[k - 1] for k, p in enumerate(order)}
    by_id = {firsts[p][1]: into[p] for p in order if firsts[p][0] == "id"}
    by_h = {firsts[p][1]: into[p] for p in order if firsts[p][0] == "h"}

    @pandas_udf("int")
    def guest_of_id(ids: pd.Series) -> pd.Series:
        return ids.map(by_id).astype("Int32")

    @pandas_udf("int")
    def guest_of_h(hs: pd.Series) -> pd.Series:
        return hs.map(by_h).astype("Int32")

    known = known.withColumn("guest_part", guest_of_id("doc_id"))
    unknown = unknown.withColumn("guest_part", guest_of_h("h"))
    both = known.unionByName(unknown)
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("guest"))
    visit = F.struct(F.col("guest_part").alias("part"), F.lit(1).alias("guest"))
    rows = both.withColumn("at", F.explode(F.when(F.col("guest_part").isNull(), F.array(own)).otherwise(F.array(own, visit))))
    rows = rows.select(F.col("at.part").alias("part"), F.col("at.guest").alias("guest"), "doc_id", "text", "h")
    return (
        rows.repartition("part")
        .sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), "h")
        .select("part", "guest", "doc_id", "text")
    )


def op10_fingerprints(spark, sf_dir):
    return in_order(table(spark, sf_dir, "documents")).mapInArrow(_walk, OUT)
