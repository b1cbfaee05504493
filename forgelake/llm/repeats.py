"""Operator 5: removal of repeated byte strings by a logarithmic family of suffix arrays.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts in a document with
a smaller id.  Every window of LENGTH bytes belongs to one of its GRAM-byte strings:
the least hash among those that are not frequent, or the rarest (a sketch of a sample tells),
so equal windows of any documents have the same owner.  Texts are cut into runs of
windows with one owner; a run's bytes go to the shard of its owner.  In a shard the runs
arrive as batches in id order: a batch gets the sorted array of its suffixes (their first
LENGTH bytes), is merge-scanned against the arrays of the levels that exist, and what is new
becomes a level; levels of like size merge, so there are only logarithmically many.  All
comparisons are of the bytes themselves, on the input as it was.

Runs that are alike in a map batch are collapsed before the shuffle (the smallest id is
sent, the others are repeats already), and once more in the shard, so a passage that very
many documents share costs a row per map batch.

An owner that holds more than HEAVY_BYTES by the sample is split: its windows are dealt by
their own hash and compared one by one.  Of equal ones in a map batch only those of the
smallest document are sent, once each with the spans that they cover, so no group grows with
an owner's share of the corpus.  Sketch and sample steer cost only.

Defined cases: a null text is empty; a null id counts as larger than all others; rows with
the same id don't remove from each other; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.llm.common import CHUNK_BYTES, row_chunks, span_hashes, stored, table, text_chunks, window_hashes

LENGTH = 50
GRAM = 6
#: Text handled at once by a map task, run bytes in a shard, runs in a batch of a shard.
MAP_BYTES, SHARD_BYTES, BATCH_RUNS = 8 << 20, 4 << 20, 4096
#: Windows in a batch of a shard; run bytes of an owner that is split, bytes of its windows in a shard.
BATCH_WINDOWS, HEAVY_BYTES, SPLIT_BYTES = 1 << 18, 4 << 20, 16 << 20
#: The sample: slices of SLICE bytes, SAMPLE_BYTES or a part in SAMPLE_PART of all text; slots of the sketch.
SLICE, SAMPLE_BYTES, SAMPLE_PART, SKETCH_BITS = 4096, 16 << 20, 256, 22
LAST = (1 << 63) - 1
#: Compression of what crosses a shuffle: a level more costs a few CPU seconds a GB and saves a twentieth of the bytes.
SQUEEZE = 6


def runs(data: np.ndarray, offsets: np.ndarray, levels: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window, number of windows, owner) of each run; windows never cross rows."""
    none = np.zeros(0, np.int64)
    n = len(data)
    if n < LENGTH:
        return none, none, none, none.astype(np.uint64)
    grams = window_hashes(data, GRAM)
    if levels is not None:
        grams = (levels[grams >> np.uint64(64 - SKETCH_BITS)].astype(np.uint64) << np.uint64(56)) | (grams >> np.uint64(8))
    # Least hash of the LENGTH - GRAM + 1 grams of each window, by doubling.
    least, width, want = grams, 1, LENGTH - GRAM + 1
    while 2 * width <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < want:
        least = np.minimum(least[: len(least) - (want - width)], least[want - width :])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    inside = np.arange(len(least)) + LENGTH <= offsets[row + 1]
    new = np.r_[True, (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | ~inside[:-1]] & inside
    first = np.flatnonzero(new)
    if not len(first):
        return none, none, none, none.astype(np.uint64)
    # A run ends before the next run or where windows stop being inside their row.
    stops = np.flatnonzero(~inside)
    next_first = np.r_[first[1:], len(least)]
    next_stop = np.r_[stops, len(least)][np.searchsorted(stops, first)]
    return row[first], first, np.minimum(next_first, next_stop) - first, least[first]


def _alike(digest: np.ndarray, size: np.ndarray, doc: np.ndarray):
    """Collapse runs with the same bytes: (order, group of each in order, first of each group); least document first."""
    order = np.lexsort((doc, size, digest))
    d, s = digest[order], size[order]
    new = np.r_[True, (d[1:] != d[:-1]) | (s[1:] != s[:-1])] if len(order) else np.zeros(0, bool)
    return order, np.cumsum(new) - 1, np.flatnonzero(new)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of many spans, one after another."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return data[_spread(starts, sizes)]


MAPPED = "shard long, doc long, text_hash long, spans binary, size long, body binary"


def _pack(row, start, count, doc, text_hash, data, first) -> bytes:
    """Runs (sorted by row) with the rows' ids, and their bytes."""
    rows, at = np.unique(row, return_inverse=True)
    sizes = np.array([len(rows), len(row)], np.int64)
    columns = [doc[rows], text_hash[rows], np.diff(at, prepend=0).astype(np.int32), start.astype(np.int64), count.astype(np.int64)]
    columns += [_gather(data, first, count + LENGTH - 1)]
    return b"".join([sizes.tobytes(), *[np.frombuffer(c.tobytes(), np.uint8).reshape(len(c), -1).T.tobytes() for c in columns]])


def _unpack(blob: bytes):
    n, m = np.frombuffer(blob, np.int64, 2).tolist()
    out, at = [], 16
    for size, kind in ((n, np.int64), (n, np.int64), (m, np.int32), (m, np.int64), (m, np.int64)):
        width = np.dtype(kind).itemsize  # byte planes: the high bytes lie together and cost next to nothing
        out.append(np.frombuffer(blob, np.uint8, size * width, at).reshape(width, size).T.copy().view(kind).ravel())
        at += size * width
    which = np.cumsum(out[2])
    return out[0][which], out[1][which], out[3], out[4], np.frombuffer(blob, np.uint8, offset=at)


def _pieces(offsets: np.ndarray):
    """(first row, end row, low, high) byte ranges of about CHUNK_BYTES; every window lies in one, also of a long row."""
    for a, b in row_chunks(offsets):
        for low in range(int(offsets[a]), int(offsets[b]), CHUNK_BYTES):
            yield a, b, low, min(low + CHUNK_BYTES + LENGTH - 1, int(offsets[b]))


def _windows(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(data, LENGTH)[at]


def _split(data: np.ndarray, offsets: np.ndarray, row, first, count):
    """Single windows of runs: (hash, row, place of one) of each distinct window of a row, and the spans that it covers."""
    at, of = _spread(first, count), np.repeat(row, count)
    h = span_hashes(data, at, at + LENGTH)
    order = np.argsort(h, kind="stable")  # places ascend within a hash, so rows do
    h, at, of = h[order], at[order], of[order]
    text = _windows(data, at)
    new = np.r_[True, (h[1:] != h[:-1]) | (of[1:] != of[:-1]) | (text[1:] != text[:-1]).any(axis=1)]
    apart = np.flatnonzero(new | np.r_[True, at[1:] > at[:-1] + LENGTH])
    start, end = at[apart], at[np.r_[apart[1:], len(at)] - 1] + LENGTH
    head = np.flatnonzero(new)
    spans = np.stack([start, end], 1) - offsets[of[apart]][:, None]
    return h[head], of[head], at[head], np.diff(np.searchsorted(apart, np.r_[head, len(at)])), spans


PLACED = ((LENGTH, np.uint8), (1, np.int64), (1, np.int64), (1, np.int32))


def _pack_windows(text, doc, text_hash, n, spans) -> bytes:
    """Distinct windows of documents, and the spans that each covers."""
    columns = [c.astype(kind).tobytes() for c, (_, kind) in zip((text, doc, text_hash, n), PLACED, strict=True)]
    return b"".join([np.int64(len(doc)).tobytes(), *columns, spans.astype(np.int64).tobytes()])


def _unpack_windows(blob: bytes):
    size, at, out = int(np.frombuffer(blob, np.int64, 1)[0]), 8, []
    for width, kind in PLACED:
        out.append(np.frombuffer(blob, kind, size * width, at))
        at += out[-1].nbytes
    return out[0].view(f"S{LENGTH}"), *out[1:], np.frombuffer(blob, np.int64, offset=at).reshape(-1, 2)


def _cut(shards: int, splits: int = 1, order=None):
    """(doc_id, text_hash, text) to packed runs by shard, and the spans that repeat within the batch.

    ``order``: broadcast (levels of the sketch, owners to split); shards from ``shards`` on hold single windows.
    """

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=SQUEEZE)
        levels, heavy = order.value if order is not None else (None, np.zeros(0, np.uint64))
        for batch in batches:
            ids = batch.column(0).cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)
            hashes = batch.column(1).to_numpy(zero_copy_only=False)
            for i, _, data, offsets in text_chunks(batch.column(2), MAP_BYTES):
                parts, single, held = [], [], 0
                for a, b, low, high in _pieces(offsets):  # the hashing needs many times a piece's size
                    piece, inside = data[low:high], np.clip(offsets[a : b + 1], low, high) - low
                    row, first, count, owner = runs(piece, inside, levels)
                    split = np.isin(owner, heavy)
                    if split.any():
                        h, r, at, n, spans = _split(piece, offsets[a : b + 1] - low, row[split], first[split], count[split])
                        single.append((h, r + a, at + low, n, spans))
                        row, first, count, owner = (x[~split] for x in (row, first, count, owner))
                    if len(row):
                        digest = span_hashes(piece, first, first + count + LENGTH - 1)
                        parts.append((row + a, first + low, count, owner, digest))
                    held += high - low
                    if held >= MAP_BYTES:
                        yield flush(parts, single, ids[i:], hashes[i:], data, offsets, squeeze)
                        parts, single, held = [], [], 0
                yield flush(parts, single, ids[i:], hashes[i:], data, offsets, squeeze)

    def flush(parts, single, ids, hashes, data, offsets, squeeze):
        out = {"shard": [], "doc": [], "text_hash": [], "spans": [], "size": [], "body": []}
        if parts:
            row, first, count, owner, digest = (np.concatenate(x) for x in zip(*parts, strict=True))
            doc, th, start = ids[row], hashes[row], first - offsets[row]
            order, group, heads = _alike(digest, count, doc)
            smallest = doc[order][heads][group]
            again = order[doc[order] > smallest]
            rest = order[doc[order] == smallest]
            _spans_out(out, doc[again], th[again], start[again], start[again] + count[again] + LENGTH - 1)
            shard = (owner[rest] >> np.uint64(11)).astype(np.int64) % shards

            def packed(p):
                p = np.sort(p)
                return _pack(row[p], start[p], count[p], ids, hashes, data, first[p])

            _bodies_out(out, rest, shard, packed, squeeze)
        if single:
            h, row, at, n, spans = (np.concatenate(x) for x in zip(*single, strict=True))
            doc, begin = ids[row], np.cumsum(n) - n
            order = np.lexsort((doc, h))
            text = _windows(data, at[order])
            new = np.r_[True, (h[order][1:] != h[order][:-1]) | (text[1:] != text[:-1]).any(axis=1)]
            smallest = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
            again, rest = order[doc[order] > smallest], order[doc[order] == smallest]
            s = spans[_spread(begin[again], n[again])]
            _spans_out(out, np.repeat(doc[again], n[again]), np.repeat(hashes[row[again]], n[again]), s[:, 0], s[:, 1])
            shard = shards + (h[rest] >> np.uint64(11)).astype(np.int64) % splits

            def packed(p):
                return _pack_windows(_windows(data, at[p]), doc[p], hashes[row[p]], n[p], spans[_spread(begin[p], n[p])])

            _bodies_out(out, rest, shard, packed, squeeze)
        out["shard"] = [x % shards if s is None else s for s, x in zip(out["shard"], out["doc"], strict=True)]  # spans pass through any shard
        return _batch(out)

    return run


def _bodies_out(out: dict, rest: np.ndarray, shard: np.ndarray, packed, squeeze) -> None:
    """One row per shard with what ``packed`` makes of its members."""
    by = np.argsort(shard, kind="stable")
    rest, shard = rest[by], shard[by]
    edges = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(rest) else np.zeros(1, np.int64)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        raw = packed(rest[a:b])
        for name, value in zip(out, (int(shard[a]), None, None, None, len(raw), squeeze.compress(raw)), strict=True):
            out[name].append(value)


def _spans_out(out: dict, doc, th, start, end) -> None:
    """One row per document: its spans as packed (start, end) pairs."""
    if not len(doc):
        return
    order = np.lexsort((start, th, doc))
    doc, th, start, end = doc[order], th[order], start[order], end[order]
    edges = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]), True])
    pairs = np.stack([start, end], 1).astype(np.int64)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        for name, value in (("shard", None), ("doc", int(doc[a])), ("text_hash", int(th[a])), ("spans", _merged(pairs[a:b]).tobytes()), ("size", None), ("body", None)):
            if name in out:
                out[name].append(value)


def _merged(pairs: np.ndarray) -> np.ndarray:
    """Union of (start, end) pairs sorted by start."""
    if not len(pairs):
        return pairs
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.r_[True, pairs[1:, 0] > reach[:-1]]
    at = np.flatnonzero(new)
    return np.stack([pairs[at, 0], reach[np.r_[at[1:] - 1, len(pairs) - 1]]], 1)


def _batch(out: dict) -> pa.RecordBatch:
    kinds = {"shard": pa.int64(), "doc": pa.int64(), "text_hash": pa.int64(), "spans": pa.binary(), "size": pa.int64(), "body": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(out[k], kinds[k]) for k in out], names=list(out))


class Levels:
    """Sorted arrays of distinct suffixes (LENGTH bytes each); like-sized levels merge."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def known(self, suffixes: np.ndarray) -> np.ndarray:
        """Merge-scan of sorted suffixes against every level."""
        hit = np.zeros(len(suffixes), bool)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level, suffixes), len(level) - 1)
            hit |= level[at] == suffixes
        return hit

    def add(self, suffixes: np.ndarray) -> None:
        """``suffixes``: sorted, distinct, in no level."""
        if not len(suffixes):
            return
        while self.levels and len(self.levels[-1]) <= 2 * len(suffixes):
            suffixes = np.sort(np.concatenate([self.levels.pop(), suffixes]), kind="stable")
        self.levels.append(suffixes)


def _repeated(doc, count, body, base) -> tuple[np.ndarray, np.ndarray]:
    """(run, window) of the windows that a smaller document holds; runs sorted by document."""
    index, runs_hit, windows_hit = Levels(), [], []
    twice = _hashed_twice(body, base, count)
    j, ahead = 0, np.r_[0, np.cumsum(count)]
    while j < len(doc):
        fits = int(np.searchsorted(ahead, ahead[j] + BATCH_WINDOWS, "right")) - 1
        i, j = j, min(j + BATCH_RUNS, max(j + 1, fits), len(doc))
        while j < len(doc) and doc[j] == doc[j - 1]:
            j += 1  # a document lies in one batch
        size = count[i:j]
        which = np.repeat(np.arange(i, j), size)
        place = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        at = base[which] + place
        likely = twice(at)  # a window whose hash is met once can't repeat
        which, place, at = which[likely], place[likely], at[likely]
        if not len(at):
            continue
        text = np.lib.stride_tricks.sliding_window_view(body, LENGTH)[at].copy().view(f"S{LENGTH}").ravel()
        order = np.argsort(text, kind="stable")  # the batch's suffix array; equal suffixes in document order
        text, owner = text[order], doc[which[order]]
        new = np.r_[True, text[1:] != text[:-1]]
        head = np.flatnonzero(new)
        known = index.known(text[head])
        group = np.cumsum(new) - 1
        hit = known[group] | (owner > owner[head][group])
        runs_hit.append(which[order][hit])
        windows_hit.append(place[order][hit])
        index.add(text[head][~known])
    z = np.zeros(0, np.int64)
    return (np.concatenate(runs_hit), np.concatenate(windows_hit)) if runs_hit else (z, z)


def _hashed_twice(body: np.ndarray, base: np.ndarray, count: np.ndarray):
    """A test of window places: whether another window of these runs has the same hash."""
    hashes = np.zeros(len(body), np.uint64)
    inside = np.zeros(len(body), bool)
    inside[_spread(base, count)] = True
    for a in range(0, len(body) - LENGTH + 1, 1 << 20):
        b = min(a + (1 << 20), len(body) - LENGTH + 1)
        hashes[a:b] = window_hashes(body[a : b + LENGTH - 1], LENGTH)
    ordered = np.sort(hashes[inside])
    several = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(several):
        return lambda at: np.zeros(len(at), bool)

    def twice(at: np.ndarray) -> np.ndarray:
        h = hashes[at]
        return several[np.minimum(np.searchsorted(several, h), len(several) - 1)] == h

    return twice


def _scan_of(shards: int):
    def run(tbl: pa.Table) -> pa.Table:
        tbl = tbl.combine_chunks()
        return (_scan if tbl["shard"][0].as_py() < shards else _scan_windows)(tbl)

    return run


def _scan_windows(tbl: pa.Table) -> pa.Table:
    """One shard of single windows: the spans of those that a smaller document holds."""
    squeeze = zstandard.ZstdDecompressor()
    parts = [_unpack_windows(squeeze.decompress(b.as_buffer(), max_output_size=s.as_py())) for b, s in zip(tbl["body"], tbl["size"], strict=True)]
    text, doc, th, n, spans = (np.concatenate([p[i] for p in parts]) for i in range(5))
    begin = np.cumsum(n, dtype=np.int64) - n
    order = np.argsort(doc, kind="stable")
    order = order[np.argsort(text[order], kind="stable")]
    text = text[order]
    new = np.r_[True, text[1:] != text[:-1]]
    again = order[doc[order] > doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]]
    s = spans[_spread(begin[again], n[again])]
    out = {"doc": [], "text_hash": [], "spans": []}
    _spans_out(out, np.repeat(doc[again], n[again]), np.repeat(th[again], n[again]), s[:, 0], s[:, 1])
    return pa.Table.from_batches([_batch(out)])


def _scan(tbl: pa.Table) -> pa.Table:
    """One shard: packed runs to the spans that repeat; spans found before pass through."""
    ready = tbl.filter(pa.compute.is_valid(tbl["spans"])).select(["doc", "text_hash", "spans"])
    tbl = tbl.filter(pa.compute.is_valid(tbl["body"]))
    if not tbl.num_rows:
        return ready
    squeeze = zstandard.ZstdDecompressor()
    parts = [_unpack(squeeze.decompress(b.as_buffer(), max_output_size=s.as_py())) for b, s in zip(tbl["body"], tbl["size"], strict=True)]
    doc, th, start, count, body = (np.concatenate([p[i] for p in parts]) for i in range(5))
    del parts
    base = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
    out = {"doc": [], "text_hash": [], "spans": []}
    if len(doc):
        order, group, heads = _alike(_digests(body, base, count), count, doc)
        smallest = doc[order][heads][group]
        again, rest = order[doc[order] > smallest], order[doc[order] == smallest]
        # Of equal runs in one document one is scanned, and stands for all.
        one = order[heads]
        by = one[np.lexsort((start[one], doc[one]))]
        r, w = _repeated(doc[by], count[by], body, base[by])
        stands = np.full(len(doc), -1, np.int64)
        stands[order] = one[group]
        spans = [np.stack([again, start[again], start[again] + count[again] + LENGTH - 1], 1)]
        if len(r):
            o = np.lexsort((w, r))
            r, w = by[r[o]], w[o]
            new = np.r_[True, (r[1:] != r[:-1]) | (w[1:] != w[:-1] + 1)]
            a = np.flatnonzero(new)
            b = np.r_[a[1:], len(r)] - 1
            run, low, high = r[a], w[a], w[b] + LENGTH
            # spans of each scanned run, given to every run that it stands for
            first = np.searchsorted(run[np.argsort(run, kind="stable")], np.arange(len(doc)))
            last = np.searchsorted(run[np.argsort(run, kind="stable")], np.arange(len(doc)), "right")
            sort = np.argsort(run, kind="stable")
            n = (last - first)[stands[rest]]
            who = np.repeat(rest, n)
            k = sort[np.repeat(first[stands[rest]], n) + np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)]
            spans.append(np.stack([who, start[who] + low[k], start[who] + high[k]], 1))
        s = np.concatenate(spans)
        _spans_out(out, doc[s[:, 0]], th[s[:, 0]], s[:, 1], s[:, 2])
    pa.default_memory_pool().release_unused()
    return pa.concat_tables([ready, pa.Table.from_batches([_batch(out)])])


def _digests(body: np.ndarray, base: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Hashes of the runs' bytes, in pieces that bound the memory."""
    out, i = np.empty(len(base), np.uint64), 0
    order = np.argsort(base)
    ends = (base + count + LENGTH - 1)[order]
    while i < len(order):
        a = base[order[i]]
        j = max(i + 1, int(np.searchsorted(ends, a + (2 << 20), "right")))
        p = order[i:j]
        out[p] = span_hashes(body[a : ends[j - 1]], base[p] - a, base[p] + count[p] + LENGTH - 1 - a)
        i = j
    return out


def _squeezed(batches):
    """Texts as they cross the last shuffle."""
    squeeze = zstandard.ZstdCompressor(level=SQUEEZE)
    for batch in batches:
        texts = [squeeze.compress(t.as_buffer() or b"") for t in batch.column(2).cast(pa.large_binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], names=["doc_id", "text_hash", "text"])


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _remove(batches):
    """(doc_id, squeezed text, spans) to what is left of each text."""
    squeeze = zstandard.ZstdDecompressor()
    for batch in batches:
        ids, spans = batch.column(0), batch.column(2)
        rows = []
        for i in range(batch.num_rows):
            text = squeeze.decompress(batch.column(1)[i].as_py())
            lists = spans[i].as_py() or []
            pairs = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 2) for x in lists]) if lists else np.zeros((0, 2), np.int64)
            pairs = _merged(pairs[np.argsort(pairs[:, 0], kind="stable")])
            kept = b"".join(text[a:b] for a, b in zip(np.r_[0, pairs[:, 1]], np.r_[pairs[:, 0], len(text)], strict=True))
            rows.append((len(text), len(text) - len(kept), len(pairs), kept))
        yield pa.RecordBatch.from_arrays(
            [ids.cast(pa.int64()), *[pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))]],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def _slices(stride: int):
    """Slices of the texts, one every ``stride`` bytes."""

    def run(batches):
        for batch in batches:
            for i, _, data, offsets in text_chunks(batch.column(2), MAP_BYTES):
                out = []
                for p in range(batch.column(1)[i].as_py() % stride, len(data), stride):
                    a, b = np.searchsorted(offsets, [p, p + SLICE])
                    cuts = np.r_[p, offsets[a:b], min(p + SLICE, len(data))]
                    out += [data[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True) if y - x >= LENGTH]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["text"])

    return run


def _gram_counts(batches):
    """Sampled texts to (slot, n): how often grams of a slot of the sketch occur."""
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column(0)):
            if len(data) >= GRAM:
                at = np.arange(len(data) - GRAM + 1)
                at = at[at + GRAM <= offsets[np.searchsorted(offsets, at, "right")]]
                counts += np.bincount((window_hashes(data, GRAM)[at] >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
    slot = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(counts[slot])], names=["slot", "n"])


def _owner_sizes(levels):
    """Sampled texts to (owner, size, windows) of their runs."""

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                _, _, count, owner = runs(data, offsets, levels.value)
                owner, at = np.unique(owner, return_inverse=True)
                size = np.bincount(at, count + LENGTH - 1, len(owner)).astype(np.int64)
                windows = np.bincount(at, count, len(owner)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(owner.view(np.int64)), pa.array(size), pa.array(windows)], names=["owner", "size", "windows"])

    return run


def _measured(d: DataFrame, size: int):
    """(levels of the sketch, owners to split, number of their windows) by a sample of the texts."""
    context = d.sparkSession.sparkContext
    stride = max(SLICE, SLICE * size // max(SAMPLE_BYTES, size // SAMPLE_PART))
    sample = stored(d.mapInArrow(_slices(stride), "text binary"), "repeats-sample")
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    counts = sample.mapInArrow(_gram_counts, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    # A run holds less than 2 * LENGTH bytes an occurrence: up to this limit a gram can't be heavy.  Rare ones keep the
    # order by hash alone, which makes the fewest runs.
    limit = HEAVY_BYTES / (2 * LENGTH) * (SLICE / stride)
    many = np.maximum(counts["n"].to_numpy() / limit, 1)
    levels[counts["slot"].to_numpy()] = np.ceil(4 * np.log2(many))
    sizes = sample.mapInArrow(_owner_sizes(context.broadcast(levels)), "owner long, size long, windows long")
    sizes = sizes.groupBy("owner").agg(F.sum("size").alias("size"), F.sum("windows").alias("windows"))
    heavy = sizes.filter(F.col("size") * (stride / SLICE) > HEAVY_BYTES).toArrow()
    return levels, np.sort(heavy["owner"].to_numpy().view(np.uint64)), int(heavy["windows"].to_numpy().sum() * stride // SLICE)


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): the bytes left of every row's text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A byte lies in about LENGTH / run + 1 runs.
    shards, splits, order = max(1, -(-4 * size // SHARD_BYTES)), 1, None
    if 4 * size > HEAVY_BYTES:
        levels, heavy, windows = _measured(d, size)
        splits = max(1, -(-windows * 96 // SPLIT_BYTES))
        order = d.sparkSession.sparkContext.broadcast((levels, heavy))
    found = d.mapInArrow(_cut(shards, splits, order), MAPPED).groupBy("shard").applyInArrow(_scan_of(shards), "doc long, text_hash long, spans binary")
    spans = found.groupBy("doc", "text_hash").agg(F.collect_list("spans").alias("spans"))
    small = d.mapInArrow(_squeezed, "doc_id long, text_hash long, text binary")
    keyed = small.withColumn("doc", F.coalesce("doc_id", F.lit(LAST)))
    joined = keyed.join(spans.hint("merge"), ["doc", "text_hash"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_remove, KEPT)


def op5_repeated_spans(spark, sf_dir):
    out = without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

