"""Helpers shared by the operators: scratch tables, folds, Arrow text buffers, shingle hashes, components."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.session import scratch_path

#: A word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes handled at once by the vectorised kernels (a longer text is handled alone).
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` once under spark.checkpoint.dir and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free(name: str, *frames: DataFrame) -> str:
    """``name``, with as many underscores after it as no column of the frames has (case aside)."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(key: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % mod


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker (functions travel by value, so module globals don't)."""
    name = "_worker_cache_of_llm_operators"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].data = {}
    return sys.modules[name].data


# --- Arrow text ---------------------------------------------------------------------------


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (null: empty) and its row offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    arr = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    if arr.null_count:
        arr = pc.fill_null(arr, b"")
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    data = np.frombuffer(arr.buffers()[2], np.uint8) if arr.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


def text_chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of a string column in pieces of about ``size`` bytes."""
    data, offsets = text_bytes(column)
    for i, j in row_chunks(offsets, size):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (fixed constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    cache = worker_cache()
    if len(cache.get("powers", ((),))[0]) < n:
        base = 0x9E3779B97F4A7C15
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        cache["powers"] = tuple(out)
    up, down = cache["powers"]
    return up[:n], down[:n]


#: Longest span that is hashed in one piece: below it no two texts are known that share a hash whatever the base is.
PIECE = 256


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end) for each span, the same wherever the span lies.

    A polynomial modulo 2**64; some texts of a thousand letters and more (the Thue-Morse sequence and its
    complement) collide under any such, so a long span is the sum of its pieces' hashes, each mixed with its number.
    """
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])

    def piece(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix64((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    out = piece(starts, ends)
    long = np.flatnonzero(ends - starts > PIECE)
    if len(long):
        many = -(-(ends[long] - starts[long]) // PIECE)
        first = np.cumsum(many) - many
        nth = np.arange(int(many.sum())) - np.repeat(first, many)
        a = np.repeat(starts[long], many) + nth * PIECE
        h = piece(a, np.minimum(a + PIECE, np.repeat(ends[long], many)))
        h = mix64(h + nth.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        out[long] = mix64(np.add.reduceat(h, first) + (ends - starts)[long].astype(np.uint64))
    return out


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """``span_hashes`` of every window of ``size`` bytes (PIECE at most), without a place array and in few buffers."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    each = data.astype(np.uint64)
    each += np.uint64(1)
    each *= up[:-1]
    np.cumsum(each, out=total[1:])
    h = total[size:] - total[:n]
    h *= down[:n]
    h += np.uint64(size * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
    shifted = each[:n]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):  # as mix64
        np.right_shift(h, np.uint64(shift), out=shifted)
        h ^= shifted
        if factor != 1:
            h *= np.uint64(factor)
    return h


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each row): words never cross rows."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    ink = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(ink & (first[:-1] | np.r_[True, ~ink[:-1]]))
    ends = np.flatnonzero(ink & (first[1:] | np.r_[~ink[1:], True])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its k-word shingles (fewer words: the whole sequence; none: empty)."""
    low = lower_ascii(data)
    starts, ends, rows = word_spans(low, offsets)
    h = span_hashes(low, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    out = []
    long = np.zeros(0, np.uint64)
    if len(h) >= k:
        long = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            long = long * np.uint64(0x9FB21C651E98DF25) + h[i : i + len(long)]
        long = mix64(long)
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(long[a : b - k + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for x in h[a:b]:
                whole = mix64(np.array([whole], np.uint64))[0] ^ x
            out.append(mix64(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


# --- connected components ------------------------------------------------------------------


def _neighbours_min(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reachable.

    Alternating large-star and small-star steps: minima are aggregated map-side and
    joined back, so a hub is never gathered in one task.  Each round is stored.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = stored(e, "cc")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: every larger neighbour of u points to the smallest node around u
        large = (
            both.join(_neighbours_min(both), "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        # small star: u and its smaller neighbours point to the smallest of them
        least = _neighbours_min(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        e = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
