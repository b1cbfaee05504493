"""Operator 12: SentencePiece encoding that keeps the source span of every piece, and decoding.

The model file is read here (protocol buffer fields; its compiled character map is a double-array
trie with a pool of replacements), the driver reads it once and tasks get its bytes.  A text is
normalised by longest prefix: where a key of the map starts, the longest one is replaced, any
other character stays, and a byte that is no UTF-8 becomes U+FFFD.  Each normalised byte keeps
the place of the source it comes from, so a piece's bounds project to bytes of the original text.

Byte pair merges then run by score, leftmost first among equals.  No merge can cross a place
where no piece of the vocabulary holds the two characters side by side, so a text is cut before
its spaces and around characters that no longer piece holds, and the parts are merged once
and remembered (``CACHED``).  Characters without a piece become byte pieces, the last of which has
the character's span.  Spans are half open and in UTF-8 bytes; begin and end ids have empty ones.

Handles BPE models with byte fallback and white space escaped as a prefix; others (unigram,
user-defined pieces, ...) raise ValueError on the driver.

Defined cases: a null or empty text has no pieces (begin and end ids only, decoded ''); a very long word is
merged by a heap; rows are independent, so null or repeated ids, repeated rows and other columns
do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from forgelake.llm.common import row_chunks, table, text_bytes, worker_cache

#: Text parts whose pieces a worker remembers.
CACHED = 500_000
#: From so many characters on, merges use a heap.
LONG_PART = 200
SPACE, BAD = "▁", "\ufffd"
#: Kinds of pieces and fields of the model file (fixed values of its public format).
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE_MODEL = 2

ENCODED = "struct<ids:array<int>,starts:array<int>,ends:array<int>>"
DIGESTS = "struct<n_tokens:long,ids_sha256:string,decoded_sha256:string,spans_sha256:string>"


def model_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes):
    """(number, value) of a protocol buffer message: integers, 4- or 8-byte strings, or byte strings."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


def _one_bad_byte_each(error):
    """Every byte that is no UTF-8 is one U+FFFD."""
    return BAD * (error.end - error.start), error.end


class CharacterMap:
    """Longest-prefix rewriting by a compiled map: a double-array trie whose leaves point into a pool of replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.pool = blob[4 + size :]
        self.found: dict[bytes, bytes] = {}
        starts = np.zeros(256, bool)
        for b in range(256) if self.units else ():
            starts[b] = self._child(self._offset(self.units[0]), b) is not None
        #: Bytes that some key starts with.
        self.starts = starts

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def _child(self, node: int, byte: int) -> int | None:
        place = node ^ byte
        if place < len(self.units) and self.units[place] & (1 << 31 | 255) == byte:
            return place
        return None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """(bytes matched, replacement) of the longest key at a place; (0, b'') without one."""
        node, best, value = self._offset(self.units[0]), 0, 0
        for i in range(at, len(data)):
            place = self._child(node, data[i])
            if place is None:
                break
            unit = self.units[place]
            node = place ^ self._offset(unit)
            if unit >> 8 & 1:
                best, value = i + 1 - at, self.units[node] & 0x7FFFFFFF
        return best, self.pool[value : self.pool.index(b"\0", value)] if best else b""


class Normalised(NamedTuple):
    """A normalised text, its spaces unescaped, and the source place of each of its bytes and of its end (None: one byte
    of prefix, then the source as it is)."""

    text: str
    source: np.ndarray | None


class Normaliser:
    """Longest-prefix normalisation with source alignment."""

    def __init__(self, spec: dict):
        codecs.register_error("piece-bytes", _one_bad_byte_each)  # here, as tasks build their own
        self.map = CharacterMap(spec.get(2, b""))
        self.prefix, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if not spec.get(5, 1):
            raise ValueError("white space must be escaped")
        self.plain = not self.map.units and self.prefix and not self.squeeze

    def __call__(self, data: bytes) -> Normalised:
        if not data:
            return Normalised("", np.zeros(1, np.int64))
        if self.plain and SPACE.encode() not in data:
            try:
                return Normalised(" " + data.decode(), None)
            except UnicodeDecodeError:
                pass
        out, source = self._spaced(data, *self._rewritten(data))
        out, source = _unescaped(out, source)
        return Normalised(out.tobytes().decode(), source)

    def _rewritten(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Bytes after the map and their source places, with the source's length at the end."""
        raw = np.frombuffer(data, np.uint8)
        places = np.flatnonzero(self.map.starts[raw] & ((raw & 0xC0) != 0x80)) if self.map.units else np.zeros(0, np.int64)
        parts, origin, last = [], [], 0

        def keep(end: int) -> None:
            kept, at = _as_it_is(data[last:end])
            parts.append(kept)
            origin.append(at + last)

        for at in places.tolist():
            if at >= last:
                size, new = self.map.longest(data, at)
                if size:
                    keep(at)
                    parts.append(new)
                    origin.append(np.full(len(new), at, np.int64))
                    last = at + size
        keep(len(data))
        return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([*origin, [len(data)]]).astype(np.int64)

    def _spaced(self, data: bytes, out: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Extra spaces out, the prefix in front."""
        first = 0
        if self.squeeze:
            while first < len(data):  # leading spaces, also those that the map makes
                size, new = self.map.longest(data, first) if self.map.units else (0, b"")
                if (new if size else data[first : first + 1]) != b" ":
                    break
                first += size or 1
            if first == len(data):
                return out[:0], np.zeros(1, np.int64)
            blank = out == 32
            keep = ~(blank & np.r_[True, blank[:-1]])
            out, source = out[keep], np.r_[source[:-1][keep], source[-1]]
        if self.prefix:
            out, source = np.r_[np.uint8(32), out], np.r_[first, source]
        if self.squeeze:
            size = len(out)
            while size and (out[size - 1] == 32 or out[max(0, size - 3) : size].tobytes() == SPACE.encode()):
                size -= 1 if out[size - 1] == 32 else 3
            out, source = out[:size], source[: size + 1] if size else np.zeros(1, np.int64)
        return out, source


def _as_it_is(data: bytes) -> tuple[bytes, np.ndarray]:
    """Source bytes that no key rewrites, bad bytes replaced; every byte of a character has its first byte's place."""
    try:
        data.decode()
    except UnicodeDecodeError:
        good, size, at = data.decode("utf-8", "piece-bytes"), [], 0
        for c in good:  # a replaced byte is one byte of the source, a U+FFFD that was there three
            size.append(1 if c == BAD and data[at : at + 3] != BAD.encode() else len(c.encode()))
            at += size[-1]
        starts = np.cumsum([0, *size[:-1]])
        return good.encode(), np.repeat(starts, [len(c.encode()) for c in good])
    raw = np.frombuffer(data, np.uint8)
    return data, np.maximum.accumulate(np.where((raw & 0xC0) != 0x80, np.arange(len(raw)), 0))


def _unescaped(out: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Escaped spaces as spaces of one byte."""
    a, b, c = SPACE.encode()
    at = np.flatnonzero((out[:-2] == a) & (out[1:-1] == b) & (out[2:] == c))
    if not len(at):
        return out, source
    out = out.copy()
    out[at] = 32
    gone = np.r_[at + 1, at + 2]
    return np.delete(out, gone), np.delete(source, gone)


class Encoding(NamedTuple):
    """Pieces of several texts laid end to end: ids, spans in source bytes, and where each text's pieces start."""

    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    edges: np.ndarray


class Model:
    """A BPE model with byte fallback."""

    def __init__(self, blob: bytes):
        pieces, trainer, spec = [], {}, {}
        for number, value in _fields(blob):
            if number == 1:
                f = dict(_fields(value))
                pieces.append((f[1].decode(), float(np.frombuffer(f.get(2, b"\0" * 4), "<f4")[0]), f.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                spec = dict(_fields(value))
        kinds = {k for _, _, k in pieces}
        if trainer.get(3) != BPE_MODEL or not trainer.get(35) or trainer.get(24) or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models with byte fallback, without user-defined pieces or white space suffixes")
        self.normaliser = Normaliser(spec)
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        normal = {p.replace(SPACE, " "): (i, s) for i, (p, s, k) in enumerate(pieces) if k == NORMAL}
        order = {s: r for r, s in enumerate(sorted({s for _, s in normal.values()}, reverse=True))}
        #: Place of a piece in the order of merges.
        self.rank = {p: order[s] for p, (_, s) in normal.items()}
        self.never = len(order)
        bytes_of = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.byte_ids = [bytes_of[b] for b in range(256)]
        #: (id, bytes) of every piece, packed.
        self.packed = {p: np.array([i, len(p.encode())], "<i4").tobytes() for p, (i, _) in normal.items()}
        surface = trainer.get(44, b" \xe2\x81\x87 ")
        self.decoded = [surface if k == UNKNOWN else b"" if k == CONTROL else p.replace(SPACE, " ").encode() for p, _, k in pieces]
        for b, i in bytes_of.items():
            self.decoded[i] = bytes([b])
        self.kinds = [k for _, _, k in pieces]
        self.controls = {i for i, k in enumerate(self.kinds) if k == CONTROL}
        self.parts: dict[str, bytes] = {}
        self.split = self._splitter([p for p in normal if len(p) > 1])

    @staticmethod
    def _splitter(longer: list[str]):
        """Cuts a text where no merge can reach across."""
        if any(" " in p.lstrip(" ") for p in longer):
            return lambda text: [text] if text else []  # some piece goes on after a space: no cut is safe
        joining = set().union(*map(set, longer))
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joining and chr(c) != " ")
        return re.compile(f" *[^ {alone}]+| +|[{alone}]+" if alone else " *[^ ]+| +").findall

    def _merged(self, part: str) -> list[str]:
        """The symbols of a part after all merges."""
        rank, never = self.rank.get, self.never
        s = list(part)
        if len(s) > LONG_PART:
            return self._merged_by_heap(s)
        best = [rank(a + b, never) for a, b in zip(s, s[1:], strict=False)]
        while best:
            least = min(best)
            if least == never:
                break
            i = best.index(least)
            s[i : i + 2] = [s[i] + s[i + 1]]
            del best[i]
            if i:
                best[i - 1] = rank(s[i - 1] + s[i], never)
            if i < len(best):
                best[i] = rank(s[i] + s[i + 1], never)
        return s

    def _merged_by_heap(self, s: list[str]) -> list[str]:
        """The same for long parts: candidates by rank, then place; one whose symbols have changed is passed over."""
        rank, n = self.rank, len(s)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(rank[p], i, len(p)) for i, p in ((i, s[i] + s[i + 1]) for i in range(n - 1)) if p in rank]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = right[i]
            if not s[i] or j >= n or len(s[i]) + len(s[j]) != size:
                continue
            s[i], s[j] = s[i] + s[j], ""
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < n and (p := s[a] + s[b]) in rank:
                    heapq.heappush(heap, (rank[p], a, len(p)))
        return [p for p in s if p]

    def _part(self, part: str) -> bytes:
        """Packed (id, bytes) of a part's pieces."""
        out = []
        for p in self._merged(part):
            known = self.packed.get(p)
            if known is None:
                raw = p.encode()
                known = np.array([[self.byte_ids[b], 0] for b in raw[:-1]] + [[self.byte_ids[raw[-1]], len(raw)]], "<i4").tobytes()
            out.append(known)
        return b"".join(out)

    def _packed(self, text: str) -> bytes:
        known, out = self.parts, []
        for part in self.split(text):
            got = known.get(part)
            if got is None:
                got = self._part(part)
                if len(part) <= LONG_PART:
                    if len(known) >= CACHED:
                        known.clear()
                    known[part] = got
            out.append(got)
        return b"".join(out)

    def encode(self, texts: list[bytes], ends: bool = False) -> Encoding:
        """Pieces of each text with their spans; with begin and end ids where ``ends``."""
        normal = [self.normaliser(t) for t in texts]
        packed = [self._packed(n.text) for n in normal]
        many = np.array([len(p) // 8 for p in packed], np.int64)
        flat = np.frombuffer(b"".join(packed), "<i4").reshape(-1, 2)
        ids, size = flat[:, 0].astype(np.int32), flat[:, 1].astype(np.int64)
        edges = np.r_[0, np.cumsum(many)]
        stop = np.cumsum(size)
        base = np.r_[0, stop][edges[:-1]]
        stop -= np.repeat(base, many)
        start = stop - size
        a, b = np.maximum(start - 1, 0), np.maximum(stop - 1, 0)
        for k, n in enumerate(normal):
            if n.source is not None:
                at = slice(edges[k], edges[k + 1])
                a[at], b[at] = n.source[start[at]], n.source[stop[at]]
        if ends:
            length = np.array([len(t) for t in texts], np.int64)
            where, zero = np.r_[edges[:-1], edges[1:]], np.zeros(len(texts), np.int64)
            order = np.argsort(np.r_[np.arange(len(texts)) * 2, np.arange(len(texts)) * 2 + 1])  # begin, end, begin, ...
            ids = np.insert(ids, where[order], np.tile(np.array([self.begin, self.end], np.int32), len(texts)))
            bounds = np.r_[zero, length][order]
            a, b = np.insert(a, where[order], bounds), np.insert(b, where[order], bounds)
            edges = edges + 2 * np.arange(len(texts) + 1)
        return Encoding(ids, a.astype(np.int32), b.astype(np.int32), edges)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: no control pieces, the prefix's space taken off, bytes joined to characters."""
        n, head, k = len(ids), [], 0
        while k < n and (self.normaliser.prefix or self.normaliser.squeeze):
            kind = self.kinds[ids[k]]
            if kind not in (CONTROL, NORMAL):
                break
            piece = self.decoded[ids[k]].removeprefix(b" ")
            head.append(piece)
            k += 1
            if kind == NORMAL and (piece or not self.normaliser.squeeze):
                break
        out = []
        for part in self._between_controls(ids[k:]):
            out.append(b"".join(head + [self.decoded[i] for i in part]).decode("utf-8", "piece-bytes"))
            head = []
        return "".join(out)

    def _between_controls(self, ids: list[int]) -> list[list[int]]:
        """Ids cut at control pieces: bytes on either side of one make no character together."""
        cuts = [i for i, x in enumerate(ids) if x in self.controls]
        return [ids[a:b] for a, b in zip([0, *(c + 1 for c in cuts)], [*cuts, len(ids)], strict=True)]


def shared_model(spark: SparkSession, file: str | None = None) -> Broadcast:
    """The model file's bytes for tasks, checked on the driver."""
    with open(file or model_file(), "rb") as f:
        blob = f.read()
    Model(blob)
    return spark.sparkContext.broadcast(blob)  # one file, whatever the input


def _model(shared: Broadcast) -> Model:
    """One model a worker, so its parts stay remembered between batches."""
    cache, blob = worker_cache(), shared.value
    key = ("pieces", hashlib.sha256(blob).digest())
    if key not in cache:
        cache[key] = Model(blob)
    return cache[key]


def encoded(text: Column, shared: Broadcast, ends: bool = False) -> Column:
    """``ids`` of a text's pieces and their ``starts`` and ``ends`` in its UTF-8 bytes."""

    @arrow_udf(ENCODED)
    def encode(texts: pa.Array) -> pa.Array:
        model = _model(shared)
        data, offsets = text_bytes(texts)
        done = [
            model.encode([data[a:b].tobytes() for a, b in zip(offsets[i:j], offsets[i + 1 : j + 1], strict=True)], ends)
            for i, j in row_chunks(offsets)
        ]
        many = np.concatenate([np.diff(e.edges) for e in done]) if done else np.zeros(0, np.int64)
        edges = pa.array(np.r_[0, np.cumsum(many)], pa.int32())
        columns = [
            pa.ListArray.from_arrays(edges, pa.array(np.concatenate([getattr(e, c) for e in done]) if done else [], pa.int32()))
            for c in ("ids", "starts", "ends")
        ]
        return pa.StructArray.from_arrays(columns, ["ids", "starts", "ends"])

    return encode(text.cast("string"))


def decoded(ids: Column, shared: Broadcast) -> Column:
    """The text of an array of ids."""

    @arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        model = _model(shared)
        return pa.array([None if r is None else model.decode(r) for r in rows.to_pylist()], pa.string())

    return decode(ids)


def digests(pieces: Column, shared: Broadcast) -> Column:
    """Number of ids, and hashes of the ids, of their decoded text and of the spans (starts, then ends), all
    as little-endian 32-bit integers or UTF-8."""

    @arrow_udf(DIGESTS)
    def digest(rows: pa.Array) -> pa.Array:
        model = _model(shared)
        lists = [rows.field(c) for c in ("ids", "starts", "ends")]
        edges = lists[0].offsets.to_numpy()
        ids, starts, ends = (x.values.to_numpy() for x in lists)
        out = [[], [], []]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            out[0].append(hashlib.sha256(ids[a:b].astype("<u4").tobytes()).hexdigest())
            out[1].append(hashlib.sha256(model.decode(ids[a:b].tolist()).encode()).hexdigest())
            out[2].append(hashlib.sha256(starts[a:b].tobytes() + ends[a:b].tobytes()).hexdigest())
        names = ["n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"]
        return pa.StructArray.from_arrays([pa.array(np.diff(edges), pa.int64()), *(pa.array(x, pa.string()) for x in out)], names)

    return digest(pieces)


def op12_piece_encoding(spark, sf_dir):
    shared = shared_model(spark)
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", digests(encoded(F.col("text"), shared, ends=True), shared).alias("d")).select("doc_id", "d.*")
