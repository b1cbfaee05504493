"""Operator 1: lexical retrieval packing.

Documents become token ids (a public tokenizer, then ``END``).  Whole windows of a long
document are sequences of their own; the rest of every document (under a window) goes to
the shards, laid out by min-hashes of its tokens so that documents with like vocabularies lie
in one shard.  A shard builds a BM25 inverted index over its documents, with document
frequencies counted over all documents.  Its windows are filled greedily: a seed's heaviest
terms retrieve unused neighbours, best first; the one that no longer fits is cut, and what
is left of it is the next seed.  Only the end of a shard has no neighbours left: it is
written as sequences whose lengths are powers of two, so nothing is padded.

Defined cases: a null or empty text is the single id ``END``; null and repeated ids are kept
(pieces are by row); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.llm.common import mix64, table, worker_cache
from forgelake.session import scratch_path

WINDOW = 4096
END = 2
VOCABULARY = 1 << 16
#: Fixed value: the tokenizer's own cut of a word, for lower-case ASCII.
ASCII_PARTS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
SHARD_TOKENS = 1 << 20
QUERY_TERMS = 24
K1, B = 1.2, 0.75
#: Words kept in a worker's token cache.
CACHED = 1_000_000
SHARED_SEQUENCE = 1 << 62


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for 256, 257, ..."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words(dict):
    """Token ids (little-endian 16-bit) of words: no token of this tokenizer spans white space."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(file)
        self.model = self.whole.model.tokenize
        self.letters = {b: c for b, c in _byte_letters().items() if chr(b) != c or b > 126}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > CACHED:
            self.clear()
        core = word.rstrip(b".,")
        if core.isalpha() and core.isascii():  # letters alone, then stops and commas: two parts at most
            out = self._part(core) + self._part(word[len(core) :]) if len(core) < len(word) else self._model(word.decode())
        elif word.isascii():
            out = b"".join(map(self._part, ASCII_PARTS.findall(word)))
        else:
            out = self._encode(word)
        self[word] = out
        return out

    def _part(self, part: bytes) -> bytes:
        """Token ids of one part of a word, which the tokenizer never joins with its neighbours."""
        out = self.get(part)
        if out is None:
            out = self[part] = self._model(part.decode()) if part.isalnum() else self._whole(part.decode())
        return out

    def _model(self, letters: str) -> bytes:
        return array("H", [t.id for t in self.model(letters)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return array("H", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _encode(self, word: bytes) -> bytes:
        core = word.rstrip(b".,")
        text = core.decode("utf-8", "replace")
        low = text.lower()
        # Letters whose lower case and composition are beyond doubt go to the model at once.
        if low.isalpha() and max(low) < "\u0530" and "\u03a3" not in text and "\u0130" not in text and unicodedata.is_normalized("NFC", text):
            out = self.get(low.encode())
            if out is None:
                out = self._model(low.encode().decode("latin-1").translate(self.letters))
            return out + self._part(word[len(core) :]) if len(core) < len(word) else out
        return self._whole(word.decode("utf-8", "replace"))

    def ids(self, text: bytes) -> np.ndarray:
        if b"<|" in text:  # special tokens are looked for in the raw text
            ids = np.array(self.whole.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u2")
        else:
            # the look-up itself calls __missing__: one pass over the words
            ids = np.frombuffer(b"".join(map(self.__getitem__, text.lower().split())), "<u2")
        return np.append(ids, np.uint16(END))


ROWS = "kind string, piece long, doc_id long, start long, doc_tokens long, near long, near2 long, ids binary"


def _tokenize(file: str):
    """(doc_id, text) to windows, rests and the task's document frequencies."""

    def run(batches):
        cache = worker_cache()
        if file not in cache:
            cache[file] = Words(file)
        words: Words = cache[file]
        ids = np.arange(VOCABULARY, dtype=np.uint64)
        hashes = np.stack([(mix64(ids + np.uint64(s << 32)) >> np.uint64(1)).astype(np.int64) for s in (1, 2)], 1)
        part = TaskContext.get().partitionId()
        piece = part << 40
        frequency = np.zeros(VOCABULARY, np.uint32)
        held = np.zeros(VOCABULARY, bool)
        for batch in batches:
            out = [[] for _ in range(8)]
            size = 0
            texts = batch.column(1).cast(pa.large_binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                ids = words.ids(text.as_py() or b"")
                held[ids] = True
                terms = np.flatnonzero(held)  # a mark an id of the vocabulary: no sorting
                held[terms] = False
                frequency[terms] += 1
                whole = len(ids) // WINDOW * WINDOW
                for start in [*range(0, whole, WINDOW), *([whole] if whole < len(ids) else [])]:
                    chunk = ids[start : start + WINDOW]
                    full = len(chunk) == WINDOW
                    near = (0, 0)
                    if not full:
                        h = hashes[terms if not start else np.unique(chunk)]
                        near = (int(h[:, 0].min()), int(h[:, 1].min()))
                    for column, value in zip(out, ("window" if full else "rest", piece, doc_id, start, len(ids), *near, chunk.tobytes()), strict=True):
                        column.append(value)
                    piece += 1
                    size += len(chunk)
                if size > 1 << 21:
                    yield _rows(out)
                    out, size = [[] for _ in range(8)], 0
            yield _rows(out)
        yield _rows([["terms"], [part], [None], [0], [0], [0], [0], [frequency.tobytes()]] if frequency.any() else [[] for _ in range(8)])

    return run


def _rows(out: list[list]) -> pa.RecordBatch:
    kinds = [pa.string(), *[pa.int64()] * 6, pa.binary()]
    names = [c.split()[0] for c in ROWS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=names)


def _sum_terms(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.uint32).astype(np.int64) for x in pdf["ids"])
    return pd.DataFrame({"counts": [total.tobytes()]})


class Index:
    """BM25 inverted index of one shard; documents are token arrays."""

    def __init__(self, docs: list[np.ndarray], weight: np.ndarray, mean: float):
        lengths = np.array([len(d) for d in docs])
        doc = np.repeat(np.arange(len(docs)), lengths)
        pairs, tf = np.unique((doc.astype(np.int64) << 16) | np.concatenate(docs), return_counts=True)
        self.doc, self.term = pairs >> 16, pairs & 0xFFFF
        self.value = weight[self.term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[self.doc] / mean))
        self.edge = np.searchsorted(self.doc, np.arange(len(docs) + 1))
        order = np.argsort(self.term, kind="stable")
        self.post_doc, self.post_value = self.doc[order], self.value[order]
        self.lists = np.searchsorted(self.term[order], np.arange(VOCABULARY + 1))
        self.n = len(docs)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share one of the seed's heaviest terms, best score first."""
        a, b = self.edge[seed], self.edge[seed + 1]
        terms = self.term[a:b]
        if len(terms) > QUERY_TERMS:
            terms = terms[np.argpartition(-self.value[a:b], QUERY_TERMS)[:QUERY_TERMS]]
        spans = [slice(self.lists[t], self.lists[t + 1]) for t in terms]
        score = np.bincount(
            np.concatenate([self.post_doc[s] for s in spans]), np.concatenate([self.post_value[s] for s in spans]), minlength=self.n
        )
        score[~unused] = 0
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


class Filler:
    """Greedy windows over the shards of a task; what is open at the end of one shard goes on in the next."""

    def __init__(self, weight: np.ndarray, mean: float, first: int):
        self.weight, self.mean, self.sequence = weight, mean, first
        self.open: list[tuple] = []
        self.room = WINDOW
        self.out: list[tuple] = []

    def _put(self, row: tuple, a: int, b: int) -> None:
        """Tokens a..b of a rest (doc_id, start, doc_tokens, ids)."""
        self.open.append((row[0], row[1] + a, row[2], row[3][a:b]))
        self.room -= b - a
        if not self.room:
            self.close(self.open)
            self.open, self.room = [], WINDOW

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, tokens, ids in pieces:
            self.out.append((doc_id, start, len(ids), tokens, self.sequence, offset, ids.astype("<u4").tobytes()))
            offset += len(ids)
        self.sequence += 1

    def fill(self, rows: list[tuple]) -> None:
        index = Index([r[3] for r in rows], self.weight, self.mean)
        unused = np.ones(len(rows), bool)
        next_seed, near = 0, None
        while True:
            if near is None:  # a new seed: the next unused document in order
                while next_seed < len(rows) and not unused[next_seed]:
                    next_seed += 1
                if next_seed == len(rows):
                    return
                seed = next_seed
                near = iter([seed, *index.neighbours(seed, unused)])
            for d in near:
                if not unused[d]:
                    continue
                unused[d] = False
                fits = min(self.room, len(rows[d][3]))
                self._put(rows[d], 0, fits)
                if fits < len(rows[d][3]):  # cut: the remainder opens the next window and is its seed
                    self._put(rows[d], fits, len(rows[d][3]))
                    near = iter(index.neighbours(d, unused))
                    break
                if self.room == WINDOW:
                    near = None
                    break
            else:
                near = None

    def finish(self) -> None:
        """The open end as sequences of power-of-two lengths."""
        left = WINDOW - self.room
        pieces, size = self.open, 1 << max(0, left.bit_length() - 1)
        while left:
            taken, need = [], size
            while need:
                doc_id, start, tokens, ids = pieces.pop(0)
                taken.append((doc_id, start, tokens, ids[:need]))
                if len(ids) > need:
                    pieces.insert(0, (doc_id, start + need, tokens, ids[need:]))
                need -= len(taken[-1][3])
            self.close(taken)
            left -= size
            size = 1 << max(0, left.bit_length() - 1)
        self.open, self.room = [], WINDOW


PACKED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [*[pa.int64()] * 6, pa.binary()]
    names = [c.split()[0] for c in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _pack(shared, file: str):
    """Rests (doc_id, start, doc_tokens, ids), in shard order, to pieces."""

    def run(batches):
        worker_cache().pop(file, None)  # no text is tokenized any more: the worker goes on without the words
        weight, mean = shared.value
        filler = Filler(weight, mean, SHARED_SEQUENCE | TaskContext.get().partitionId() << 32)
        rows, size = [], 0
        for batch in batches:
            ids = batch.column(3)
            for i, (doc_id, start, tokens) in enumerate(zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True)):
                rows.append((doc_id, start, tokens, np.frombuffer(ids[i].as_py(), "<u2")))
                size += len(rows[-1][3])
                if size >= SHARD_TOKENS:
                    filler.fill(rows)
                    yield _packed(filler.out)
                    filler.out, rows, size = [], [], 0
        if rows:
            filler.fill(rows)
        filler.finish()
        yield _packed(filler.out)

    return run


def _windows(file: str):
    """Whole windows (piece, doc_id, start, doc_tokens, ids) as sequences."""

    def run(batches):
        worker_cache().pop(file, None)  # as in _pack
        for batch in batches:
            piece, doc_id, start, tokens = (batch.column(k).to_pylist() for k in range(4))
            ids = [np.frombuffer(x.as_py(), "<u2").astype("<u4").tobytes() for x in batch.column(4)]
            yield _packed([(d, s, len(x) // 4, t, p, 0, x) for p, d, s, t, x in zip(piece, doc_id, start, tokens, ids, strict=True)])

    return run


def pack(docs: DataFrame, file: str | None = None) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids): ids are little-endian unsigned 32-bit."""
    spark = docs.sparkSession
    file = file or tokenizer_file()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    path = scratch_path(spark, "packing-tokens")
    texts.mapInArrow(_tokenize(file), ROWS).write.option("compression", "zstd").parquet(path)
    tokens = spark.read.schema(ROWS).parquet(path)
    terms = tokens.filter("kind = 'terms'").select((F.col("piece") % 64).alias("group"), "ids")
    counts = np.zeros(VOCABULARY, np.int64)
    for row in terms.groupBy("group").applyInPandas(_sum_terms, "counts binary").collect():  # at most 64 rows of the vocabulary's size
        counts += np.frombuffer(row["counts"], np.int64)
    sizes = tokens.filter("kind <> 'terms'").agg(
        F.count(F.when(F.col("start") == 0, 1)).alias("docs"),
        F.count(F.when(F.col("kind") == "rest", 1)).alias("rests"),
        F.sum(F.when(F.col("kind") == "rest", F.col("doc_tokens") - F.col("start"))).alias("rest_tokens"),
    ).first()
    weight = np.log(1 + (sizes["docs"] - counts + 0.5) / (counts + 0.5))
    mean = max(1.0, (sizes["rest_tokens"] or 0) / max(1, sizes["rests"]))
    shared = spark.sparkContext.broadcast((weight, mean))  # one number per id of the vocabulary
    shards = max(1, -(-(sizes["rest_tokens"] or 0) // SHARD_TOKENS))
    rests = tokens.filter("kind = 'rest'").repartitionByRange(shards, "near", "near2", "piece").sortWithinPartitions("near", "near2", "piece")
    packed = rests.select("doc_id", "start", "doc_tokens", "ids").mapInArrow(_pack(shared, file), PACKED)
    whole = tokens.filter("kind = 'window'").select("piece", "doc_id", "start", "doc_tokens", "ids").mapInArrow(_windows(file), PACKED)
    return whole.unionByName(packed)


def digested(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op1_packing(spark, sf_dir):
    return digested(pack(table(spark, sf_dir, "documents")))
