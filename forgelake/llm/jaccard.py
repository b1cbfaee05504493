"""Operator 7: n-gram Jaccard join by T-occurrence search.

A document is the set of its distinct k-word shingles; two link when they share at least
``SHARE`` of their union.  Texts with the same set are one node.  For a set of n the
inverted lists are split as in DivideSkip: partners need T = ceil(share * n) common
shingles, so at most T - 1 lists, the longest, are never merged; the n - T + 1 short ones
are (a shuffle on the shingle merges them), and each candidate's long ones are probed by
binary search.  Lists are ordered by a count sketch of all shingles, the same order for all
documents, so that frequent passages are probed, not merged; the sketch steers cost only.

Lists aren't expanded into pairs.  Round one pairs each list's first member with the others,
verifies and joins the links to components; round two takes the lists that still hold several
components and compares members of different ones, a crowded list in pieces.  A pair need only
meet in the list of its first common shingle, which stands early in the smaller set (among its
``core``), so lists without a core member, and members that no core member allows, are left out.  Candidates are
first held against the merged (short) parts of both sets, which alone prove most wrong.

Defined cases: a null or empty text, or one without words, has an empty set and links with
nothing; fewer than k words make one shingle; a null id takes part (its component is the
smallest known id reachable, null if there is none); repeated rows get one result each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.llm.common import components, free, mix64, shingle_sets, stored, table, text_chunks

WORDS = 4
#: Links need SHARE[0] * union <= SHARE[1] * intersection.
SHARE = (85, 100)
SKETCH_BITS, SLICES = 20, 64
#: Bits that name a list; shingles that share them share a list, which adds candidates and loses none.
NAME_BITS = 48
#: Members of a list that are paired row by row at most; longer lists are compared in pieces of CROWD.
FEW, CROWD = 16, 1024


def _digest(s: np.ndarray) -> int:
    """Name of a set: equal sets have equal names."""
    total = int(mix64(s + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)) + len(s) * 0xD1342543DE82EF95
    return int(mix64(np.array([total % (1 << 64)], np.uint64)).view(np.int64)[0])


def _sets(batch, k: int):
    for i, _, data, offsets in text_chunks(batch.column(1)):
        yield i, shingle_sets(data, offsets, k)


def _named(k: int):
    """(doc_id, text, text_hash) to (doc_id, text_hash, node, n) rows, and the task's counts of hashed shingles in slices."""

    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            ids = batch.column(0)
            for i, sets in _sets(batch, k):
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                if len(flat):
                    counts += np.bincount((flat >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
                n = [len(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, len(sets)).cast(pa.int64()),
                        batch.column(2).slice(i, len(sets)),
                        pa.array([_digest(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.nulls(len(sets), pa.int32()),
                        pa.nulls(len(sets), pa.int32()),
                        pa.nulls(len(sets), pa.binary()),
                    ],
                    names=["doc_id", "text_hash", "node", "n", "slice", "task", "counts"],
                )
        part = TaskContext.get().partitionId()
        blobs = [x.astype(np.uint32).tobytes() for x in np.split(counts, SLICES)] if counts.any() else []
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.nulls(len(blobs), pa.int64())] * 4,
                pa.array(range(len(blobs)), pa.int32()),
                pa.array([part % 64] * len(blobs), pa.int32()),
                pa.array(blobs, pa.binary()),
            ],
            names=["doc_id", "text_hash", "node", "n", "slice", "task", "counts"],
        )

    return run


def _add_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, np.uint32).astype(np.uint64) for c in pdf["counts"])
    capped = np.minimum(total, np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "counts": [capped.tobytes()]})


def levels(named: DataFrame) -> np.ndarray:
    """Order of magnitude of each sketch cell: 2**SKETCH_BITS bytes, whatever the input."""
    parts = named.filter("slice IS NOT NULL").select("slice", "task", "counts")
    kind = "slice int, counts binary"
    some = parts.groupBy("slice", "task").applyInPandas(_add_counts, kind)
    rows = some.groupBy("slice").applyInPandas(_add_counts, kind).collect()
    counts = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), np.uint32)
    for r in rows:
        counts[r["slice"]] = np.frombuffer(r["counts"], np.uint32)
    return np.ceil(np.log2(counts.ravel().astype(np.float64) + 1)).astype(np.uint8)


def _ordered(s: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The set's shingles as sorted numbers: rare before frequent, the same order for every set."""
    high = level[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    return np.sort((high << np.uint64(58)) | (s >> np.uint64(6)))


def _short_lists(k: int, share, shared):
    """(doc_id, text) to (node, n, short): the n - T + 1 rarest shingles, in order."""

    def run(batches):
        level = shared.value
        for batch in batches:
            for _, sets in _sets(batch, k):
                sets = [s for s in sets if len(s)]
                short = [_ordered(s, level)[: len(s) + 1 + (-share[0] * len(s) // share[1])].view(np.int64) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_digest(s) for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.ListArray.from_arrays(
                            pa.array(np.cumsum([0] + [len(x) for x in short]), pa.int32()),
                            pa.array(np.concatenate(short) if short else np.zeros(0, np.int64)),
                        ),
                    ],
                    names=["node", "n", "short"],
                )

    return run


def may_link(n: int, m: int, a: np.ndarray, b: np.ndarray, share) -> bool:
    """Whether the merged parts (sorted) leave room for a link: shingles on one side only are differences."""
    top = min(a[-1], b[-1])
    a, b = a[: np.searchsorted(a, top, "right")], b[: np.searchsorted(b, top, "right")]
    short, long = (a, b) if len(a) < len(b) else (b, a)
    at = np.minimum(np.searchsorted(long, short), max(0, len(long) - 1))
    common = int((long[at] == short).sum()) if len(long) else 0
    most = n + m - 2 * (-(-share[0] * (n + m) // (share[0] + share[1])))
    return len(a) + len(b) - 2 * common <= most


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Binary probes of the smaller sorted set into the larger."""
    short, long = (a, b) if len(a) < len(b) else (b, a)
    if not len(long):
        return 0
    return int((long[np.minimum(np.searchsorted(long, short), len(long) - 1)] == short).sum())


def _check_short(share):
    def run(batches):
        for batch in batches:
            c = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            a, b = c["short_a"], c["short_b"]
            n, m = c["n_a"].to_numpy(), c["n_b"].to_numpy()
            keep = [
                may_link(int(n[i]), int(m[i]), a[i].values.to_numpy().view(np.uint64), b[i].values.to_numpy().view(np.uint64), share)
                for i in range(len(n))
            ]
            yield pa.RecordBatch.from_arrays([c["a"], c["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _check_sets(share):
    def run(batches):
        for batch in batches:
            c = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            keep = []
            for x, y in zip(c["set_a"], c["set_b"], strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = overlap(x, y)
                keep.append(share[1] * common >= share[0] * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([c["a"], c["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class Join:
    """One run of the join over ``docs``."""

    def __init__(self, docs: DataFrame, k: int, share):
        self.k, self.share = k, share
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.docs = self.docs.withColumn("text_hash", F.xxhash64("text"))
        kind = "doc_id long, text_hash long, node long, n long, slice int, task int, counts binary"
        named = stored(self.docs.mapInArrow(_named(k), kind), "sets-named")
        self.rows = named.filter("slice IS NULL").select("doc_id", "text_hash", "node", "n")
        level = self.docs.sparkSession.sparkContext.broadcast(levels(named))
        short = self.docs.mapInArrow(_short_lists(k, share, level), "node long, n long, short array<long>")
        self.short = stored(short.groupBy("node").agg(F.first("n").alias("n"), F.first("short").alias("short")), "sets-short")

    def close(self, n, m):
        """Sizes that a link allows."""
        return self.share[0] * F.greatest(n, m) <= self.share[1] * F.least(n, m)

    def lists(self) -> DataFrame:
        """(shingle, node, n, core, head, head_n): members of lists of two and more, with the first core member."""
        # n >= m shingles, an overlap of share / (1 + share) * (n + m) or more: the first common shingle has at
        # least 2 * share / (1 + share) * m - 1 others of the smaller set behind it.
        top, both = 2 * self.share[0], self.share[0] + self.share[1]
        core = F.col("at") < F.expr(f"n + 1 - ({top} * n + {both - 1}) div {both}")
        posted = self.short.select("node", "n", F.posexplode("short").alias("at", "long"))
        posted = posted.select("node", "n", core.alias("core"), F.col("long").bitwiseAND((1 << NAME_BITS) - 1).alias("shingle"))
        heads = posted.groupBy("shingle").agg(F.min(F.when(F.col("core"), F.struct("node", "n"))).alias("head"), F.count("*").alias("size"))
        heads = heads.filter("size > 1 AND head IS NOT NULL").select("shingle", F.col("head.node").alias("head"), F.col("head.n").alias("head_n"))
        return stored(posted.join(heads.hint("merge"), "shingle"), "sets-lists")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Those of the distinct pairs (a, b) whose merged parts leave room for a link."""
        side = lambda x: self.short.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("short").alias(f"short_{x}"))
        both = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b").select("a", "b", "n_a", "n_b", "short_a", "short_b")
        return stored(both.mapInArrow(_check_short(self.share), "a long, b long"), "sets-likely")

    def linked(self, likely: DataFrame, sets: DataFrame) -> DataFrame:
        """Those of the pairs that link, by probes into the whole sets."""
        whole = lambda x: sets.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}"))
        both = likely.join(whole("a").hint("merge"), "a").join(whole("b").hint("merge"), "b").select("a", "b", "set_a", "set_b")
        return stored(both.mapInArrow(_check_sets(self.share), "a long, b long"), "sets-links")

    def texts(self, wanted: DataFrame) -> DataFrame:
        """(want, text): squeezed texts that may have the wanted sets; a row meets only sets of its own id and text."""
        from_rows = self.rows.join(wanted.hint("merge"), "node").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("least"))
        where = from_rows.select(F.col("node").alias("want"), "least")
        small = self.docs.filter("text IS NOT NULL").mapInArrow(_squeezed, "doc_id long, text binary, text_hash long")
        at = (F.col("text_hash") == F.col("least.text_hash")) & F.col("doc_id").eqNullSafe(F.col("least.doc_id"))
        return small.join(where.hint("merge"), at).select("want", "text")

    def whole(self, wanted: DataFrame) -> DataFrame:
        """(node, set): the whole sets of the wanted nodes, from their texts."""
        sets = self.texts(wanted).mapInArrow(_whole_sets_of(self.k), "node long, set binary").dropDuplicates(["node"])
        return stored(sets, "sets-whole")

    def between(self, lists: DataFrame, roots: DataFrame) -> DataFrame:
        """Links (a, b) between members of a list that lie in different components, enough to join them all."""
        at = lists.join(roots.select("node", "root").hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
        others = at.filter("node <> head")
        name = [F.bit_xor(F.xxhash64("node", "core", F.lit(i))).alias(x) for i, x in enumerate("st")]
        sizes = [F.min(F.when(F.col("core"), F.col("n"))).alias("low"), F.max(F.when(F.col("core"), F.col("n"))).alias("high")]
        mixed = others.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("size"), *sizes, *name)
        # Lists with the same members (the shingles of one passage) are compared once.
        mixed = mixed.filter("x <> y AND low IS NOT NULL").groupBy("size", "low", "high", "s", "t").agg(F.min("shingle").alias("shingle"))
        mixed = stored(mixed, "sets-mixed")
        members = others.select("shingle", "node", "n", "root", "core")
        few = members.join(mixed.filter(F.col("size") <= FEW).select("shingle").hint("merge"), "shingle")
        other = few.select("shingle", F.col("node").alias("node_b"), F.col("n").alias("n_b"), F.col("root").alias("root_b"), F.col("core").alias("core_b"))
        apart = (F.col("node") < F.col("node_b")) & (F.col("root") != F.col("root_b"))
        apart &= ((F.col("n") > F.col("n_b")) | F.col("core")) & ((F.col("n") < F.col("n_b")) | F.col("core_b"))
        paired = few.join(other.hint("merge"), "shingle").filter(apart & self.close(F.col("n"), F.col("n_b")))
        likely = self.likely(paired.select(F.col("node").alias("a"), F.col("node_b").alias("b")).distinct())
        mixed = mixed.filter(F.col("size") > FEW)
        pieces = F.ceil(F.col("size") / CROWD).cast("int")
        placed = others.join(mixed.select("shingle", "low", "high", pieces.alias("pieces")).hint("merge"), "shingle")
        placed = placed.filter(F.col("core") | ((F.col("n") >= F.col("low")) & (self.share[0] * F.col("n") <= self.share[1] * F.col("high"))))
        placed = placed.withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
        placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        placed = placed.select(
            "shingle", "node", "n", "root", "piece", F.least("piece", "with").alias("first"), F.greatest("piece", "with").alias("second")
        )
        placed = stored(placed, "sets-placed")
        # The merged parts first: only members that some other may link with go on with their whole sets.
        task = ["shingle", "first", "second"]
        merged = placed.join(self.short.select("node", "short").hint("merge"), "node")
        may = merged.groupBy(*task).applyInPandas(_may_meet(self.share), "shingle long, first int, second int, node long")
        placed = stored(placed.join(may.hint("merge"), [*task, "node"]), "sets-met")
        sets = self.whole(_nodes(likely).unionByName(placed.select("node")).distinct())
        wide = placed.join(sets.hint("merge"), "node")
        found = wide.groupBy(*task).applyInPandas(_compare(self.share), "a long, b long")
        return stored(self.linked(likely, sets).unionByName(found), "sets-between")


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))


def _squeezed(batches):
    """(doc_id, text, text_hash) with the texts as they cross the shuffle."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = [squeeze.compress(t.as_buffer()) for t in batch.column(1).cast(pa.large_binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()), batch.column(2)], names=["doc_id", "text", "text_hash"])


def _whole_sets_of(k: int):
    """(wanted node, squeezed text) to (node, set) where the text has that set (ids may repeat)."""

    def run(batches):
        squeeze = zstandard.ZstdDecompressor()
        for batch in batches:
            want = batch.column(0).to_pylist()
            texts = pa.array([squeeze.decompress(t.as_buffer()) for t in batch.column(1)], pa.large_binary())
            for i, sets in _sets(pa.RecordBatch.from_arrays([batch.column(0), texts], names=["want", "text"]), k):
                got = [(want[i + j], s.tobytes()) for j, s in enumerate(sets) if len(s) and _digest(s) == want[i + j]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.binary())], names=["node", "set"]
                )

    return run


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Numbers of common members of all sets, by matrix products over pieces of the members met twice."""
    who = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, key, met = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = met > 1
    column = np.cumsum(several) - 1
    who, key = who[several[key]], column[key[several[key]]]
    order = np.argsort(key, kind="stable")
    who, key = who[order], key[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for a in range(0, int(several.sum()), 2048):
        i, j = np.searchsorted(key, [a, a + 2048])
        holds = np.zeros((len(sets), 2048), np.float32)
        holds[who[i:j], key[i:j] - a] = 1
        common += holds @ holds.T
    return common


#: Rows of a task's pair matrices that are held at once.
BLOCK_ROWS = 128


def _blocks_apart(pdf: pd.DataFrame):
    """(rows, matrix): pairs of one task that are to be compared, of different components, and of both pieces where there are two."""
    root, piece = pdf["root"].to_numpy(), pdf["piece"].to_numpy()
    two = pdf["first"].iloc[0] != pdf["second"].iloc[0]
    for i in range(0, len(root), BLOCK_ROWS):
        at = slice(i, i + BLOCK_ROWS)
        out = root[at, None] != root[None, :]
        if two:
            out &= piece[at, None] != piece[None, :]
        yield at, out


def _may_meet(share):
    """Members of one task with their merged parts: those that may link with another (``may_link`` for all pairs at once)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        short = [np.asarray(x).view(np.uint64) for x in pdf["short"]]
        last = np.array([x[-1] for x in short])
        reach = np.stack([np.searchsorted(x, last, "right").astype(np.int32) for x in short])  # members up to the other's last one
        n, common = pdf["n"].to_numpy(), _common(short)
        keep = np.zeros(len(short), bool)
        for at, apart in _blocks_apart(pdf):
            both = n[at, None] + n[None, :]
            most = both - 2 * (-(-share[0] * both // (share[0] + share[1])))
            keep[at] = ((reach[at] + reach[:, at].T - 2 * common[at] <= most) & apart).any(axis=1)
        return pdf.loc[keep, ["shingle", "first", "second", "node"]]

    return run


def _compare(share):
    """Members of one list (or of two of its pieces) with their whole sets: links that join different components.

    Occurrences in common lists are counted by matrix products; of the links a spanning forest is returned,
    so a dense group costs a row a member, not a row a pair.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("node").sort_values(["n", "node"], ignore_index=True)
        node, n, root = (pdf[c].to_numpy() for c in ("node", "n", "root"))
        common = _common([np.frombuffer(x, np.uint64) for x in pdf["set"]])
        _, group = np.unique(root, return_inverse=True)
        out = []
        for at, apart in _blocks_apart(pdf):
            ok = (share[1] * common[at] >= share[0] * (n[at, None] + n[None, :] - common[at])) & apart
            for i in range(at.start, at.start + len(ok)):
                for j in np.flatnonzero(ok[i - at.start, i + 1 :]) + i + 1:
                    if group[i] != group[j]:
                        out.append((node[i], node[j]))
                        group[group == group[j]] = group[i]
        pa.default_memory_pool().release_unused()
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return run


def _roots(docs: DataFrame, k: int, share) -> tuple[Join, DataFrame]:
    """The join and (node, root) of the nodes that link."""
    join = Join(docs, k, share)
    lists = join.lists()
    first = lists.filter("node <> head").filter(join.close(F.col("n"), F.col("head_n")))
    likely = join.likely(first.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct())
    links = join.linked(likely, join.whole(_nodes(likely).distinct()))
    roots = components(links)
    more = join.between(lists, roots)
    if not more.isEmpty():
        star = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(star.unionByName(more))
    return join, roots


def jaccard_components(docs: DataFrame, k: int = WORDS, share=SHARE) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    join, roots = _roots(docs, k, share)
    rows = join.rows
    rooted = rows.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stored(rooted.filter("node IS NOT NULL").select("doc_id", "n", "root"), "sets-roots")
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(least.hint("merge"), "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.filter("node IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return named.unionByName(alone)


def deduplicated(docs: DataFrame, k: int = WORDS, share=SHARE) -> DataFrame:
    """``docs`` with one row of each component: least id (nulls last), then least set name, then any of alike rows.

    Rows without words all stay.
    """
    join, roots = _roots(docs, k, share)

    @F.pandas_udf("long")
    def name_of(texts: pd.Series) -> pd.Series:
        batch = pa.RecordBatch.from_arrays([pa.nulls(len(texts)), pa.Array.from_pandas(texts, type=pa.large_string())], names=["", "text"])
        return pd.Series([_digest(s) if len(s) else None for _, sets in _sets(batch, k) for s in sets], dtype="Int64")

    rooted = join.rows.filter("node IS NOT NULL").join(roots.hint("merge"), "node", "left")
    rooted = stored(rooted.select("doc_id", "node", F.coalesce("root", "node").alias("root")).distinct(), "sets-roots")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "node"))
    heads = rooted.groupBy("root").agg(least.alias("head"))
    row, node = free("__id", docs), free("__node", docs)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("~"))
    gone = rooted.join(heads.hint("merge"), "root").filter(
        ~(F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("node") == F.col("head.node")))
    )
    keyed = docs.select("*", name_of(F.col("text").cast("string")).alias(node))
    # Rows without words are keyed by a number of their own: they all stay, and no second branch has to name the texts again.
    alone = F.when(F.col(node).isNull(), F.monotonically_increasing_id().cast("string"))
    keyed = keyed.withColumn(row, F.coalesce(alone, name("doc_id")))
    left = keyed.join(gone.select(name("doc_id").alias(row), F.col("node").alias(node)).hint("merge"), [row, node], "left_anti")
    # Alike rows: one stays.
    return left.dropDuplicates([row, node]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))


ORACLE_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + {WORDS} - 1], ' ') FOR i IN range(1, len(w) - {WORDS} + 2)]) END AS s
  FROM w
), u AS (SELECT rid, len(s) AS n, unnest(s) AS x FROM s),
l AS (
  SELECT a.rid AS a, b.rid AS b FROM u a JOIN u b ON a.x = b.x AND a.rid <> b.rid
    AND {SHARE[0]} * greatest(a.n, b.n) <= {SHARE[1]} * least(a.n, b.n)
  GROUP BY a.rid, b.rid HAVING {SHARE[1]} * count(*) >= {SHARE[0]} * (any_value(a.n) + any_value(b.n) - count(*))
), r(rid, root) AS (SELECT rid, doc_id FROM s UNION SELECT l.b, r.root FROM r JOIN l ON r.rid = l.a)
SELECT any_value(s.doc_id) AS doc_id, any_value(len(s.s))::BIGINT AS n_shingles, min(r.root) AS component_id
FROM s JOIN r USING (rid) GROUP BY rid
"""
