"""Operator 6: embedding near-duplicates by a subspace pigeonhole join.

Vectors are scaled to length 1, so cosine >= c means a squared distance of at most
2 - 2c = r2.  After one random rotation the coordinates are split into ``BLOCKS`` blocks of
few dimensions; the squared distance is the sum over blocks, so a linked pair has a block
with at most r2 / BLOCKS.  Each block is range-joined at that radius: a vector lies at home
in one grid cell over the block's first ``GRID`` coordinates and visits the cells within
the radius; a pair meets in the home cell of the one with the smaller number.  Every
candidate is verified by the exact cosine in double precision, and counted in the first of
its blocks that is near, told by one formula wherever it meets, so no pair is counted twice and no pair is ever written:
tasks return link counts per vector and the edges of a spanning forest.

Vectors that are bit for bit equal are one row with a weight.  A crowded cell is cut into
pieces of at most ``CROWD`` rows; every pair of pieces is a task of its own.

Defined cases: null, zero or non-finite vectors, null labels and null components link with
nothing; vectors of different lengths don't compare; an embedding of a null id takes part
(its component is the smallest known id reachable, null if there is none); repeated rows
are vectors of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.llm.common import components, stored, table

COSINE = 0.98
BLOCKS = 8
GRID = 2
CELL = 3.0
CROWD = 4096
SLACK = 1e-9


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix, the same for the same dimension."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _blocks(x: np.ndarray) -> list[np.ndarray]:
    """Rotated coordinates of unit rows, by block (fewer blocks than dimensions at least)."""
    dims = x.shape[1]
    return np.array_split(x @ rotation(dims), min(BLOCKS, dims), axis=1)


def _radius(blocks: int, cosine: float) -> float:
    return float(np.sqrt((2 - 2 * cosine) / blocks)) + SLACK


def _first_near(gap: np.ndarray, turn: np.ndarray, near: float) -> np.ndarray:
    """The first block in which the difference of two unit vectors is near (its squared length at most ``near``).

    One formula for every task and every block: sums in a fixed order, so a pair has the same answer wherever it meets.
    """
    if not len(gap):
        return np.zeros(0, np.int64)
    dims = gap.shape[1]
    turned = np.einsum("ij,jk->ik", gap, turn)
    squares = np.stack([(y * y).sum(axis=1) for y in np.array_split(turned, min(BLOCKS, dims), axis=1)], axis=1)
    return np.argmax(squares <= near, axis=1)


def usable(vectors: DataFrame) -> DataFrame:
    """``vectors`` (vec_id, embedding, label) with a flag: whether the vector may link."""
    e = F.col("embedding").cast("array<double>")
    odd = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    real = e.isNotNull() & F.col("label").isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists(e, lambda x: x != 0)
    return vectors.select("vec_id", e.alias("e"), F.col("label").cast("string").alias("label"), F.coalesce(real, F.lit(False)).alias("real"))


def _visits(cosine: float):
    """Rows (node, label, e) to rows (label, block, cell, home, node, unit vector)."""

    def visit(frames):
        for pdf in frames:
            for dims, part in pdf.groupby(pdf["e"].map(len), sort=True):
                x = np.stack(part["e"].to_numpy()).astype(np.float64)
                x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                blocks = _blocks(x)
                radius = _radius(len(blocks), cosine) + SLACK  # beyond what counts as near, whatever the rounding
                side = CELL * radius
                raw = [row.tobytes() for row in x]
                for b, y in enumerate(blocks):
                    grid = min(GRID, y.shape[1])
                    home = np.floor(y[:, :grid] / side).astype(np.int64)
                    low, high = np.floor((y[:, :grid] - radius) / side).astype(np.int64), np.floor((y[:, :grid] + radius) / side).astype(np.int64)
                    steps = np.stack(np.meshgrid(*[[-1, 0, 1]] * grid, indexing="ij"), -1).reshape(-1, grid)
                    for s in steps:
                        cell = home + s
                        at = np.flatnonzero(((cell >= low) & (cell <= high)).all(axis=1))
                        if len(at):
                            names = [f"{dims}:{b}:" + ":".join(map(str, c)) for c in cell[at]]
                            yield pd.DataFrame(
                                {
                                    "label": part["label"].to_numpy()[at],
                                    "cell": names,
                                    "home": not s.any(),
                                    "node": part["node"].to_numpy()[at],
                                    "weight": part["weight"].to_numpy()[at],
                                    "x": [raw[i] for i in at],
                                }
                            )

    return visit


class Forest:
    """Union-find over places 0..n-1; the smaller place is the root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _meet(cosine: float):
    """One cell, or one pair of pieces of a crowded cell: link counts and forest edges."""

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.frombuffer(v, np.float64) for v in pdf["x"]])
        node, weight, home, piece = (pdf[c].to_numpy() for c in ("node", "weight", "home", "piece"))
        block = int(pdf["cell"].iloc[0].split(":")[1])
        first, second = int(pdf["first"].iloc[0]), int(pdf["second"].iloc[0])
        blocks, turn = _blocks(x), rotation(x.shape[1])
        near = _radius(len(blocks), cosine) ** 2
        forest, links, edges = Forest(len(x)), np.zeros(len(x), np.int64), []
        for i in range(0, len(x), 256):
            mine = np.arange(i, min(i + 256, len(x)))
            a = blocks[block][mine]
            d = (a * a).sum(1)[:, None] + (blocks[block] ** 2).sum(1)[None, :] - 2 * a @ blocks[block].T
            ok = (d <= near + SLACK) & home[mine, None] & (node[mine, None] < node[None, :])
            if first != second:
                ok &= piece[mine, None] != piece[None, :]
            p, q = np.nonzero(ok)
            p = mine[p]
            exact = np.einsum("ij,ij->i", x[p], x[q]) >= cosine
            p, q = p[exact], q[exact]
            here = _first_near(x[p] - x[q], turn, near) == block  # the pair is counted in that block alone
            p, q = p[here], q[here]
            np.add.at(links, p, weight[q])
            np.add.at(links, q, weight[p])
            roots = forest.up.copy()
            for s, t in zip(p[roots[p] != roots[q]], q[roots[p] != roots[q]], strict=True):
                if forest.join(s, t):
                    edges.append((node[s], node[t]))
            for k in range(len(x)):
                forest.up[k] = forest.find(k)
        hit = np.flatnonzero(links)
        return pd.DataFrame(
            {
                "node": np.r_[node[hit], np.array([e[0] for e in edges], np.int64)],
                "other": pd.array([pd.NA] * len(hit) + [e[1] for e in edges], dtype="Int64"),
                "links": np.r_[links[hit], np.zeros(len(edges), np.int64)],
            }
        )

    return meet


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, crowd: int = CROWD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label)."""
    rows = stored(usable(vectors), "vectors")
    # Bit-equal vectors of a label are one node, named by their hash.
    nodes = (
        rows.filter("real")
        .groupBy("label", "e")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
        .withColumn("node", F.xxhash64("label", "e"))
    )
    nodes = stored(nodes, "vector-nodes")
    kind = "label string, cell string, home boolean, node long, weight long, x binary"
    visits = stored(nodes.select("node", "label", "e", "weight").mapInPandas(_visits(cosine), kind), "vector-cells")
    sizes = visits.groupBy("label", "cell").agg(F.count("*").alias("size"), F.max("home").alias("lived")).filter("lived AND size > 1")
    pieces = F.ceil(F.col("size") / crowd).cast("int")
    placed = visits.join(sizes.withColumn("pieces", pieces).drop("size", "lived").hint("merge"), ["label", "cell"])
    placed = placed.withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    # A piece meets itself and every other piece of its cell.
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    placed = placed.withColumn("first", F.least("piece", "with")).withColumn("second", F.greatest("piece", "with")).drop("with", "pieces")
    met = placed.groupBy("label", "cell", "first", "second").applyInPandas(_meet(cosine), "node long, other long, links long")
    met = stored(met, "vector-links")
    links = met.filter("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(met.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    # The root is a node; its component's id is the smallest known vec_id in it.
    grouped = nodes.select("node", "label", "e", "least", "weight").join(links.hint("merge"), "node", "left").join(roots.hint("merge"), "node", "left")
    grouped = stored(grouped.withColumn("root", F.coalesce("root", "node")), "vector-roots")
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(least.hint("merge"), "root").select(
        "label", "e", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    linked = rows.filter("real").join(named.hint("merge"), ["label", "e"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT real").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op6_embedding_neardup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL
    AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {COSINE}
), r(id, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.root FROM r JOIN l ON r.id = l.a),
c AS (SELECT id, min(root) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id JOIN c ON c.id = v.vec_id
"""
