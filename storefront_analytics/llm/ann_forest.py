"""Approximate nearest neighbours by a forest of random-projection trees.

Every inner node projects onto the line between two centroids of a random draw
and splits at the median. The trees are fitted on at most ``sample`` vectors
(taken in the order of a hash of their id), but every vector is put into its
leaf of every tree. A query walks all trees through one priority queue, nearest
unvisited half-space first, and lists the leaves to visit; in each leaf the
exact distances are computed and the nearest rows kept, and the nearest of all
visited leaves are the result.

Leaves are cut into blocks of about ``block`` rows, and a query goes to every
block of its leaves, so a vector that a third of all rows share fills no task.

Recall depends on the data. The effort is ``visits`` times the leaves of one
tree, over all trees; README has measured recalls. The leaves number at most
``leaves`` per tree, a bound on what is broadcast.

Defined cases: vectors that are null, all zero, of another length than most
(ties: the smaller length), or hold a null or non-finite component take no part,
nor do rows without ``vec_id``; of rows with one ``vec_id`` the nearest counts;
equal distances go to the smaller ``vec_id``; with fewer candidates than asked
for, all are returned; further columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import store
from .common import map_rows


@dataclass(frozen=True)
class ForestConfig:
    trees: int = 12
    leaves: int = 256
    least_leaf: int = 8
    sample: int = 20_000
    draw: int = 200
    visits: float = 0.8
    block: int = 512
    seed: int = 5


@dataclass
class Tree:
    """``nodes[i]`` is (row of ``normals``, threshold, left, right), or the number of a leaf."""

    normals: list[np.ndarray] = field(default_factory=list)
    nodes: list = field(default_factory=list)
    leaves: int = 0

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        found = np.zeros(len(vectors), dtype=np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if isinstance(self.nodes[node], int):
                found[rows] = self.nodes[node]
                continue
            normal, threshold, left, right = self.nodes[node]
            low = vectors[rows] @ self.normals[normal] <= threshold
            todo += [(left, rows[low]), (right, rows[~low])]
        return found


def _direction(vectors: np.ndarray, random, draw: int) -> np.ndarray:
    """From one centroid of a random draw to the other."""
    some = vectors[random.choice(len(vectors), min(len(vectors), draw), replace=False)]
    centers = some[:2]
    for _ in range(4):
        near = ((some - centers[0]) ** 2).sum(1) < ((some - centers[1]) ** 2).sum(1)
        if near.all() or not near.any():
            break
        centers = np.array([some[near].mean(0), some[~near].mean(0)])
    return centers[0] - centers[1]


def fit_tree(vectors: np.ndarray, config: ForestConfig, seed: int) -> Tree:
    random, tree = np.random.default_rng(seed), Tree()
    size = max(config.least_leaf, -(-len(vectors) // config.leaves))

    def grow(rows: np.ndarray) -> int:
        node = len(tree.nodes)
        tree.nodes.append(None)
        for _ in range(3 if len(rows) > size else 0):
            normal = _direction(vectors[rows], random, config.draw)
            length = np.linalg.norm(normal)
            if not length:
                continue
            normal = normal / length
            places = vectors[rows] @ normal
            threshold = float(np.median(places))
            low = places <= threshold
            if low.all():  # many equal vectors at the upper end
                threshold = float(np.nextafter(places.max(), -np.inf))
                low = places <= threshold
            if low.any() and not low.all():
                tree.normals.append(normal)
                at = len(tree.normals) - 1
                tree.nodes[node] = (at, threshold, grow(rows[low]), grow(rows[~low]))
                return node
        tree.nodes[node] = tree.leaves
        tree.leaves += 1
        return node

    grow(np.arange(len(vectors)))
    return tree


def leaves_to_visit(trees: list[Tree], sizes: list[np.ndarray], query: np.ndarray, config: ForestConfig, least: int):
    """(tree, leaf) pairs from one queue over all trees, nearest half-spaces first."""
    wanted = config.visits * sum(t.leaves for t in trees) / len(trees)
    queue = [(0.0, t, 0) for t in range(len(trees))]
    found, rows = [], [0] * len(trees)
    while queue and (len(found) < wanted or max(rows) < least):
        far, tree, node = heapq.heappop(queue)
        nodes, normals = trees[tree].nodes, trees[tree].normals
        while not isinstance(nodes[node], int):
            normal, threshold, left, right = nodes[node]
            margin = float(query @ normals[normal]) - threshold
            node, other = (left, right) if margin <= 0 else (right, left)
            heapq.heappush(queue, (far + margin * margin, tree, other))
        found.append((tree, nodes[node]))
        rows[tree] += int(sizes[tree][nodes[node]])
    return found


def _usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    good = (
        vectors.select("vec_id", "embedding")
        .filter("vec_id is not null and embedding is not null")
        .filter(~F.coalesce(odd, F.lit(True)) & F.coalesce(some, F.lit(False)))
    )
    lengths = good.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    length = lengths["n"] if lengths else 0
    return good.filter(F.size("embedding") == length), length


def _matrix(column: pa.ChunkedArray | pa.Array, kind: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=kind).reshape(len(rows), -1).astype(np.float64)


def nearest(vectors: DataFrame, queries, k: int = 10, config: ForestConfig = ForestConfig()) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest found for the rows that ``queries`` selects."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    kind = "f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "f8"
    usable, length = _usable(vectors)
    if not length:
        return spark.createDataFrame([], schema)

    drawn = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(config.sample).select("embedding").toArrow()
    sample = np.array(drawn["embedding"].to_pylist(), dtype=np.float64)
    trees = [fit_tree(sample, config, config.seed + t) for t in range(config.trees)]
    forest = spark.sparkContext.broadcast(trees)

    def into_leaves(rows):
        # A batch at a time: routing is a product of matrices.
        def flush(batch):
            matrix = np.array([r["embedding"] for r in batch], dtype=np.float64)
            places = [t.leaf_of(matrix) for t in forest.value]
            for i, row in enumerate(batch):
                packed = np.array(row["embedding"], dtype=kind).tobytes()
                for tree, leaf in enumerate(places):
                    yield tree, int(leaf[i]), row["vec_id"], packed

        batch = []
        for row in rows:
            batch.append(row)
            if len(batch) == 2000:
                yield from flush(batch)
                batch = []
        if batch:
            yield from flush(batch)

    placed = store(map_rows(usable, into_leaves, "tree int, leaf int, vec_id long, vector binary"), "ann-leaves").frame
    # At most trees x leaves rows.
    counts = placed.groupBy("tree", "leaf").count().collect()
    sizes = [np.zeros(t.leaves, dtype=np.int64) for t in trees]
    for row in counts:
        sizes[row["tree"]][row["leaf"]] = row["count"]
    known = spark.sparkContext.broadcast(sizes)

    def visits(rows):
        for row in rows:
            query = np.array(row["embedding"], dtype=np.float64)
            packed = np.array(row["embedding"], dtype=kind).tobytes()
            for tree, leaf in leaves_to_visit(forest.value, known.value, query, config, k + 1):
                for block in range(-(-int(known.value[tree][leaf]) // config.block)):
                    yield tree, leaf, block, row["vec_id"], packed

    asked = map_rows(usable.filter(queries), visits, "tree int, leaf int, block int, query_id long, query binary")
    block_sizes = [np.maximum(1, -(-s // config.block)) for s in sizes]
    per_leaf = spark.createDataFrame(
        [(t, leaf, int(b)) for t, s in enumerate(block_sizes) for leaf, b in enumerate(s)],
        "tree int, leaf int, blocks int",
    )
    cut = placed.join(F.broadcast(per_leaf), ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block"), "vec_id", "vector"
    )

    def rank(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found = [[], [], []]
        if queries.num_rows and rows.num_rows:
            asked, there = _matrix(queries["query"], kind), _matrix(rows["vector"], kind)
            ids = rows["vec_id"].to_numpy()
            for query, own in zip(asked, queries["query_id"].to_pylist(), strict=True):
                scores = np.sqrt(((there - query) ** 2).sum(axis=1))
                order = np.lexsort((ids, scores))
                order = order[ids[order] != own][:k]
                found[0] += [own] * len(order)
                found[1] += ids[order].tolist()
                found[2] += scores[order].tolist()
        kinds = (pa.int64(), pa.int64(), pa.float64())
        columns = [pa.array(values, type) for values, type in zip(found, kinds, strict=True)]
        return pa.Table.from_arrays(columns, names=["query_id", "vec_id", "score"])

    place = ["tree", "leaf", "block"]
    near = (
        asked.groupBy(*place)
        .cogroup(cut.groupBy(*place))
        .applyInArrow(rank, "query_id long, vec_id long, score double")
    )
    each = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
