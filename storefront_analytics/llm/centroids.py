"""Subtree totals of a forest by centroid decomposition.

The forest is given by its parent edges. A component is split at its centroid,
the deepest node whose subtree holds half of the component: the total of that
subtree is added to every node on the path from the centroid to the top of the
component, the centroid leaves, and its child subtrees and the rest above it
are components of at most half the size, which are split in turn. A node's
total is the sum of what was added to it, after a number of rounds that grows
with the logarithm of the nodes, however deep or broad the forest is.

Components of more than ``limit`` nodes are split by joins, all of them at once
in a round; smaller ones go to tasks whole, many to a task, and are split there.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import store

#: Nodes of a component that one task splits.
LIMIT = 20_000


def split_totals(parents: Sequence[int], values: Sequence[Sequence[int]]) -> list[list[int]]:
    """Subtree totals of a forest in memory; ``parents`` holds positions, -1 for a top."""
    below: list[list[int]] = [[] for _ in parents]
    for node, parent in enumerate(parents):
        if parent >= 0:
            below[parent].append(node)
    totals = [[0] * len(parents) for _ in values]
    gone = [False] * len(parents)
    sizes = [0] * len(parents)
    todo = [node for node, parent in enumerate(parents) if parent < 0]
    while todo:
        top = todo.pop()
        members = [top]
        for node in members:  # grows while it is read: parents before children
            members += [c for c in below[node] if not gone[c]]
        sums = [dict.fromkeys(members, 0) for _ in values]
        for node in members:
            sizes[node] = 1
            for k, column in enumerate(values):
                sums[k][node] = column[node]
        for node in reversed(members[1:]):
            parent = parents[node]
            sizes[parent] += sizes[node]
            for column in sums:
                column[parent] += column[node]
        centroid = top
        while True:
            heavy = next((c for c in below[centroid] if not gone[c] and 2 * sizes[c] >= len(members)), None)
            if heavy is None:
                break
            centroid = heavy
        node = centroid
        while True:
            for k, column in enumerate(sums):
                totals[k][node] += column[centroid]
            if node == top:
                break
            node = parents[node]
        gone[centroid] = True
        todo += [c for c in below[centroid] if not gone[c]]
        if centroid != top:
            todo.append(top)
    return totals


def subtree_totals(nodes: DataFrame, path: DataFrame, values: list[str], limit: int = LIMIT) -> DataFrame:
    """c, d and, under its name, the subtree total of each of ``values`` (longs) of every node.

    A node is known by (c, d): a line through the forest and the depth on it.
    ``nodes`` has c, d, parent (the c of the parent, which has depth d - 1; null for a
    top), size (nodes of the subtree, itself included) and the values; ``path``
    has the node of every line at each depth: line, depth, owner (its c), parent.
    """
    tops = path.filter("parent is null").select(F.col("line").alias("c"), F.col("owner").alias("tc"), F.col("depth").alias("td"))
    current = store(nodes.join(tops, "c"), "centroid-open").frame
    places = path.select(F.col("line").alias("c"), F.col("depth").alias("place"), "owner", F.col("parent").alias("above"))
    ready, added = [], []
    while True:
        whole = current.filter("c = tc and d = td").select("tc", "td", F.col("size").alias("whole"))
        large = store(whole.filter(F.col("whole") > limit), "centroid-large")
        ready.append(current.join(large.frame, ["tc", "td"], "left_anti"))
        if not large.rows:
            break
        inside = current.join(large.frame, ["tc", "td"])
        halves = inside.filter("2 * size >= whole").groupBy("tc", "td")
        # Such nodes are ancestors of each other, so the least is one.
        found = halves.agg(F.min(F.struct("size", "c", "d")).alias("z"))
        found = found.select("tc", "td", F.col("z.c").alias("zc"), F.col("z.d").alias("zd"), F.col("z.size").alias("zs"))
        found = store(found, "centroid-found").frame
        inside = inside.join(found, ["tc", "td"])
        # The ancestor one step below the centroid's depth tells whether a node hangs under it, and where.
        step = places.withColumnsRenamed({"c": "line"})
        deeper = inside.filter("d > zd").join(step, (F.col("line") == F.col("c")) & (F.col("place") == F.col("zd") + 1))
        under = deeper.withColumn("under", F.coalesce(F.col("above") == F.col("zc"), F.lit(False)))
        rest = inside.filter("d <= zd").withColumns({"owner": F.lit(None).cast("long"), "under": F.lit(False)})
        kept = [*nodes.columns, "tc", "td", "zc", "zd", "zs", "owner", "under"]
        dealt = store(under.select(kept).unionByName(rest.select(kept)), "centroid-dealt").frame
        itself = (F.col("c") == F.col("zc")) & (F.col("d") == F.col("zd"))
        sums = dealt.filter(F.col("under") | itself).groupBy("tc", "td", "zc", "zd", "zs")
        sums = store(sums.agg(*[F.sum(v).alias(v) for v in values]), "centroid-sums").frame
        above = sums.join(places.withColumnRenamed("c", "zc"), "zc").filter("place >= td and place < zd")
        above = store(above.select("tc", "td", F.col("owner").alias("c"), F.col("place").alias("d"), "zs", *values), "centroid-above")
        added.append(sums.select(F.col("zc").alias("c"), F.col("zd").alias("d"), *values))
        added.append(above.frame.select("c", "d", *values))
        left = dealt.filter(~F.col("under") & ~itself).drop("zs").join(above.frame.drop(*values), ["tc", "td", "c", "d"], "left")
        left = left.withColumn("size", F.col("size") - F.coalesce("zs", F.lit(0)))
        moved = dealt.filter("under").withColumns({"tc": F.col("owner"), "td": F.col("zd") + 1})
        columns = [*nodes.columns, "tc", "td"]
        current = store(left.select(columns).unionByName(moved.select(columns)), "centroid-open").frame

    whole = ready[0]
    for part in ready[1:]:
        whole = whole.unionByName(part)
    whole = store(whole.select("c", "d", "parent", "tc", "td", *values), "centroid-ready")
    groups = max(1, -(-whole.rows // (4 * limit)))
    schema = "c long, d long, " + ", ".join(f"{v} long" for v in values)

    def split(table: pa.Table) -> pa.Table:
        rows = {k: table[k].to_pylist() for k in table.column_names}
        index = {key: i for i, key in enumerate(zip(rows["c"], rows["d"], strict=True))}
        parents = [
            -1 if (c, d) == (tc, td) else index[parent, d - 1]
            for c, d, parent, tc, td in zip(*(rows[k] for k in ("c", "d", "parent", "tc", "td")), strict=True)
        ]
        totals = split_totals(parents, [rows[v] for v in values])
        return pa.table({"c": rows["c"], "d": rows["d"], **dict(zip(values, totals, strict=True))})

    bucket = F.pmod(F.xxhash64("tc", "td"), F.lit(groups)).alias("bucket")
    parts = whole.frame.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(split, schema)
    for more in added:
        parts = parts.unionByName(more)
    return parts.groupBy("c", "d").agg(*[F.sum(v).alias(v) for v in values])
