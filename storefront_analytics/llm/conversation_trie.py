"""The prefix trie of conversations that share their first turns.

Each conversation is rebuilt: its head is taken from the first conversation of
its hundred. A node of the trie is a distinct sequence of first turns; it is
known by its smallest member and its depth, so a conversation owns the deepest
nodes of its line, from where nobody smaller goes with it. Prefixes are
compared by a sum of digests of their turns, each with its place (120 bits),
which needs no order and so is built in blocks of ``BLOCK`` turns. Subtree
totals come from a centroid decomposition of the parent edges (``centroids``).

Defined cases: rows without ``conv_id`` take no part; null roles and texts are
empty; turns that tie (equal or null ``turn``) are ordered by the SHA-256 of role
and text, and repeated rows are turns of their own; further columns are ignored;
without conversations there is no root.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ranking import with_positions
from ..sources.scratch import store
from .centroids import LIMIT, subtree_totals
from .common import map_rows

#: Conversations that share a head, and one more than the longest head.
FAMILY, HEADS = 100, 6
#: Turns of one conversation that one window takes, and ids (two to this power) that one string takes.
BLOCK, ID_BITS = 4096, 12
PARTS, PART_DIGITS = 3, 10
_MASK = (1 << 4 * PART_DIGITS) - 1
_PRINT = [f"f{i}" for i in range(PARTS)]
NOTHING = hashlib.sha256(b"").hexdigest()


def _ordered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their place (from 1) in their conversation; conversations with their number of turns."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.length(text).cast("long").alias("points"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
    )
    # Numbered over all conversations by range, so that a long one fills no task.
    placed = with_positions(turns, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")])
    lines = placed.groupBy("conv_id").agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("total"))
    lines = store(lines, "trie-lines").frame
    placed = placed.join(lines, "conv_id").select("conv_id", (F.col("position") - F.col("first") + 1).alias("place"), "points", "digest")
    return store(placed, "trie-turns").frame, lines


def _rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, n_turns, depth, points, digest) and conv_id, n_turns of all."""
    turns, lines = _ordered(conversations)
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    lines = lines.select("conv_id", "total", head.alias("head"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    bases = lines.select(F.col("conv_id").alias("base"), F.col("total").alias("base_total"))
    taken = F.least("head", F.coalesce("base_total", F.lit(0)))
    lines = lines.join(bases, "base", "left").withColumn("taken", taken)
    lines = lines.withColumn("n_turns", F.col("taken") + F.greatest(F.col("total") - F.col("head"), F.lit(0)))
    lines = store(lines.select("conv_id", "base", "head", "taken", "n_turns"), "trie-rebuilt-lines").frame
    own = turns.join(lines, "conv_id").filter("place > head").withColumn("depth", F.col("taken") + F.col("place") - F.col("head"))
    # A base gives at most HEADS - 1 turns to at most FAMILY conversations.
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS)).withColumnRenamed("conv_id", "base")
    heads = heads.join(lines, "base").filter("place <= head").withColumn("depth", F.col("place"))
    columns = ["conv_id", "n_turns", "depth", "points", "digest"]
    return own.select(columns).unionByName(heads.select(columns)), lines.select("conv_id", "n_turns")


def _prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, depth, points and the print of the first ``depth`` turns."""
    item = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest")), 256)
    turns = turns.withColumn("item", item).withColumn("block", F.floor((F.col("depth") - 1) / BLOCK))
    piece = [F.conv(F.substring("item", 1 + PART_DIGITS * i, PART_DIGITS), 16, 10).cast("long") for i in range(PARTS)]
    turns = turns.withColumns(dict(zip(_PRINT, piece, strict=True))).drop("item", "digest")
    turns = store(turns, "trie-items").frame
    blocks = turns.filter(F.col("n_turns") > BLOCK).groupBy("conv_id", "block").agg(
        *[F.sum(p).bitwiseAND(_MASK).alias(p) for p in _PRINT]
    )
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", *[F.sum(p).over(earlier).alias(f"c{p}") for p in _PRINT])
    upto = W.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    summed = turns.withColumns({p: F.sum(p).over(upto) for p in _PRINT}).join(blocks, ["conv_id", "block"], "left")
    prints = [(F.col(p) + F.coalesce(f"c{p}", F.lit(0))).bitwiseAND(_MASK).alias(p) for p in _PRINT]
    return summed.select("conv_id", "n_turns", "depth", "points", *prints)


def _ends_digests(rows):
    """Joined ids of a node come in order, in several strings; ids are hashed as they pass."""
    node, digest = None, None
    for row in rows:
        if node != (row["c"], row["d"]):
            if node:
                yield *node, digest.hexdigest()
            node, digest = (row["c"], row["d"]), hashlib.sha256(row["ids"].encode())
        else:
            digest.update(b"," + row["ids"].encode())
    if node:
        yield *node, digest.hexdigest()


def _ends(ends: DataFrame) -> DataFrame:
    """c, d, ends_sha256 from c, d, conv_id. A task hashes a node's ids one after another, 4096 in a row."""
    block = F.shiftright("conv_id", ID_BITS).alias("block")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    strings = ends.groupBy("c", "d", block).agg(ids.alias("ids"))
    strings = strings.repartition("c", "d").sortWithinPartitions("c", "d", "block").select("c", "d", "ids")
    return map_rows(strings, _ends_digests, "c long, d long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``limit`` is the number of nodes of a component that one task may split.
    """
    turns, lines = _rebuilt(conversations)
    rows = store(_prefixes(turns), "trie-rows").frame
    key = ["depth", *_PRINT]
    found = rows.groupBy(*key).agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("points").alias("points"))
    found = store(found, "trie-found").frame
    lanes = rows.join(found.select(*key, "owner"), key).select(F.col("conv_id").alias("line"), "depth", "n_turns", "owner")
    lanes = store(lanes, "trie-lanes").frame

    # A node's parent is the node one step higher on its owner's line.
    higher = lanes.select(F.col("line").alias("owner"), (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"))
    nodes = store(found.join(higher, ["owner", "depth"], "left"), "trie-nodes").frame
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    # Nodes below each: every member adds the nodes that it owns there.
    owned = lanes.filter("line = owner").groupBy("line").agg(F.count(F.lit(1)).alias("owned"))
    below = F.least("owned", F.col("n_turns") - F.col("depth") + 1)
    sizes = lanes.join(owned, "line").groupBy("owner", "depth").agg(F.sum(below).alias("size"))
    nodes = nodes.join(children, ["owner", "depth"], "left").join(sizes, ["owner", "depth"]).select(
        F.col("owner").alias("c"),
        F.col("depth").alias("d"),
        "parent",
        "size",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("points")).alias("saved_tokens"),
    )
    nodes = store(nodes, "trie-sized").frame
    parents = nodes.select(F.col("c").alias("owner"), F.col("d").alias("depth"), "parent")
    path = store(lanes.select("line", "depth", "owner").join(parents, ["owner", "depth"]), "trie-path").frame
    values = ["n_leaves", "saved_tokens"]
    totals = store(subtree_totals(nodes.select("c", "d", "parent", "size", *values), path, values, limit), "trie-totals").frame

    # The root joins all components; its figures are one row.
    first = lines.agg(F.min("conv_id").alias("c"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    tops = nodes.filter("parent is null").select("c", "d").join(totals, ["c", "d"])
    whole = tops.agg(F.count(F.lit(1)).alias("n_children"), *[F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in values])
    root = first.crossJoin(whole).withColumns(
        {
            "d": F.lit(0).cast("long"),
            "parent": F.lit(None).cast("long"),
            "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long"),
        }
    )
    root = store(root, "trie-root").frame
    least = root.select(F.col("c").alias("top"))
    described = nodes.drop("size", *values).join(totals, ["c", "d"]).crossJoin(F.broadcast(least))
    described = described.withColumn("parent", F.coalesce("parent", "top")).select(root.columns).unionByName(root)
    ended = lanes.filter("depth = n_turns").select(F.col("owner").alias("c"), F.col("depth").alias("d"), F.col("line").alias("conv_id"))
    turnless = lines.filter("n_turns = 0").crossJoin(F.broadcast(least)).select(
        F.col("top").alias("c"), F.lit(0).cast("long").alias("d"), "conv_id"
    )
    return described.join(_ends(ended.unionByName(turnless)), ["c", "d"], "left").select(
        F.col("c").alias("conv_id"),
        F.col("d").alias("depth"),
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )
