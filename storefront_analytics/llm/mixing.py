"""Mixing sources to target weights by hierarchical budgets.

The leaves of the tree are domain, language, source. A token budget goes down
the tree in proportion to the weights of the children. A child can use at most
the tokens of its leaves times the permitted epochs; what it cannot use goes to
its siblings, again by weight, and only what all of them cannot use goes to the
siblings of the parent, since a node's own limit is the sum of its leaves'.

A leaf's share is a prefix of seeded epochs: each epoch is the leaf's documents
in an order of its own, drawn by a seeded hash; whole epochs are taken first,
then documents of the next one up to the share, the one that would cross it
not included. Prefix sums run over hash buckets, then inside the one bucket
that holds the border, so a source of any size is never sorted as a whole.

Weights are given per level as columns; a weight that is null, negative or not
finite counts as 0, and children whose weights are all 0 share equally.

Defined cases: null or empty texts have no tokens and are taken where they
stand in an epoch; null languages and sources are leaves of
their own; rows without ``doc_id`` take no part; rows repeated with one
``doc_id`` are one document (the first by source, language and tokens counts).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import store
from .common import SPACE

BUCKETS = 1 << 12
LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class Mix:
    """``share``: the budget as a share of all tokens; weights by name, ``other`` for names not given."""

    domains: tuple[tuple[str, float], ...] = (("web", 0.5), ("books", 0.3), ("forum", 0.2))
    languages: tuple[tuple[str, float], ...] = (("en", 0.55), ("de", 0.15), ("fr", 0.15), ("es", 0.15))
    sources: tuple[tuple[str, float], ...] = ()
    other: float = 1.0
    share: float = 0.9
    epochs: int = 3
    seed: int = 11

    def domain(self) -> Column:
        """Sources are dealt to the domains by the number in their name; without one, to the last."""
        number = F.regexp_extract(F.coalesce("source", F.lit("")), r"(\d{1,9})$", 1).try_cast("int")
        names = F.array(*[F.lit(n) for n, _ in self.domains])
        return F.coalesce(
            F.get(names, F.pmod(number, F.lit(len(self.domains)))), F.lit(self.domains[-1][0])
        )

    def weight(self, level: str) -> Column:
        given = {"domain": self.domains, "lang": self.languages, "source": self.sources}[level]
        weight = F.lit(float(self.other))
        for name, value in given:
            weight = F.when(F.col(level).eqNullSafe(name), F.lit(float(value))).otherwise(weight)
        return F.when((weight > 0) & (weight < float("inf")), weight).otherwise(0.0)


def tokens() -> Column:
    """White-space separated words."""
    text = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " "))
    words = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1
    return F.when(text == "", 0).otherwise(words).cast("long")


def _shared(children: DataFrame, parent: list[str]) -> DataFrame:
    """Adds ``budget`` to rows with ``node_budget``, ``weight`` and ``limit``.

    Children with the least limit per weight fill up first. If those before a
    child are full, the rest by weight is its level; the greatest of these
    levels is the one at which all is given out.
    """
    over = W.partitionBy(*parent)
    total = F.sum("weight").over(over)
    children = children.withColumn("weight", F.when(total > 0, F.col("weight")).otherwise(1.0))
    weighty = F.col("weight") > 0
    children = children.withColumns(
        {"_fill": F.when(weighty, F.col("limit") / F.col("weight")), "_own": F.when(weighty, F.col("limit"))}
    )
    names = [c for c in LEVELS if c in children.columns]
    before = over.orderBy(F.col("_fill").asc_nulls_last(), *names).rowsBetween(W.unboundedPreceding, -1)
    rest = F.col("node_budget") - F.coalesce(F.sum("_own").over(before), F.lit(0.0))
    weights = F.sum("weight").over(over) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    children = children.withColumn("_level", F.when(weighty & (weights > 0), F.greatest(rest, F.lit(0.0)) / weights))
    given = F.least("limit", F.col("weight") * F.max("_level").over(over))
    children = children.withColumn("budget", F.when(weighty, given).otherwise(0.0))
    # Weightless children take what the others cannot use, in proportion to their limits.
    spare = F.greatest(F.col("node_budget") - F.sum("budget").over(over), F.lit(0.0))
    idle = F.sum(F.when(weighty, 0.0).otherwise(F.col("limit"))).over(over)
    extra = F.when(weighty | (idle <= 0), 0.0).otherwise(F.least("limit", F.try_divide(spare * F.col("limit"), idle)))
    return children.withColumn("budget", F.col("budget") + extra).drop("_fill", "_own", "_level")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with their ``budget``; a row per leaf, not per document."""
    leaves = leaves.withColumn("limit", F.col("tokens") * float(mix.epochs))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    known: list[str] = []
    nodes = None
    for depth, level in enumerate(LEVELS):
        names = list(LEVELS[: depth + 1])
        children = leaves.groupBy(*names).agg(F.sum("limit").alias("limit"), F.sum("tokens").alias("tokens"))
        children = children.withColumn("weight", mix.weight(level))
        if nodes is None:
            children = children.withColumn("node_budget", F.lit(float(total * mix.share)))
            children = _shared(children.withColumn("_all", F.lit(0)), ["_all"]).drop("_all")
        else:
            parents = nodes.select(*[F.col(c).alias(f"_{c}") for c in known], F.col("budget").alias("node_budget"))
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in known]
            children = _shared(children.join(parents, same).drop(*[f"_{c}" for c in known]), known)
        nodes = store(children, "mix-nodes").frame
        known = names
    return nodes.select(*LEVELS, "tokens", "budget")


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per document: doc_id, domain, lang, source, tokens, copies (0: not taken)."""
    counted = docs.select("doc_id", "lang", "source", tokens().alias("tokens")).filter("doc_id is not null")
    first = F.min(F.struct("source", "lang", "tokens")).alias("d")
    counted = counted.groupBy("doc_id").agg(first).select("doc_id", "d.*").withColumn("domain", mix.domain())
    counted = store(counted, "mix-counted").frame
    leaves = store(counted.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "mix-leaves").frame
    shares = budgets(leaves, mix)
    shares = shares.select(
        *[F.col(c).alias(f"_{c}") for c in LEVELS],
        # A share within rounding of whole epochs is that many epochs.
        F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens") + 1e-9)).otherwise(0).alias("whole"),
        "budget",
        F.col("tokens").alias("all_tokens"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LEVELS]
    shares = store(shares, "mix-shares").frame
    placed = counted.join(shares, same).drop(*[f"_{c}" for c in LEVELS])
    rest = F.col("budget") - F.col("whole") * F.col("all_tokens")
    draw = F.xxhash64(F.lit(mix.seed), "whole", "doc_id")
    placed = placed.withColumns(
        {"rest": F.when(rest > 0, rest).otherwise(0.0), "draw": draw, "bucket": F.shiftrightunsigned(draw, 52)}
    )
    placed = store(placed, "mix-placed").frame

    # Tokens before each bucket of a leaf, then inside the bucket with the border.
    leaf = [F.coalesce(F.col(c), F.lit("\0")).alias(c) if c != "domain" else F.col(c) for c in LEVELS]
    keyed = placed.select("doc_id", "tokens", "rest", "draw", "bucket", *leaf)
    sums = keyed.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("here"), F.max("rest").alias("rest"))
    upto = F.sum("here").over(W.partitionBy(*LEVELS).orderBy("bucket"))
    sums = sums.withColumn("upto", upto)
    border = sums.filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("here") <= F.col("rest")))
    border = store(border.select(*LEVELS, "bucket", (F.col("upto") - F.col("here")).alias("before")), "mix-border").frame
    edges = border.groupBy(*LEVELS).agg(F.min("bucket").alias("edge"), F.min_by("before", "bucket").alias("before"))
    edges = store(edges, "mix-edges").frame.select(*[F.col(c).alias(f"_{c}") for c in LEVELS], "edge", "before")
    same = [F.col(c) == F.col(f"_{c}") for c in LEVELS]
    keyed = keyed.join(edges, same, "left")
    inside = keyed.filter("bucket = edge and rest > 0")
    run = F.sum("tokens").over(W.partitionBy(*LEVELS).orderBy("draw", "doc_id"))
    inside = inside.withColumn("run", F.col("before") + run).filter("run <= rest").select("doc_id")
    below = keyed.filter("rest > 0 and (edge is null or bucket < edge)").select("doc_id")
    more = store(below.union(inside), "mix-more").frame.withColumn("more", F.lit(1))
    taken = placed.join(more, "doc_id", "left")
    copies = (F.col("whole") + F.coalesce("more", F.lit(0))).cast("int")
    return taken.select("doc_id", *LEVELS, "tokens", copies.alias("copies"))


def take_mix(docs: DataFrame, mix: Mix) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it was taken.

    Of rows with one ``doc_id`` the one that was counted is taken: that with the smallest source, lang and number of
    tokens.
    """
    taken = mixed(docs, mix).filter("copies > 0").select("doc_id", "source", "lang", "tokens", "copies")
    # The frame's own columns stay apart from ours, whatever they are called.
    whole = docs.select(F.col("doc_id").alias("id"), tokens().alias("n"), F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    same = (
        (whole["id"] == taken["doc_id"])
        & whole["row"]["source"].eqNullSafe(taken["source"])
        & whole["row"]["lang"].eqNullSafe(taken["lang"])
        & (whole["n"] == taken["tokens"])
    )
    found = whole.join(taken, same).groupBy("id", "copies")
    hashed = F.xxhash64(*[F.col("row")[c] for c, kind in docs.dtypes if not kind.startswith("map")])
    one = found.agg(F.min_by("row", hashed).alias("row"))
    return one.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")
