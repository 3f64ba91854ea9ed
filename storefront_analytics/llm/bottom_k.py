"""Near duplicates by bottom-k sketches.

One hash function maps every shingle to a number; a document keeps the
smallest ones (its sketch). Inverted lists of the kept values show which
documents share enough of them with others to have a partner at the threshold:
first by sketches of ``FIRST``, then of ``SECOND`` values, then by the whole sets.
Of those that are left, values that the same documents hold are one value with
a weight, and a document is listed under its rarest ones, as many as a partner
can't miss. Pairs within a list that sizes and places in the order allow are
confirmed on their full sets of hashed shingles (63 bits).

Bounds of loss: of a pair at the threshold each sketch value is shared with a
probability of 0.75, so fewer than the demanded 3 of 32 with 2.4e-16 and fewer
than 48 of 128 with 2e-20; sets that sketches hold whole, and everything after the
sketches, are exact, so that two unlike shingles with one hash are likelier to
change a result.

Nothing is quadratic in a group of copies: documents with the same set are one
from the start; of each list every document first meets the first one, so a
large group becomes one component. After that only values that several
components hold count, and only documents of different components meet. Lists that are long even then are dealt out by the next value that two
documents share, whenever that writes fewer rows than pairs and leaves half of the pairs
at most, so all rounds together write no more than the first lists have pairs.

Defined cases: null or empty texts and texts without words have no shingles and
no links; rows without ``doc_id`` take no part; rows repeated with one
``doc_id`` are one document, with different texts the one with the smallest
xxhash64 counts; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import store, store_in_buckets
from .common import map_rows, one_row_each
from .components import components

WORDS = 5
#: Values that a sketch keeps, and how many of them a document has to share.
FIRST = (32, 3)
SECOND = (128, 48)
PERCENT = 75
#: Percent of a sketch that documents share which meet first.
LIKELY = 50
#: Pairs of a list that all meet.
SHORT = 4096
REMEMBERED_WORDS = 100_000
_ODD = np.array([(3 + 2 * i) ** 39 % (1 << 64) for i in range(WORDS)], dtype=np.uint64)


class _WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(text: bytes, known: dict) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = text.lower().split()  # bytes: A-Z only, and the six white space bytes
    if not words:
        return np.empty(0, dtype=np.int64)
    hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(WORDS, len(words))
    count = len(words) - size + 1
    total = np.full(count, np.uint64(size))
    for place in range(size):
        total += hashes[place : place + count] * _ODD[place]
    return np.unique((_mixed(total) >> np.uint64(1)).astype(np.int64))


def _sketches(rows):
    known = _WordHashes()
    for row in rows:
        values = shingle_set(row["text"], known)
        yield row["doc_id"], row["text_hash"], len(values), *_digests(values), values[: FIRST[0]].tolist()


def _digests(values: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh128_digest(values.tobytes())
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _sets(rows):
    known = _WordHashes()
    for row in rows:
        values = shingle_set(row["text"], known)
        if _digests(values) == (row["digest_a"], row["digest_b"]):
            yield row["doc_id"], len(values), values.tobytes()


def _each_value(kept: DataFrame, column: str) -> DataFrame:
    """doc_id, n_shingles, value and part for every value in ``column``."""
    return kept.select("doc_id", "n_shingles", F.explode(column).alias("value"), "part")


def _values(sets: DataFrame, keep: int | None = None) -> DataFrame:
    """The smallest ``keep`` values of each set, or all: doc_id, n_shingles, value, part."""

    def run(rows):
        for row in rows:
            values = np.frombuffer(row["shingles"], dtype=np.int64)[:keep]
            yield row["doc_id"], row["n_shingles"], values.tolist(), row["part"]

    return _each_value(map_rows(sets, run, "doc_id long, n_shingles long, kept array<long>, part long"), "kept")


def _confirmed(rows):
    for row in rows:
        a, b = (np.frombuffer(row[k], dtype=np.int64) for k in ("set_a", "set_b"))
        common = len(np.intersect1d(a, b, assume_unique=True))
        if 100 * common >= PERCENT * (len(a) + len(b) - common):
            yield row["a"], row["b"]


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that reach the threshold."""
    return store(map_rows(_with_sets(pairs, sets), _confirmed, "a long, b long"), "near-links").frame


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with both sets; of the sets, which stand in buckets, only those of the pairs move."""
    sets = sets.select("doc_id", "shingles")
    # One a may have many b: its set is stored apart from the buckets, so that the join can be split.
    ahead = sets.join(pairs.select(F.col("a").alias("doc_id")).distinct(), "doc_id", "left_semi")
    ahead = store(ahead, "near-ahead").frame
    return pairs.join(sets.toDF("b", "set_b"), "b").join(ahead.toDF("a", "set_a"), "a")


def _needed(size="n_shingles"):
    """What a set shares at least with any partner."""
    return F.ceil(F.col(size) * PERCENT / 100)


def _sharing(values: DataFrame, keep: int, share: int) -> DataFrame:
    """doc_id of the documents that share enough of their kept values with other parts.

    ``values`` has doc_id, n_shingles, value and part; only documents of different parts can still be linked.
    """
    shared = values.groupBy("value").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q")
    shared = store(shared.select("value"), "near-shared").frame
    # Up to this size a partner's sketch is its set, too.
    whole = F.col("n_shingles") * 100 <= keep * PERCENT
    least = F.when(whole, _needed()).otherwise(F.least(_needed(), F.lit(share)))
    held = values.join(shared, "value", "left_semi").groupBy("doc_id", "n_shingles").agg(F.count(F.lit(1)).alias("held"))
    return store(held.filter(F.col("held") >= least).select("doc_id"), "near-sharing").frame


def _first_meetings(kept: DataFrame) -> DataFrame:
    """Pairs (a, b) of documents and first ones of their lists that their sketches say are alike.

    These only make components early; what they miss is found later.
    """
    heads = kept.groupBy("value").agg(F.min(F.struct("doc_id", "n_shingles")).alias("h"), F.count(F.lit(1)).alias("holders"))
    heads = heads.filter("holders > 1").select("value", F.col("h.doc_id").alias("a"), F.col("h.n_shingles").alias("n_a"))
    common = kept.join(store(heads, "near-heads").frame, "value").filter("a <> doc_id").groupBy("a", "n_a", "doc_id", "n_shingles")
    common = common.agg(F.count(F.lit(1)).alias("common"))
    sizes = F.least("n_a", "n_shingles") * 100 >= F.greatest("n_a", "n_shingles") * PERCENT
    alike = F.col("common") * 100 >= F.least("n_a", "n_shingles", F.lit(FIRST[0])) * LIKELY
    return common.filter(sizes & alike).select("a", F.col("doc_id").alias("b"))


def _fit(a: str, b: str):
    """Whether sizes, and the most that two documents of a list can share, allow a link."""
    sizes = F.least(f"n_{a}", f"n_{b}") * 100 >= F.greatest(f"n_{a}", f"n_{b}") * PERCENT
    most = F.least(f"most_{a}", f"most_{b}") * (100 + PERCENT)
    return sizes & (most >= (F.col(f"n_{a}") + F.col(f"n_{b}")) * PERCENT)


KEY = ["key_a", "key_b"]


def _weighted(values: DataFrame) -> DataFrame:
    """Each document's values that other parts hold, too, as groups with the same holders, rarest first.

    doc_id, n (its shingles), key_a and key_b (the group), weight (values of the group), place, left (weight of
    this and all later groups).
    """
    groups = values.groupBy("value").agg(
        F.count(F.lit(1)).alias("holders"),
        F.bit_xor(F.xxhash64("doc_id")).alias("key_a"),
        F.bit_xor(F.xxhash64(F.lit(1), "doc_id")).alias("key_b"),
        F.min("part").alias("p"),
        F.max("part").alias("q"),
    )
    groups = store(groups.filter("p <> q").drop("p", "q"), "near-groups").frame
    held = values.join(groups, "value").groupBy("doc_id", "n_shingles", "holders", *KEY).agg(F.count(F.lit(1)).alias("weight"))
    by_doc = W.partitionBy("doc_id")
    ordered = by_doc.orderBy("holders", *KEY)
    upto = F.sum("weight").over(ordered.rowsBetween(W.unboundedPreceding, 0))
    left = F.sum("weight").over(by_doc) - upto + F.col("weight")
    held = held.select("doc_id", F.col("n_shingles").alias("n"), *KEY, "weight", F.row_number().over(ordered).alias("place"), left.alias("left"))
    return store(held, "near-weighted").frame


def _with_part(frame: DataFrame, parts: DataFrame) -> DataFrame:
    """With the component of each document as ``part``."""
    part = F.coalesce("component_id", "doc_id").alias("part")
    return frame.join(parts, "doc_id", "left").select(*[c for c in frame.columns if c != "part"], part)


def _mixed_lists(lists: DataFrame, parts: DataFrame) -> DataFrame:
    """Lists whose documents are in several components."""
    placed = store(_with_part(lists, parts), "near-placed").frame
    mixed = placed.groupBy(*KEY).agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q")
    return store(placed.join(store(mixed.select(*KEY), "near-mixed").frame, KEY, "left_semi"), "near-open").frame


def _dealt(lists: DataFrame, weighted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Long lists dealt out by the next value that two documents share; and pairs that need no next one."""
    steps = weighted.select("doc_id", F.col("key_a").alias("next_a"), F.col("key_b").alias("next_b"), "weight", F.col("place").alias("next"), "left")
    done, certain = None, None
    while True:
        # Pairs of documents in different components.
        sizes = lists.groupBy(*KEY, "part").agg(F.count(F.lit(1)).cast("double").alias("docs")).groupBy(*KEY)
        pairs = (F.sum("docs") * F.sum("docs") - F.sum(F.col("docs") * F.col("docs"))) / 2
        long = store(sizes.agg(pairs.alias("pairs")).filter(F.col("pairs") > SHORT), "near-long")
        if not long.rows:
            return (lists if done is None else done.unionByName(lists)), certain
        more = (
            lists.join(long.frame, KEY)
            .join(steps, "doc_id")
            .filter((F.col("next") > F.col("place")) & (F.col("got") + F.col("left") >= _needed("n")))
        )
        # Two documents meet again in a list for each further value they share, so the pairs of the lists below count.
        below = more.groupBy(*KEY, "next_a", "next_b", "part").agg(F.count(F.lit(1)).cast("double").alias("docs"))
        below = below.groupBy(*KEY, "next_a", "next_b").agg(F.sum("docs").alias("fan"), pairs.alias("met")).groupBy(*KEY)
        below = below.agg(F.sum("fan").alias("fan"), F.sum("met").alias("met"))
        worth = long.frame.join(below, KEY, "left").filter("coalesce(fan * 4 + met * 2, 0) < pairs").select(*KEY)
        worth = store(worth, "near-worth")
        kept = lists if not worth.rows else lists.join(worth.frame, KEY, "left_anti")
        if not worth.rows:
            return (kept if done is None else done.unionByName(kept)), certain
        dealt = lists.join(worth.frame, KEY, "left_semi")
        # What is shared so far may do: then the smallest set of the list does with all that it does for.
        least = dealt.groupBy(*KEY).agg(F.min(F.struct("n", "doc_id")).alias("l"))
        sure = dealt.join(least, KEY).filter((F.col("n") + F.col("l.n")) * PERCENT <= F.col("got") * (100 + PERCENT))
        sure = sure.filter("doc_id <> l.doc_id").select(F.least("doc_id", "l.doc_id").alias("a"), F.greatest("doc_id", "l.doc_id").alias("b"))
        certain = sure if certain is None else certain.unionByName(sure)
        done = kept if done is None else done.unionByName(kept)
        following = more.join(worth.frame, KEY, "left_semi").select(
            F.xxhash64("key_a", "next_a").alias("key_a"),
            F.xxhash64("key_b", "next_b").alias("key_b"),
            "doc_id",
            "n",
            F.col("next").alias("place"),
            (F.col("got") + F.col("weight")).alias("got"),
            (F.col("got") + F.col("left")).alias("most"),
            "part",
        )
        following = store(following, "near-dealt").frame
        several = following.groupBy(*KEY).agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q")
        lists = store(following.join(several.select(*KEY), KEY, "left_semi"), "near-dealt-open").frame


def _crossing(lists: DataFrame) -> DataFrame:
    """Pairs (a, b) of documents of one list that are in different components."""
    largest = lists.groupBy(*KEY, "part").agg(F.count(F.lit(1)).alias("docs")).groupBy(*KEY)
    largest = largest.agg(F.max(F.struct("docs", "part"))["part"].alias("largest"))
    one = [*KEY, "doc_id", "n", "most", "part"]
    # Documents of a list's largest component don't meet each other.
    left = lists.join(largest, KEY).filter("part <> largest").select(one).toDF(*KEY, "a", "n_a", "most_a", "p")
    right = lists.select(one).toDF(*KEY, "b", "n_b", "most_b", "q")
    met = left.join(right, KEY).filter("p <> q").filter(_fit("a", "b"))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _heads(lists: DataFrame) -> DataFrame:
    """Each document with the first one of its list, if that is in another component and a link is possible."""
    heads = lists.groupBy(*KEY).agg(F.min(F.struct("doc_id", "n", "most", "part")).alias("h"))
    heads = heads.select(
        *KEY,
        F.col("h.doc_id").alias("a"),
        F.col("h.n").alias("n_a"),
        F.col("h.most").alias("most_a"),
        F.col("h.part").alias("p"),
    )
    own = lists.withColumnsRenamed({"doc_id": "b", "n": "n_b", "most": "most_b"})
    return own.join(heads, KEY).filter("p <> part").filter(_fit("a", "b")).select("a", "b").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return _near_duplicates(docs).drop("text_hash")


def _near_duplicates(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).filter("doc_id is not null")
    sketched = map_rows(
        docs,
        _sketches,
        "doc_id long, text_hash long, n_shingles long, digest_a long, digest_b long, sketch array<long>",
    )
    columns = F.struct("text_hash", "n_shingles", "digest_a", "digest_b", "sketch")
    one = sketched.groupBy("doc_id").agg(F.min(columns).alias("s"))
    shapes = store(one.select("doc_id", "s.*"), "near-shapes").frame

    key = ["n_shingles", "digest_a", "digest_b"]
    classes = shapes.filter("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("first_id"))
    classes = store(classes, "near-classes")
    firsts = store(
        shapes.join(classes.frame.select(F.col("first_id").alias("doc_id")), "doc_id", "left_semi").select(
            "doc_id", "n_shingles", "digest_a", "digest_b", "sketch"
        ),
        "near-firsts",
    ).frame

    alone = F.col("doc_id").alias("part")
    sharing = _sharing(_each_value(firsts.select("*", alone), "sketch"), *FIRST)
    likely = store_in_buckets(firsts.join(sharing, "doc_id", "left_semi"), "near-likely", "doc_id").frame
    # Of each document the text that counts; everything is grouped by doc_id alone, as the buckets are.
    texts = docs.join(likely.select("doc_id", "digest_a", "digest_b"), "doc_id").groupBy("doc_id")
    texts = texts.agg(F.min_by("text", "text_hash").alias("text"), *[F.first(c).alias(c) for c in ("digest_a", "digest_b")])
    sets = map_rows(texts, _sets, "doc_id long, n_shingles long, shingles binary")
    sets = store_in_buckets(sets, "near-sets", "doc_id").frame

    # Documents meet first ones whose sketches are like theirs. After that, only links between components matter:
    # documents take part that share enough values with other components, by larger and larger sketches.
    met = _first_meetings(_each_value(likely.select("*", alone), "sketch").drop("part"))
    links = _links(store(met, "near-first-met").frame, sets)
    parts = components(links)
    open_ = sets.join(_sharing(_each_value(_with_part(likely, parts), "sketch"), *FIRST), "doc_id", "left_semi")
    open_ = _with_part(open_, parts)
    open_ = open_.join(_sharing(_values(open_, SECOND[0]), *SECOND), "doc_id", "left_semi")
    weighted = _weighted(_values(open_))
    lists = weighted.filter(F.col("left") >= _needed("n")).select(
        *KEY, "doc_id", "n", "place", F.col("weight").alias("got"), F.col("left").alias("most")
    )
    met = store(_heads(_mixed_lists(lists, parts)), "near-met").frame
    links = links.unionByName(_links(met, sets))
    mixed = _mixed_lists(lists, components(links))
    short, certain = _dealt(mixed, weighted)
    crossing = _crossing(short)
    if certain is not None:
        crossing = crossing.unionByName(certain).distinct()
    crossing = store(crossing.join(met, ["a", "b"], "left_anti"), "near-crossing").frame
    links = links.unionByName(_links(crossing, sets))
    parts = components(links)

    first = shapes.join(classes.frame, key, "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("first_id", "doc_id").alias("first_id")
    )
    component = F.coalesce("component_id", "first_id")
    return first.join(parts.withColumnRenamed("doc_id", "first_id"), "first_id", "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        (component == F.col("doc_id")).alias("kept"),
    )


def keep_one_each(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns; of its rows with the text that counts, one stays."""
    kept = _near_duplicates(docs).filter("kept").select("doc_id", "text_hash")
    same = (docs["doc_id"] == kept["doc_id"]) & (F.xxhash64(docs["text"]) == kept["text_hash"])
    return one_row_each(docs.join(kept, same, "left_semi"))
