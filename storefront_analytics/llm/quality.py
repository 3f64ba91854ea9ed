"""Quality classifier on supervised subword embeddings.

Words, their character n-grams and pairs of a word with itself are hashed into
one table of vectors; a document is the mean of its vectors and of some that
are nought, so that few words don't decide, and a softmax layer on top gives the
probability of each label. Vectors and layer are learned together by
stochastic gradient descent in numpy from a bounded sample of labelled rows.
Once learned, a hashed feature adds a fixed number to the log odds, so scoring
a document is a mean of numbers looked up in one small table.

Bound: at most ``max_rows`` labelled rows are learned from, taken in the order
of a hash of their id, each by at most ``draws`` drawn features; scoring reads
every row and its whole text.

Defined cases: a null or empty text is scored from the bias alone; every input
row gives one output row, repeated rows and rows without ``doc_id`` too; rows
whose label is null or not 0 or 1 are not learned from; of several labels of
one document the smallest counts. Without any labels the score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, texts_of
from .rolling import mixed, prefix_hashes, undo

PIECE_BYTES = 1 << 20
#: The feature of a word that follows itself.
AGAIN = 54_321


@dataclass(frozen=True)
class QualityConfig:
    buckets: int = 1 << 16
    dimension: int = 16
    grams: tuple[int, ...] = (1, 2, 3)
    epochs: int = 8
    #: Small samples are gone through until so many documents have been learned from.
    least_steps: int = 20_000
    rate: float = 0.5
    max_rows: int = 5000
    #: Features drawn from a document, in proportion to their counts, and those one step uses.
    draws: int = 3000
    step_draws: int = 400
    #: Vectors of nought in each mean.
    nought: int = 40
    seed: int = 7


def features(text: bytes, config: QualityConfig) -> np.ndarray:
    """Buckets of all words, of their character n-grams with a space at each end, and of repeated words."""
    parts = [_part_features(p, config) for p in _parts(text)]
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)


def _parts(text: bytes):
    """Words joined by single spaces, a space at both ends; long texts in pieces of about a megabyte."""
    at = 0
    while at < len(text):
        end = at + PIECE_BYTES
        if end < len(text):
            end = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end)) + 1 or end
        words = text[at:end].split()
        if words:
            yield b" " + b" ".join(words) + b" "
        at = end


def _part_features(part: bytes, config: QualityConfig) -> np.ndarray:
    values = np.frombuffer(part, dtype=np.uint8)
    space = values == 32
    codes = values.astype(np.uint32)
    found = []
    for n in config.grams:
        size = len(codes) - n + 1
        code = np.full(size, n << 28, dtype=np.uint32)
        for i in range(n):
            code ^= codes[i : i + size] << np.uint32(8 * i)
        # A space may stand at the ends of an n-gram only.
        whole = ~space if n == 1 else np.ones(size, dtype=bool)
        for i in range(1, n - 1):
            whole &= ~space[i : i + size]
        code = code[whole] * np.uint32(2_654_435_761)
        found.append((code ^ (code >> np.uint32(15))) % np.uint32(config.buckets))
    borders = np.flatnonzero(space)
    first, last = borders[:-1] + 1, borders[1:]
    hashes = prefix_hashes(values)
    words = mixed((hashes[last] - hashes[first]) * undo(len(values) + 1)[first])
    found.append((words >> np.uint64(40)) % np.uint64(config.buckets))
    again = int((words[1:] == words[:-1]).sum())
    found.append(np.full(again, AGAIN % config.buckets))
    return np.concatenate([f.astype(np.int64) for f in found])


@dataclass(frozen=True)
class QualityModel:
    """``odds[bucket]`` is what a feature adds to the log odds of label 1."""

    odds: np.ndarray
    bias: float
    config: QualityConfig

    def score(self, total: float, features: int) -> float:
        z = self.bias + total / (features + self.config.nought)
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def train(documents: list[tuple[np.ndarray, np.ndarray, int]], config: QualityConfig) -> QualityModel:
    """From (buckets, counts, label) per document."""
    random = np.random.default_rng(config.seed)
    vectors = random.uniform(-1, 1, (config.buckets, config.dimension)) / config.dimension
    layer = np.zeros((config.dimension, 2))
    bias = np.zeros(2)
    labels = np.array([d[2] for d in documents], dtype=int)
    if len(set(labels.tolist())) < 2:
        share = np.clip(labels.mean(), 0.01, 0.99) if len(labels) else 0.5
        return QualityModel(np.zeros(config.buckets), float(np.log(share / (1 - share))), config)
    epochs = max(config.epochs, -(-config.least_steps // len(documents)))
    steps, at = epochs * len(documents), 0
    for _ in range(epochs):
        for which in random.permutation(len(documents)):
            buckets, counts, label = documents[which]
            rate = config.rate * (1 - at / steps)
            at += 1
            size = counts.sum()
            if len(buckets) > config.step_draws:
                buckets = random.choice(buckets, config.step_draws, p=counts / size)
                counts = np.full(config.step_draws, size / config.step_draws)
            shares = counts / (size + config.nought)
            hidden = shares @ vectors[buckets]
            logits = hidden @ layer + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[label] -= 1
            gradient = layer @ error
            layer -= rate * np.outer(hidden, error)
            bias -= 0.1 * rate * error
            # Sparse step: features are spread over many rows of the table.
            np.subtract.at(vectors, buckets, np.outer(shares * rate * 20, gradient))
    return QualityModel(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]), config)


def held_out(column="doc_id"):
    """Documents whose labels are never learned from."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> QualityModel:
    """Learn from a bounded sample of the labelled rows that are not held out."""
    usable = (
        labels.filter("doc_id is not null and quality in (0, 1)")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(config.max_rows)
    # The broadcast is bounded by max_rows rows of two numbers.
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def count(rows):
        for row in rows:
            buckets, counts = np.unique(features(row["text"], config), return_counts=True)
            if len(buckets) > config.draws:
                drawn = np.random.default_rng(row["doc_id"] % (1 << 32)).multinomial(
                    config.draws, counts / counts.sum()
                )
                counts = drawn[drawn > 0] * (counts.sum() / config.draws)
                buckets = buckets[drawn > 0]
            yield row["doc_id"], row["quality"], buckets.tolist(), counts.tolist()

    counted = map_rows(chosen, count, "doc_id long, quality int, buckets array<int>, counts array<float>").toArrow()
    # A repeated document is learned from once.
    found = {}
    for i, document in enumerate(counted["doc_id"].to_pylist()):
        found[document] = (
            counted["buckets"][i].values.to_numpy(),
            counted["counts"][i].values.to_numpy().astype(float),
            counted["quality"][i].as_py(),
        )
    return train([found[i] for i in sorted(found)], config)


def score_text(text: bytes, learned: QualityModel) -> float:
    total, count = 0.0, 0
    for part in _parts(text):
        found = _part_features(part, learned.config)
        total += float(learned.odds[found].sum())
        count += len(found)
    return learned.score(total, count)


def score_documents(docs: DataFrame, model: QualityModel, cut: float = 0.3) -> DataFrame:
    """One row per row: doc_id, score, predicted (score of at least ``cut``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows):
        for row in rows:
            score = score_text(row["text"], shared.value)
            yield row["doc_id"], score, int(score >= cut)

    return map_rows(docs.select("doc_id", "text"), run, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig(), cut: float = 0.3) -> DataFrame:
    """The rows whose text scores at least ``cut``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, config))

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column(batch.schema.get_field_index("text")))
            yield batch.filter(pa.array([score_text(t, shared.value) >= cut for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """One row per row: doc_id, held_out, score, predicted."""
    scored = score_documents(docs, fit(docs, labels, config))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
