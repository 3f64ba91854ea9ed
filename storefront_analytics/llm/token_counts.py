"""Token counts with a cache of digests.

A document is known by the SHA-256 of its normalised content, a tokenizer by
that of its file. Contents whose counts are stored for this tokenizer are
looked up; of the others each is encoded once, and its count is appended.
The cache is a Parquet folder that later runs read again.

Normalised content: null is the empty text; for a tokenizer that drops white
space, every run of ASCII white space is one space, with none at the ends.

Defined cases: every input row gives one output row, repeated rows and rows
without ``doc_id`` too; empty texts have no tokens; a cache folder that does
not exist yet is an empty cache; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import shared_folder, store
from . import bpe
from .common import SPACE, Remembered, map_rows

CACHE = "tokenizer string, content string, n_tokens long"


class _WordCounter:
    """Counts per word: a word-end BPE never merges across words."""

    def __init__(self, path: str):
        self.encoder, _ = bpe.load(path)
        self.known = Remembered(lambda piece: len(self.encoder.encode_piece(piece)))

    def __call__(self, text: str) -> int:
        return sum(map(self.known.__getitem__, self.encoder.pieces(text)))


@lru_cache(maxsize=4)
def counter(path: str):
    """text -> number of tokens, as the library for the file gives them."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(pieces.encode(text))
    try:
        return _WordCounter(path)
    except (ValueError, KeyError):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def drops_space(path: str) -> bool:
    """Whether white space only separates words for this tokenizer."""
    if path.endswith(".model"):
        return False
    with open(path, encoding="utf-8") as file:
        try:
            bpe.Vocabulary(json.load(file))
        except (ValueError, KeyError):
            return False
    return True


def _read_cache(spark: SparkSession, folder: str, tokenizer: str) -> DataFrame:
    try:
        cache = spark.read.schema(CACHE).parquet(folder)
    except AnalysisException:
        cache = spark.createDataFrame([], CACHE)
    return cache.filter(F.col("tokenizer") == tokenizer).select("content", "n_tokens")


def token_counts(docs: DataFrame, path: str, limit: int = 2048, cache: str | None = None) -> DataFrame:
    """One row per row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit``).

    ``cache`` is the folder of stored counts; without one, a new folder beside
    the intermediate tables is used and not read by later calls.
    """
    spark = docs.sparkSession
    cache = cache or f"{shared_folder(spark)}/storefront/token-cache-{uuid.uuid4().hex}"
    with open(path, "rb") as file:
        tokenizer = hashlib.sha256(file.read()).hexdigest()
    text = F.coalesce("text", F.lit(""))
    content = F.trim(F.regexp_replace(text, SPACE, " ")) if drops_space(path) else text
    keyed = docs.select("doc_id", "text", F.sha2(content, 256).alias("content"))
    rows = store(keyed.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), "content"), "digests").frame

    known = _read_cache(spark, cache, tokenizer)
    misses = (
        rows.groupBy("content")
        .agg(F.min("doc_id").alias("first_id"))
        .join(known, "content", "left_anti")
        .withColumnRenamed("content", "missing")
    )

    def count(texts):
        tokens = counter(path)
        for row in texts:
            yield tokenizer, row["content"], tokens(row["text"].decode())

    one_each = (F.col("content") == F.col("missing")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    encoded = map_rows(keyed.join(misses, one_each, "left_semi").select("content", "text"), count, CACHE)
    # Rows repeated with one id are encoded more than once and stored once.
    encoded.dropDuplicates(["tokenizer", "content"]).write.mode("append").parquet(cache)
    # Runs side by side may have stored a count twice.
    counts = store(_read_cache(spark, cache, tokenizer).dropDuplicates(["content"]), "counts").frame
    return rows.join(counts, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
