"""From raw documents to token ids: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps with
all their columns; the last returns their tokens. Mixing takes each document at
most once here (one epoch), so a kept document stays one row.

Defined cases: null texts count as empty. The quality stage judges every row,
rows without ``doc_id`` too; exact dedup drops those. Of rows with one ``doc_id``
one text counts from exact dedup on, and one of the rows that have it stays (the
smallest by a hash over all columns), so results don't depend on the order of
rows. Documents may have further columns under any name; they pass through. An
empty table stays empty. What a stage has stored for itself, and what the stage
before it returned, is deleted when the stage has been written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storefront_analytics.llm.bottom_k import keep_one_each
from storefront_analytics.llm.bpe import encode_documents
from storefront_analytics.llm.common import read_table
from storefront_analytics.llm.exact_dedup import keep_first
from storefront_analytics.llm.mixing import Mix, take_mix
from storefront_analytics.llm.quality import keep_good
from storefront_analytics.llm.queries import TOKENIZER
from storefront_analytics.sources.scratch import clear, store, stored_so_far

MIX = Mix(epochs=1, share=0.9)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of equal documents."""
    return keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each group of near copies."""
    return keep_one_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that bring domains, languages and sources to their target weights."""
    return take_mix(docs, MIX)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids."""
    return encode_documents(docs, TOKENIZER, with_ids=True).drop("decoded")


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("bpe", tokens),
]

#: Training, sketches and merges have no SQL form; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    before = stored_so_far(spark)
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}").frame
        clear(spark, before, last=False)
    return docs
