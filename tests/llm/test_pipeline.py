from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from storefront_analytics.llm import queries
from storefront_analytics.llm.common import one_row_each
from storefront_analytics.llm.exact_dedup import collapse_space

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage kept, in order."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        found.append((name, docs))
    return {name: frame.toPandas() for name, frame in found}


def test_stages_keep_columns_and_whole_rows(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "mixing", "bpe"]
    before = stages["documents"]
    for name in names[:-1]:
        after = stages[name]
        assert list(after.columns) == list(before.columns)
        whole = before.merge(after, on=list(before.columns))
        assert len(whole) == len(after) <= len(before) and after.doc_id.is_unique
        before = after
    assert sorted(stages["bpe"].doc_id) == sorted(before.doc_id)


def test_decisions(stages, spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    bad = set(labels[labels.quality == 0].doc_id)
    assert len(bad & set(stages["quality"].doc_id)) <= 0.05 * len(bad)
    good = set(labels[labels.quality == 1].doc_id)
    assert len(good - set(stages["quality"].doc_id)) <= 0.02 * len(good)
    first = {}
    for row in stages["quality"].sort_values("doc_id").itertuples():
        first.setdefault(collapse_space(row.text.encode()), row.doc_id)
    assert sorted(stages["exact_dedup"].doc_id) == sorted(first.values())
    from tests.llm.test_near_dedup import _expected

    pairs = list(zip(stages["exact_dedup"].doc_id, stages["exact_dedup"].text))
    assert sorted(stages["near_dedup"].doc_id) == [d for d, _, _, kept in _expected(pairs) if kept]
    assert 0.7 * len(stages["near_dedup"]) < len(stages["mixing"]) < len(stages["near_dedup"])


def test_hard_rows_pass_through_the_stages(spark, documents, hard, prose):
    pairs = [*hard, *[(200 + i, prose(200, i)) for i in range(30)], (200, "another text of one id"), (201, prose(200, 1))]
    docs = documents(pairs)
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, FOLDER)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        kept = spark.createDataFrame(after.collect(), docs.schema)
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and None not in ids
    tokens = corpus_pipeline.STAGES[-1][1](spark, kept, FOLDER)
    assert sorted(r.doc_id for r in tokens.collect()) == sorted(ids)


def test_one_row_of_an_id_whatever_the_order(documents):
    docs = documents([(1, "a"), (1, "b"), (1, None), (1, "a"), (2, "c"), (None, "d")])
    first = sorted(map(str, one_row_each(docs).collect()))
    assert len(first) == 2
    for parts in (1, 5):
        assert sorted(map(str, one_row_each(docs.repartition(parts, "text")).collect())) == first


def test_empty_table(spark, documents):
    docs = documents([(1, "a")]).filter("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.collect() == []


def test_one_query_each():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(entry.queries()) >= {*queries.QUERIES, "pipeline"}
