from __future__ import annotations

import pytest

from storefront_analytics.llm.mixing import Mix, budgets, mixed, take_mix


def _leaves(spark, rows):
    return spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")


def test_shortages_go_to_siblings_before_ancestors(spark):
    mix = Mix(domains=(("web", 0.5), ("books", 0.5)), languages=(), sources=(), share=0.5, epochs=1)
    rows = [("web", "en", "a", 10), ("web", "en", "b", 90), ("web", "de", "c", 20), ("books", "en", "d", 80)]
    got = {r.source: r.budget for r in budgets(_leaves(spark, rows), mix).collect()}
    # 100 tokens: 50 each. web: 25 to each language, de has 20, so en gets 30: a 10 and b 20.
    assert got == pytest.approx({"a": 10, "b": 20, "c": 20, "d": 50})


def test_an_ancestor_takes_what_siblings_cannot(spark):
    mix = Mix(domains=(("web", 0.9), ("books", 0.1)), languages=(), sources=(), share=0.5, epochs=1)
    rows = [("web", "en", "a", 10), ("web", "de", "b", 5), ("books", "en", "c", 85)]
    got = {r.source: r.budget for r in budgets(_leaves(spark, rows), mix).collect()}
    assert got == pytest.approx({"a": 10, "b": 5, "c": 35})


@pytest.mark.parametrize("weight", [None, -1.0, float("nan"), 0.0])
def test_useless_weights_count_as_nought(spark, weight):
    mix = Mix(domains=(("web", weight if weight is not None else 0.0), ("books", 1.0)), languages=(), share=0.5, epochs=1)
    rows = [("web", "en", "a", 60), ("books", "en", "b", 40)]
    got = {r.source: r.budget for r in budgets(_leaves(spark, rows), mix).collect()}
    assert got == pytest.approx({"a": 10, "b": 40})  # only what books cannot use


def test_hard_cases_and_prefixes(documents, hard):
    docs = documents([*hard, *[(100 + i, "w " * (i % 7)) for i in range(200)]])
    mix = Mix(share=1.4, epochs=2)
    rows = mixed(docs, mix).collect()
    ids = {d for d, _ in hard if d is not None} | {100 + i for i in range(200)}
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    assert {r.copies for r in rows} <= {0, 1, 2}
    leaves = {}
    for r in rows:
        leaves.setdefault((r.domain, r.lang, r.source), []).append(r)
    for members in leaves.values():
        # Whole epochs and a prefix: copies differ by one at most.
        counts = {m.copies for m in members if m.tokens}
        assert not counts or max(counts) - min(counts) <= 1
    again = {r.doc_id: r.copies for r in mixed(docs, mix).collect()}
    assert again == {r.doc_id: r.copies for r in rows}
    other = {r.doc_id: r.copies for r in mixed(docs, Mix(share=0.5, seed=12)).collect()}
    assert other != {r.doc_id: r.copies for r in mixed(docs, Mix(share=0.5, seed=13)).collect()}


def test_rows_are_repeated_and_tables_may_be_empty(documents):
    docs = documents([(i, "one two three") for i in range(12)])
    taken = take_mix(docs, Mix(share=2.0, epochs=2))
    assert taken.columns == docs.columns and taken.count() == 24
    assert mixed(docs.limit(0)).count() == 0
    assert mixed(documents([(1, None), (2, "")])).count() == 2
