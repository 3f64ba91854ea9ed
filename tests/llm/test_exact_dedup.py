from __future__ import annotations

import hashlib
import re

import pytest

from storefront_analytics.llm import exact_dedup as X


def _expected(pairs):
    first, of = {}, {}
    for doc, text in sorted((p for p in set(pairs) if p[0] is not None), key=lambda p: p[0]):
        plain = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        of[doc] = plain
        first.setdefault(plain, doc)
    sizes = {}
    for plain in of.values():
        sizes[plain] = sizes.get(plain, 0) + 1
    return {
        (d, first[t], sizes[t], first[t] == d, hashlib.sha256(t.encode()).hexdigest()) for d, t in of.items()
    }


def _got(docs):
    found = X.exact_groups(docs).collect()
    return [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found]


def test_hard_cases(documents, hard):
    got = _got(documents(hard))
    assert len(got) == len(set(got)) and set(got) == _expected(hard)


def test_large_group_over_many_copies(documents, prose, monkeypatch):
    monkeypatch.setattr(X, "MEMBERS_PER_COPY", 3)
    pairs = [(i, prose(30, i % 2)) for i in range(40)]
    assert set(_got(documents(pairs))) == _expected(pairs)


def test_empty_table(documents):
    assert _got(documents([(1, "x")]).filter("doc_id < 0")) == []


def test_collisions_are_told_apart(documents, monkeypatch):
    # All fingerprints of one length are equal: only the comparison decides.
    monkeypatch.setattr(X, "fingerprints", lambda docs, f=X.fingerprints: f(docs).selectExpr(
        "doc_id", "text_sha256", "n_bytes", "1L as fp_a", "1L as fp_b"))
    pairs = [(1, "ab"), (2, "cd"), (3, "ab"), (4, "cd"), (5, "ef"), (6, "cd")]
    assert set(_got(documents(pairs))) == _expected(pairs)


@pytest.mark.parametrize("cut", [0, 1, 5, 11])
def test_fingerprints_compose(cut):
    text = b"hello world"
    left, right = text[:cut], text[cut:]
    assert X.combine(X.chunk_hash(left), X.chunk_hash(right), len(right)) == X.chunk_hash(text)


def test_one_of_conflicting_rows_stays(documents):
    kept = X.keep_first(documents([(1, "b"), (1, "a"), (2, "a"), (3, "c"), (3, "c")]))
    assert kept.columns[:3] == ["text", "score", "doc_id"]
    found = sorted((r.doc_id, r.text) for r in kept.collect())
    chosen = min(("a", "b"), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert found == ([(1, chosen), (3, "c")] if chosen == "a" else [(1, "b"), (2, "a"), (3, "c")])
