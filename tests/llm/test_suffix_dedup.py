from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from storefront_analytics.llm import rolling
from storefront_analytics.llm import suffix_dedup as S


def _expected(pairs):
    first = {}
    for doc, text in pairs:
        if doc is not None:
            data = (text or "").encode()
            for i in range(len(data) - S.LENGTH + 1):
                w = data[i : i + S.LENGTH]
                first[w] = min(doc, first.get(w, doc))
    rows = []
    for doc, text in pairs:
        if doc is None:
            continue
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - S.LENGTH + 1):
            if first[data[i : i + S.LENGTH]] < doc:
                gone[i : i + S.LENGTH] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        rows.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(rows)


def _got(docs, **more):
    rows = S.remove_repeats(docs, **more).collect()
    for r in rows:
        assert sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2])) == r.n_removed
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


def test_hard_cases(documents, hard):
    short = [(d, t if t is None or len(t) < 5000 else t[:5000]) for d, t in hard]
    assert _got(documents(short)) == _expected(short)


@pytest.mark.parametrize("hot", [256, 2])
def test_passages_copies_and_periods(documents, prose, monkeypatch, hot):
    # Small blocks: most comparisons go through buckets.
    monkeypatch.setattr(S, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(S, "BUCKET_BYTES", 4000)
    rng = random.Random(3)
    passage, other = prose(30, 1), prose(30, 2)
    pairs = []
    for i in range(60):
        own = prose(rng.randint(0, 60), 100 + i)
        at = rng.randint(0, len(own))
        part = rng.choice(["", passage, passage[: rng.randint(40, 120)], other[rng.randint(0, 60) :], passage + other])
        pairs.append((rng.randint(0, 10_000), own[:at] + part + own[at:]))
    pairs += [(20_000 + i, "ab" * 70 + "x" * i) for i in range(6)]
    pairs += [(30_000, passage), (30_001, passage), (5, passage[:50]), (30_002, "é" * 60), (30_003, "é" * 61)]
    assert _got(documents(pairs), hot_blocks=hot) == _expected(pairs)


def test_long_text_and_empty_table(documents, prose):
    long = prose(90_000, 4)  # several chunks of hashing
    rows = _got(documents([(1, long), (2, "z" + long[200:-100])]))
    assert rows[0][2] == 0 and rows[1][2] == len(long) - 300
    assert _got(documents([(1, "x")]).filter("doc_id < 0")) == []
    assert [r[:3] for r in _got(documents([(1, None), (2, "")]))] == [(1, 0, 0), (2, 0, 0)]


def test_order_is_that_of_the_suffixes():
    rng = random.Random(6)
    data = bytes(rng.choice(b"ab") for _ in range(600)) + bytes(60)
    values = np.frombuffer(data, dtype=np.uint8)
    hashes, back = rolling.prefix_hashes(values), rolling.undo(len(data) + 1)
    places = np.array(rng.sample(range(600), 300))
    segment = np.sort(np.array([rng.randint(0, 5) for _ in places]))
    order = rolling.suffix_order(values, hashes, back, places, segment, S.LENGTH)
    for s in range(6):
        rows = np.flatnonzero(segment == s)
        want = sorted(rows.tolist(), key=lambda r: data[places[r] : places[r] + S.LENGTH])
        got = [data[places[r] : places[r] + S.LENGTH] for r in order[rows]]
        assert got == [data[places[r] : places[r] + S.LENGTH] for r in want]


def test_equal_hashes_of_other_bytes_are_kept_apart():
    text = b"a" * 60 + b"b" * 60
    begin, end = np.array([0, 60]), np.array([60, 120])
    assert len(set(S._classes(np.array([1, 1], dtype=np.uint64), text, begin, end).tolist())) == 2
