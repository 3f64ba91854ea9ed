from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from storefront_analytics.llm import bottom_k as B
from storefront_analytics.llm.components import components
from storefront_analytics.sources.scratch import store_in_buckets


def _set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _expected(pairs):
    sets = {d: _set(t) for d, t in pairs if d is not None}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted((d, len(sets[d]), find(d), find(d) == d) for d in ids)


def _got(docs):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in B.near_duplicates(docs).collect())


def _edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randint(0, 10**6)}"
    return " ".join(words)


def test_hard_cases(documents, hard):
    pairs = hard + [(30, "A b C"), (31, "a B c"), (32, "a b"), (33, "!")]
    assert _got(documents(pairs)) == _expected(pairs)


def test_chains_large_groups_and_common_passages(documents, prose):
    rng = random.Random(4)
    base, passage = prose(200, 1), prose(40, 2)
    pairs = [(i, _edited(base, rng, rng.randint(0, 9))) for i in range(60)]
    chain = prose(150, 3)
    for i in range(100, 112):  # neighbours are alike, the ends are not
        chain = _edited(chain, rng, 3)
        pairs.append((i, chain))
    # A passage that many share, in about the share of a text that sketches mistake.
    pairs += [(200 + i, passage + " " + prose(rng.randint(5, 80), 500 + i)) for i in range(80)]
    pairs += [(400 + i, prose(rng.randint(1, 30), 900 + i)) for i in range(30)]
    pairs += [(500, base), (501, base.upper()), (502, base.replace(" ", "\n"))]
    rng.shuffle(pairs)
    got = _got(documents(pairs))
    assert got == _expected(pairs)
    kept = B.keep_one_each(documents(pairs))
    assert sorted(r.doc_id for r in kept.collect()) == [d for d, _, _, k in got if k]


def _of_pool(pool, rng, parts):
    return " ".join(rng.sample(pool, parts))


@pytest.mark.parametrize("short", [4096, 30])
def test_documents_built_from_a_pool(documents, prose, monkeypatch, short):
    # All that these documents hold is shared, and most pairs are far from the threshold: lists are long and mixed.
    monkeypatch.setattr(B, "SHORT", short)
    rng = random.Random(8)
    pool = [prose(rng.randint(12, 30), 300 + i) for i in range(40)]
    pairs = [(i, _of_pool(pool, rng, rng.randint(6, 40))) for i in range(120)]
    for i in range(0, 40, 4):  # a part left out, a part doubled
        parts = [pool[k] for k in rng.sample(range(40), 25)]
        pairs += [(200 + i, " ".join(parts)), (201 + i, " ".join(parts[:-2])), (202 + i, " ".join(parts + parts[:3]))]
    expected = _expected(pairs)
    assert sum(not k for *_, k in expected) >= 10
    dealt = []
    whole = B._dealt
    monkeypatch.setattr(B, "_dealt", lambda *a: dealt.append(whole(*a)) or dealt[-1])
    assert _got(documents(pairs)) == expected
    assert (dealt[0][1] is None) == (short == 4096)


def test_two_thousand_documents(documents, prose):
    rng = random.Random(9)
    bases = [prose(rng.randint(3, 260), 700 + i) for i in range(300)]
    pairs = []
    for i in range(2000):
        base = rng.choice(bases)
        pairs.append((i, _edited(base, rng, rng.randint(0, max(1, len(base.split()) // 12)))))
    assert _got(documents(pairs)) == _expected_of_many(pairs)


def _expected_of_many(pairs):
    """As ``_expected``, comparing only documents with a common shingle."""
    sets = {d: _set(t) for d, t in pairs}
    holders, root = {}, {d: d for d in sets}
    for d, values in sets.items():
        for v in values:
            holders.setdefault(v, []).append(d)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    common = Counter((a, b) for h in holders.values() for i, a in enumerate(h) for b in h[i + 1 :])
    for (a, b), c in common.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return sorted((d, len(s), find(d), find(d) == d) for d, s in sets.items())


def test_large_sets_and_a_common_half(documents, prose):
    rng = random.Random(8)
    half = prose(700, 5)
    pairs = [(i, half + " " + prose(350, 20 + i)) for i in range(12)]
    pairs += [(50 + i, _edited(half, rng, 12)) for i in range(5)]
    assert _got(documents(pairs)) == _expected(pairs)


def test_borders_of_the_sketches(documents, prose):
    # Sizes around those of the sketches, pairs just over and just under the threshold.
    pairs = []
    for family, n in enumerate([23, 24, 25, 32, 33, 42, 43, 95, 96, 97, 128, 129, 170, 171]):
        words = prose(n + 4, 40 + family).split()
        for k, more in enumerate([n // 3 - 1, n // 3, n // 3 + 1]):
            pairs.append((10 * family + k + 1, " ".join(words) + " " + prose(more, 500 + 10 * family + k)))
        pairs.append((10 * family, " ".join(words)))
    expected = _expected(pairs)
    assert 14 <= sum(not k for *_, k in expected) < len(pairs) - 14
    assert _got(documents(pairs)) == expected


def test_second_listing_of_sets_that_its_sketch_holds(documents, prose):
    # Up to 512 shingles the second sketch is the set, and a pair may share fewer values than larger ones must.
    pairs = []
    for family, (n, replaced, added) in enumerate([(310, 0, 100), (335, 0, 50), (385, 53, 0), (330, 0, 110)]):
        rng = random.Random(family)
        words = prose(n + 4, 40 + family).split()
        own = prose(replaced + added, 60 + family).split()
        # Documents of parts of it come first in the lists and are linked to none.
        for i in range(25):
            parts = rng.sample([words[k : k + 30] for k in range(0, len(words), 30)], 7)
            text = " ".join(w for part in parts for w in part) + " " + prose(40, 1000 + 100 * family + i)
            pairs.append((100 * family + i, text))
        pairs.append((100 * family + 50, " ".join(words)))
        pairs.append((100 * family + 51, " ".join(own[:replaced] + words[replaced:] + own[replaced:])))
    expected = _expected(pairs)
    linked = {d: c for d, _, c, _ in expected}
    assert all(linked[100 * f + 51] == 100 * f + 50 for f in range(4))
    assert _got(documents(pairs)) == expected


def test_sets_don_t_move_for_pairs(spark, documents, prose, monkeypatch):
    stored = {}

    def keep(frame, name, column):
        stored[name] = store_in_buckets(frame, name, column)
        return stored[name]

    monkeypatch.setattr(B, "store_in_buckets", keep)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rng = random.Random(3)
        base = prose(120, 1)
        # Of one doc_id twice the same set by different texts.
        pairs = [(i, _edited(base, rng, 4)) for i in range(20)] + [(30, base), (30, base.upper())]
        assert _got(documents(pairs)) == _expected(pairs[:-1])
        sets = stored["near-sets"].frame
        assert sets.filter("doc_id = 30").count() == 1
        met = spark.createDataFrame([(0, 1), (0, 2)], "a long, b long")
        plan = B._with_sets(met, sets)._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        assert spark.catalog.listTables() == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_tables(documents):
    assert _got(documents([(1, "a")]).filter("doc_id < 0")) == []
    assert _got(documents([(1, None), (2, ""), (3, " ")])) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


@pytest.fixture(scope="module")
def session(spark):
    return spark


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=0, max_size=30))
def test_components(session, links):
    root = {x: x for e in links for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    frame = session.createDataFrame(links, "a long, b long")
    got = {r.doc_id: r.component_id for r in components(frame).collect()}
    assert got == {x: find(x) for e in links if e[0] != e[1] for x in e}
