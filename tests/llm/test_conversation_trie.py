from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from storefront_analytics.llm import conversation_trie as T
from storefront_analytics.llm.centroids import split_totals

SCHEMA = "text string, depth int, turn long, conv_id long, owner string, role string, c long, size string, n_turns long"


def _expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            by.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in by.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        rebuilt[c] = base[:h] + turns[h:]
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    under = {k: [x for x in nodes if x[: len(k)] == k] for k in nodes}
    children = {k: [x for x in under[k] if len(x) == len(k) + 1] for k in nodes}
    for k, members in nodes.items():
        ends = sorted(c for c in members if len(rebuilt[c]) == len(k))
        out.append(
            (
                min(members),
                len(k),
                min(nodes[k[:-1]]) if k else None,
                len(members),
                len(children[k]),
                sum(not children[x] for x in under[k]),
                sum((len(nodes[x]) - 1) * len(x[-1][1]) for x in under[k] if x),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


@pytest.fixture
def got(spark):
    def run(rows, **options):
        table = [(text, 1, turn, conv, "o", role, 3, "s", 9) for conv, turn, role, text in rows]
        frame = spark.createDataFrame(table, SCHEMA).repartition(3)
        found = T.prefix_trie(frame, **options)
        assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        return sorted((tuple(r) for r in found.collect()), key=str)

    return run


def _random(seed, convs, deep):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(0, 2000), convs):
        hot = rng.random() < 0.4
        for t in range(rng.randint(1, deep)):
            text = "same first turn é" if hot and t == 0 else f"t{rng.randint(0, 2)}" * rng.randint(0, 2)
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant"]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [4, 20_000])
def test_tries(got, limit):
    rows = _random(1, 150, 7)
    assert got(rows, limit=limit) == _expected(rows)


def test_deep_lines_in_blocks(got, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 8)
    monkeypatch.setattr(T, "ID_BITS", 1)
    line = [(t, "user", f"turn {t}") for t in range(60)]
    rows = [(c, *turn) for c in (100, 101, 102, 7) for turn in line[: 60 - c % 7]]
    rows += [(103, t, r, x if t < 40 else x + "!") for t, r, x in line]
    assert got(rows, limit=16) == _expected(rows)


def test_hard_cases(got):
    rows = [
        (1, None, None, None),
        (1, None, None, None),  # a repeated row is a turn of its own
        (1, 0, "user", ""),
        (2, 5, "user", "x" * 300_000),
        (2, 5, "user", "a tie"),
        (None, 0, "user", "no conversation"),
        (-5, 0, "user", "négatif"),
        (-205, 1, None, "a"),
        (100, 0, "user", "head"),
        (105, 0, "user", "x"),
        (199, 0, "user", "y"),
        (400, 0, "user", "alone"),
    ]
    assert got(rows) == _expected(rows)
    assert got([]) == []
    assert got([(None, 1, "a", "b")]) == []


def test_turnless_conversations(got):
    # Without a base, a conversation not longer than its head has no turn left.
    rows = [(c, 0, "user", f"t{c}") for c in range(1, 30)]
    expected = _expected(rows)
    assert got(rows) == expected and any(r[1] == 0 and r[7] != T.NOTHING for r in expected)


def test_split_totals_of_lines_stars_and_random_trees():
    rng = random.Random(2)
    for n, pick in [(3000, lambda i: i - 1), (3000, lambda i: 0), (3000, lambda i: rng.randrange(i)), (500, lambda i: max(-1, i - 40))]:
        parents = [-1] + [pick(i) for i in range(1, n)]
        value = [rng.randint(0, 9) for _ in range(n)]
        expected = value[:]
        for i in range(n - 1, 0, -1):
            if parents[i] >= 0:
                expected[parents[i]] += expected[i]
        assert split_totals(parents, [value, value]) == [expected, expected]
