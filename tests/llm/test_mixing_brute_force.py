"""Budgets and prefixes of the mix, recomputed document by document."""

from __future__ import annotations

import math
import re
import struct

import pytest
import xxhash

from storefront_analytics.llm.mixing import Mix, mixed


def _hash(mix, whole, doc):
    """Spark's xxhash64 of an int and two longs: each value is hashed with the hash before it as seed."""
    value = xxhash.xxh64_intdigest(struct.pack("<i", mix.seed), seed=42)
    for number in (whole, doc):
        value = xxhash.xxh64_intdigest(struct.pack("<q", number), seed=value)
    return value


def _filled(budget, children):
    """What each child (limit, weight) gets: by weight among those that are not full, as long as any is."""
    if not any(w for _, w in children):
        children = [(limit, 1.0) for limit, _ in children]
    got, open_ = [0.0] * len(children), {i for i, (_, w) in enumerate(children) if w}
    left = budget
    while open_:
        level = left / sum(children[i][1] for i in open_)
        full = {i for i in open_ if children[i][0] <= level * children[i][1]}
        if not full:
            for i in open_:
                got[i] = level * children[i][1]
            break
        for i in full:
            got[i] = children[i][0]
            left -= children[i][0]
        open_ -= full
    spare, idle = budget - sum(got), sum(limit for limit, w in children if not w)
    for i, (limit, w) in enumerate(children):
        if not w and idle and spare > 1e-9:
            got[i] = min(limit, spare * limit / idle)
    return got


def _weight(mix, level, name):
    return dict({"domain": mix.domains, "lang": mix.languages, "source": mix.sources}[level]).get(name, mix.other)


def _taken(pairs, rows, mix):
    leaves = {}
    for (doc, text), (lang, source) in zip(pairs, rows, strict=True):
        number = re.search(r"(\d{1,9})$", source or "")
        domain = mix.domains[int(number[1]) % len(mix.domains) if number else -1][0]
        leaves.setdefault((domain, lang, source), []).append((doc, len((text or "").split())))
    tokens = {leaf: sum(n for _, n in docs) for leaf, docs in leaves.items()}
    budgets = {(): sum(tokens.values()) * mix.share}
    for depth, level in enumerate(("domain", "lang", "source")):
        below = {}
        for node, budget in budgets.items():
            names = sorted({x[: depth + 1] for x in leaves if x[:depth] == node}, key=str)
            limits = [mix.epochs * sum(n for x, n in tokens.items() if x[: depth + 1] == name) for name in names]
            weights = [_weight(mix, level, name[-1]) for name in names]
            below |= dict(zip(names, _filled(budget, list(zip(limits, weights, strict=True))), strict=True))
        budgets = below
    found = {}
    for leaf, docs in leaves.items():
        whole = math.floor(budgets[leaf] / tokens[leaf] + 1e-9) if tokens[leaf] else 0
        rest, run = budgets[leaf] - whole * tokens[leaf], 0
        crossed = rest < 1e-6
        for doc, n in sorted(docs, key=lambda d: (_hash(mix, whole, d[0]), d[0])):
            run += n
            crossed |= run > rest
            found[doc] = whole + (not crossed)
    return found


MIXES = [
    Mix(share=0.8137),
    Mix(share=1.7319, epochs=2, seed=5),
    Mix(share=0.3571, epochs=1, languages=(("en", 0.0), ("de", 0.4)), sources=(("src1", 0.0), ("src2", 2.5)), seed=77),
    Mix(share=2.9137, epochs=3, other=0.0),
]


@pytest.mark.parametrize("mix", MIXES)
def test_prefix_of_every_leaf(documents, prose, mix):
    # Sizes from none to thousands of words; ids beyond 32 bits and below nought.
    pairs = [(i * 7_000_000_007 - 10**11, prose(i * i % 97 + (4000 if i % 50 == 9 else 0), i)) for i in range(400)]
    pairs[3:6] = [(3, None), (4, ""), (5, " \n\t ")]
    docs = documents(pairs)
    rows = {r.doc_id: r for r in docs.select("doc_id", "lang", "source").collect()}
    want = _taken(pairs, [(rows[d].lang, rows[d].source) for d, _ in pairs], mix)
    got = {r.doc_id: (r.copies, r.tokens) for r in mixed(docs, mix).collect()}
    assert got.keys() == want.keys()
    # A share within rounding of whole epochs may take documents without tokens once more.
    assert {d: c for d, (c, n) in got.items() if n} == {d: want[d] for d, (_, n) in got.items() if n}
