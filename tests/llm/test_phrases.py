from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from storefront_analytics.llm import phrases as P


def _expected(pairs, config):
    """lang, rank, phrase, a, l, r, n, score of (lang, text) rows."""
    f, n = Counter(), Counter()
    for lang, text in pairs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    found = {}
    for (lang, words), a in f.items():
        if len(words) < 2 or a < config.least:
            continue
        cut = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cut.append((config.scale * a * n[lang] // (left * right), k, left, right))
        found[lang, words] = (a, min(cut))
    dropped = set()
    for (lang, words), (a, _) in found.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                part = words[i:j]
                if len(part) < len(words) and a >= f[lang, part]:
                    dropped.add((lang, part))
    out = []
    for lang in n:
        rows = [
            (-score, -a, " ".join(words).encode(), left, right)
            for (x, words), (a, (score, _, left, right)) in found.items()
            if x == lang and (x, words) not in dropped
        ]
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[: config.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.fixture
def got(spark):
    def run(pairs, config, parts=3):
        schema = "lang string, text string, size int, phrase string, f long, range string"
        frame = spark.createDataFrame([(a, b, 1, "p", 2, "r") for a, b in pairs], schema).repartition(parts)
        return sorted(tuple(r) for r in P.collocations(frame, config).collect())

    return run


def _texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "état", "日本", "\x01x", "a-b", "x" * 40]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n"]) for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.4:
            text += " new york city of the north"
        out.append((rng.choice(["en", "en", "en", "de", None, "", "und", "a\nb"]), text))
    return out


def test_small_shards_and_many_ranges(got):
    config = P.PhraseConfig(least=4, top=50, shard_words=200, range_places=60, lookup_rows=40)
    pairs = _texts(1, 150)
    expected = _expected(pairs, config)
    assert len(expected) > 150 and got(pairs, config) == expected


def test_production_sizes(got):
    pairs = _texts(2, 400)
    assert got(pairs, P.PhraseConfig()) == _expected(pairs, P.PhraseConfig())


def test_hot_phrase_over_several_ranges(got):
    # One pair before ever new words: its prefix lies in many ranges, each with a part of its weight.
    config = P.PhraseConfig(least=50, shard_words=500, range_places=40)
    pairs = [("en", " ".join(f"hot pair w{i} v{i % 7}" for i in range(d * 20, d * 20 + 20))) for d in range(60)]
    assert got(pairs, config) == _expected(pairs, config)


def test_few_pieces_of_a_shard_whatever_the_number_of_ranges(got):
    # Every shard in a piece for every range would be work that grows with the square of the documents.
    pairs = _texts(3, 150)
    for most_pieces, steps in ((4, 3), (9, 2), (1000, 1)):
        config = P.PhraseConfig(least=4, top=50, shard_words=200, range_places=100, most_pieces=most_pieces)
        assert got(pairs, config) == _expected(pairs, config)
        # 60 ranges, dealt by the most of pieces.
        widths = P._widths(60, most_pieces)
        assert len(widths) == steps + 1 and widths[0] >= 60 and widths[-1] == 1
        assert all(a <= b * most_pieces for a, b in zip(widths, widths[1:]))
    assert P._widths(1, 1000) == [1, 1]
    # At 16 times the ranges, a shard has as many pieces.
    bounds = [[b"\x00656e", f"w{i:05d}".encode()] for i in range(1, 1600)]
    rows = [{"lang": "en", "text": " ".join(f"w{i % 1600:05d}" for i in range(7, 8000, 3)).encode()}]
    [(shard, along)] = P.shards(rows, 10_000)
    symbols, columns = shard.places(along)
    made = {}
    for ranges in (100, 1600):
        widths = P._widths(ranges, 100)
        first = bounds[widths[1] - 1 : ranges - 1 : widths[1]]
        made[ranges] = dict(P.dealt(symbols, columns, np.ones(len(columns[0]), dtype=np.int64), first))
    assert len(made[1600]) <= len(made[100]) <= 100
    rebuilt = [P.Transducer.unpacked(d) for d in made[1600].values()]
    grams = [tuple(t.symbols[i] for i in row) for t in rebuilt for row in zip(*[c.tolist() for c in t.expanded()[0]])]
    assert sorted(grams) == grams == sorted({tuple(symbols[i] for i in row) for row in zip(*[c.tolist() for c in columns])})


def test_hard_cases(got, monkeypatch):
    config = P.PhraseConfig(least=3, shard_words=100)
    pairs = [(None, None), ("en", ""), ("en", " \t.\n"), ("en", "a b c a b c a b c a b"), (None, "a b! a b? a b"), ("und", "a b")]
    pairs += [("en", "a b c")] * 3 + [("de", "zu lang " * 3000)]
    assert got(pairs, config) == _expected(pairs, config)
    monkeypatch.setattr(P, "SLICE_BYTES", 50)
    rows = [{"lang": "en", "text": b"one giantwordlongerthanaslicegiantwordlongerthanaslicegiantword two. " * 9}]
    whole = [w for shard, along in P.shards(rows, 13) for w in [len(shard.places(along)[1][0])]]
    assert sum(whole) == 27 and len(whole) > 1
    assert got([], config) == [] and got([("en", None)], config) == []


def test_transducers_round_trip_unite_and_compose():
    rng = random.Random(5)
    parts, total = [], Counter()
    for _ in range(4):
        grams = Counter(tuple(rng.choice("abcd").encode() for _ in range(rng.randint(1, 6))) for _ in range(400))
        total += grams
        symbols = [b"", *sorted({s for g in grams for s in g})]
        rows = sorted([symbols.index(s) for s in g] + [0] * (6 - len(g)) + [n] for g, n in grams.items())
        table = np.array(rows, dtype=np.int64).T
        one = P.Transducer.of_sorted(symbols, list(table[:6]), table[6])
        again = P.Transducer.unpacked(one.packed())
        columns, counts = again.expanded()
        assert [list(r) for r in zip(*[c.tolist() for c in columns], counts.tolist())] == rows
        assert len(one.labels) < sum(len(g) for g in grams)  # equal states are one
        parts.append(again)
    whole = P.united(parts)
    prefixes = Counter()
    for gram, n in total.items():
        for k in range(1, len(gram) + 1):
            prefixes[gram[:k]] += n
    found = {tuple(g): n for g, n in whole.prefixes(20)}
    assert {g: n for g, n in found.items() if n >= 20} == {g: n for g, n in prefixes.items() if n >= 20 }
    assert all(prefixes[g] == n for g, n in found.items())
    trimmed = {tuple(g): n for g, n in P.united(parts, 20).prefixes(20)}
    assert {g: n for g, n in trimmed.items() if n >= 20} == {g: n for g, n in found.items() if n >= 20}
    assert trimmed.items() <= found.items()
    asked = {tuple(g): n for g, n in whole.compose(parts[0])}
    own = set()
    columns, _ = parts[0].expanded()
    for row in zip(*[c.tolist() for c in columns]):
        own.add(tuple(parts[0].symbols[i] for i in row if i))
    assert asked == {g: prefixes[g] for g in own}
