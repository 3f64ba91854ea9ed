"""Features and scores of the quality classifier, recomputed word by word."""

from __future__ import annotations

import math

import pytest

from storefront_analytics.llm.quality import AGAIN, QualityConfig, features, fit, score_documents
from storefront_analytics.llm.rolling import BASE

SMALL = QualityConfig(least_steps=2000, buckets=1 << 12)
BITS_32, BITS_64 = (1 << 32) - 1, (1 << 64) - 1


def _features(text, buckets):
    found, before = [], None
    for word in text.split():
        padded = b" " + word + b" "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if b" " in (gram if n == 1 else gram[1:-1]):
                    continue
                code = ((n << 28) + int.from_bytes(gram, "little")) * 2_654_435_761 & BITS_32
                found.append((code ^ code >> 15) % buckets)
        value = sum((byte + 1) * pow(BASE, i, 1 << 64) for i, byte in enumerate(word)) & BITS_64
        value = (value ^ value >> 29) * 0xBF58476D1CE4E5B9 & BITS_64
        found.append(((value ^ value >> 32) >> 40) % buckets)
        if word == before:
            found.append(AGAIN % buckets)
        before = word
    return found


TEXTS = ["", " \n\t", "a", "a a a", "one two\ntwo\x0bthree", "É日本 <|endoftext|> \x00 ok ok", "x" * 5000]


@pytest.mark.parametrize("text", TEXTS)
def test_features_one_by_one(text):
    data = text.encode()
    assert sorted(features(data, SMALL).tolist()) == sorted(_features(data, SMALL.buckets))


def test_scores_one_by_one(spark, documents, prose):
    texts = [prose(20 + i % 30, i) for i in range(120)]
    texts = [t if i % 4 else t.upper().replace(" ", "!! ") for i, t in enumerate(texts)]
    pairs = [*enumerate(texts), *[(1000 + i, t) for i, t in enumerate(TEXTS)], (2000, None), (2001, prose(40_000, 3))]
    docs = documents(pairs)
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(120)], "doc_id long, quality int")
    model = fit(docs, labels, SMALL)
    assert model.odds.any()
    got = {r.doc_id: (r.score, r.predicted) for r in score_documents(docs, model).collect()}
    assert len(got) == len(pairs)
    for doc, text in pairs:
        found = _features((text or "").encode(), SMALL.buckets)
        z = model.bias + sum(float(model.odds[f]) for f in found) / (len(found) + SMALL.nought)
        score = 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))
        assert got[doc][0] == pytest.approx(score, abs=1e-9)
        assert got[doc][1] == int(got[doc][0] >= 0.3)
