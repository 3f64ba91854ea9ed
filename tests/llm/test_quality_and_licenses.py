from __future__ import annotations

import dataclasses
import textwrap
import zlib

import pytest

from storefront_analytics.llm import license_scan as L
from storefront_analytics.llm.quality import QualityConfig, features, fit, keep_good, quality_scores

SMALL = QualityConfig(least_steps=2000, buckets=1 << 12)


@pytest.fixture
def labelled(spark, documents, prose):
    def build():
        pairs, labels = [], []
        for i in range(160):
            good = i % 4 > 0
            text = prose(20 + i % 30, i)
            pairs.append((i, text if good else text.upper().replace(" ", "!! ")))
            labels.append((int(good), i, 0))
        labels += [(None, 1, 0), (7, 2, 0), (1, None, 0), (1, 5, 0)]
        return pairs, spark.createDataFrame(labels, "quality int, doc_id long, toxic int")

    return build


def test_held_out_labels_are_learned_by_kind(documents, labelled):
    pairs, labels = labelled()
    rows = quality_scores(documents(pairs), labels, SMALL).collect()
    assert len(rows) == len(pairs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 4 > 0) for r in held) >= 0.95 * len(held)


def test_held_out_labels_are_not_used(spark, documents, labelled):
    pairs, labels = labelled()
    held = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"
    flipped = labels.selectExpr(f"if({held}, 1 - quality, quality) as quality", "doc_id", "toxic")
    docs = documents(pairs)
    scores = [{r.doc_id: r.score for r in quality_scores(docs, x, SMALL).collect()} for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_hard_cases(spark, documents, hard, labelled):
    pairs, labels = labelled()
    docs = documents([*pairs, *[(d if d is None else 1000 + d, t) for d, t in hard]])
    rows = quality_scores(docs, labels, SMALL).collect()
    assert len(rows) == len(pairs) + len(hard)
    empty = {r.score for r in rows if r.doc_id in (1003, 1004, 1005)}
    assert len(empty) == 1
    kept = keep_good(docs, labels, SMALL)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)
    # No labels, one kind of labels, no documents.
    assert {r.score for r in quality_scores(docs, labels.limit(0), SMALL).collect()} == {0.5}
    one = quality_scores(docs, labels.filter("quality = 1"), SMALL).collect()
    assert all(r.predicted == 1 for r in one)
    assert quality_scores(docs.limit(0), labels, SMALL).count() == 0


def test_the_sample_is_bounded(documents, labelled):
    pairs, labels = labelled()
    few = QualityConfig(epochs=1, least_steps=1, buckets=1 << 12, max_rows=10)
    assert fit(documents(pairs), labels, few).odds.any()
    assert len(features(b"ab ab", SMALL)) == 4 + 6 + 4 + 2 + 1  # 1- to 3-grams, words, one repeat


@pytest.fixture(scope="module")
def model(spark):
    return L.train(spark)


CASES = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "Released under the MIT License.": "MIT",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "Licensed under CC BY 4.0.": "CC-BY",
    "Licensed under the Apache License, Version 2.0.": "Apache",
    "LICENSED UNDER THE MOZILLA PUBLIC LICENSE, VERSION 2.0": "MPL",
    "All rights reserved.": "Proprietary",
    "The fishing license was sold by the driver.": "",
    "token river glass": "",
}


def test_families(documents, model):
    pairs = [(i, f"first line\n{text}\nlast line") for i, text in enumerate(CASES)]
    rows = {r.doc_id: r for r in L.license_notices(documents(pairs), model).collect()}
    for i, family in enumerate(CASES.values()):
        assert rows[i].families == family, rows[i]
        assert rows[i].n_paragraphs == 3 and rows[i].n_confirmed == (family != "")
        assert [x.paragraph for x in rows[i].found if x.confirmed] == ([1] if family else [])


HEADER = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the authors of the program."
)
WRAPPED = {
    "\n".join(textwrap.wrap(HEADER, 70)): "GPL",
    "intro words\n" + "\n".join(textwrap.wrap(HEADER, 60, initial_indent="# ", subsequent_indent="# ")): "GPL",
    "\r\n".join(textwrap.wrap(HEADER, 66)) + "\r\n\r\ntail": "GPL",
    "\n".join(f"// {w}\n//" for w in L.NOTICES["GPL"][2].split()): "GPL",
    "\n".join(textwrap.wrap("token river glass. " * 4 + L.NOTICES["MIT"][2], 80)): "MIT",
    "\n".join(textwrap.wrap("token " * 11 + L.NOTICES["Apache"][0], 80)): "Apache",
    "All rights\nreserved.": "Proprietary",
    "All rights\n \t\nreserved.": "",
    "All rights\r\n\r\nreserved.": "",
    "Released under the MIT\nLicense. Licensed under the Apache License,\nVersion 2.0.": "Apache,MIT",
}


def test_notices_wrapped_over_lines(documents, model):
    rows = {r.doc_id: r for r in L.license_notices(documents(list(enumerate(WRAPPED))), model).collect()}
    for i, (text, families) in enumerate(WRAPPED.items()):
        assert rows[i].families == families, (text, rows[i])
        assert rows[i].n_confirmed == len([f for f in families.split(",") if f]), (text, rows[i])
        assert rows[i].n_paragraphs == sum(line.strip(" ") != "" for line in text.split("\n"))


SIBLINGS = {
    "Licensed under CC BY-ND 4.0.": "",
    "Licensed under CC BY-NC-ND 4.0.": "",
    "Licensed under CC BY-NC-SA 4.0.": "",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY",
    "Licensed under the GNU General Public License, version 2.": "GPL",
    "Licensed under the GNU Lesser General Public License, version 2.1.": "LGPL",
}


def test_unlisted_siblings_are_not_confirmed(documents, model):
    rows = {r.doc_id: r for r in L.license_notices(documents(list(enumerate(SIBLINGS))), model).collect()}
    for i, (text, families) in enumerate(SIBLINGS.items()):
        assert rows[i].families == families, (text, rows[i])


def test_the_cut_is_measured_on_unseen_examples(spark):
    model = L.train(spark, alarms=0.0, floor=0.0)
    others = L._examples(spark).filter(f"label = {len(L.NOTICES)}").selectExpr("1L as doc_id", "paragraph as text")
    seen = L.license_notices(others, dataclasses.replace(model, cut=0.0)).collect()
    assert model.cut > max(x.probability for r in seen for x in r.found) + 0.01


def test_licenses_in_hard_cases(documents, hard, model):
    frame = L.license_notices(documents(hard), model)
    assert frame.count() == len(hard)
    assert all(r.families == "" for r in frame.collect())
    assert L.license_notices(documents(hard).limit(0), model).count() == 0
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.split("LogicalRDD")[0][:500]
