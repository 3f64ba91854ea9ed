"""License scans by a trained paragraph classifier, in DataFrame functions only.

Paragraphs are lines; a notice that goes on in the next lines counts for the
line where it begins. For that each line end is judged, too: as many words as a
notice may have before it and after it, up to a blank line. Such a notice is
reported if it is confirmed (see below) and the words before or after the line
end are not reported as it by themselves; of a line that begins it, an
unconfirmed judgement of its own is left out. Further lines of a notice keep
their own judgements. A multinomial logistic regression on the word 1- and
2-grams of a paragraph gives the probability of each license family and of
``other``. It is trained on the notices below, whole, in part and with words
around them, and on sentences that only talk about licenses. The least
probability that counts is calibrated: above all but a share of ``alarms`` of
the paragraphs that are not notices, each scored by a model that was fitted
without it, and at least ``floor``. Below it the paragraph is of unknown kind. A
prediction is confirmed if the paragraph holds a share of ``holds`` of the word
pairs of one of the family's notices, and all those that set it apart from alike
notices of sibling families.

Only paragraphs with a word of the learned vocabulary that is a word of a
notice and not a plain word can have a family; the others are ``other`` by the
bias alone and are not scored. All steps work inside a row, without a shuffle.

Defined cases: null or empty texts have no paragraphs; every input row gives
one output row, repeated rows and rows without ``doc_id`` too; further columns
are ignored; equal probabilities go to the family listed first.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Usual notices of license families.
NOTICES = {
    "MIT": (
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "This project is released under the Apache License 2.0.",
        "You may not use this file except in compliance with the License.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GPL, version 2 or later.",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is released under the LGPL.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This service is released under the AGPL.",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
    ),
    "MPL": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "Public domain": (
        "This work is released into the public domain.",
        "Dedicated to the public domain under CC0 1.0.",
    ),
    "Proprietary": (
        "All rights reserved.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ),
}
#: Sentences that are no notices, or notices of no known family.
OTHERS = (
    "The driver lost the license plate of the car.",
    "A fishing license is sold at the counter of the shop.",
    "He was licensed as a pilot in the spring of the year.",
    "The general said that the public has a right to know.",
    "This work is under way and will be released in version 3 of the report.",
    "The terms of the contract were released to the public.",
    "Licensed under the terms of a contract with the owner.",
    "Released under the Example Public License, version 9.",
    "This work is licensed under the Community Data License of the town.",
    "The permission to use this file is granted by the owner of the house.",
    "Copyright of the pictures is with the museum.",
    "A free copy of this text can be had at the desk.",
    "The version 2.0 of the software is out now.",
    "Creative people and common sense make a good team.",
    "The apache helicopter flew over the domain of the king.",
    "Source and binary stars are part of the same form.",
    "The commons voted with or without modification of the law.",
    "Rights of way are reserved for farm traffic.",
    "To any person in the room, the story was confidential.",
    "You may not use this door except in an emergency.",
)
#: Families whose notices differ in a word or two.
SIBLINGS = (("GPL", "LGPL", "AGPL"), ("CC-BY", "CC-BY-SA", "CC-BY-NC"))
FOLDS = 4
LONGEST = max(len(re.findall("[a-z0-9]+", n.lower())) for notices in NOTICES.values() for n in notices)
_MARK = "\x01"
PLAIN = (
    "a an and any are as at be by for from in into is it its may not of on or our that the this to was we with you your"
).split()


@dataclass(frozen=True)
class LicenseModel:
    families: tuple[str, ...]
    weights: dict[str, tuple[float, ...]]  # per gram, one weight per family, ``other`` last
    biases: tuple[float, ...]
    cut: float


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _pairs(words: Column) -> Column:
    following = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), following, lambda a, b: F.concat_ws(" ", a, b)
    )


def _grams(words: Column) -> Column:
    return F.array_distinct(F.concat(words, _pairs(words)))


def _examples(spark: SparkSession) -> DataFrame:
    """(paragraph, label, fold): notices, their parts and surroundings, and the others."""
    families = list(NOTICES)
    rows = []
    for number, family in enumerate(families):
        for notice in NOTICES[family]:
            words = notice.split()
            forms = (
                notice,
                notice.replace("icense", "icence"),
                "Copyright 2020 by the authors. " + notice,
                notice + " See the file for details.",
                " ".join(words[len(words) // 4 :]),
            )
            rows += [(form, number, None) for form in forms]
            # Too little to tell.
            rows.append((" ".join(words[: len(words) // 3]), len(families), len(rows) // 6 % FOLDS))
    for i, sentence in enumerate(OTHERS):
        rows += [(t, len(families), i % FOLDS) for t in (sentence, sentence.replace("icense", "icence"))]
    return spark.createDataFrame(rows, "paragraph string, label int, fold int").coalesce(1)  # some hundred short rows


def train(spark: SparkSession, alarms: float = 0.02, floor: float = 0.5) -> LicenseModel:
    grams = _examples(spark).select("label", "fold", _grams(_words(F.col("paragraph"))).alias("grams"))
    known = {g for row in grams.filter(F.col("label") < len(NOTICES)).collect() for g in row["grams"]}
    vocabulary = sorted(g for g in known if not set(g.split()) <= set(PLAIN))
    present = F.transform(
        F.array(*map(F.lit, vocabulary)), lambda g: F.array_contains("grams", g).cast("double")
    )
    label = F.col("label").cast("double").alias("label")
    data = grams.select(label, "fold", array_to_vector(present).alias("features"))
    learner = LogisticRegression(family="multinomial", regParam=0.002, maxIter=80, standardization=False)
    model = learner.fit(data)
    matrix = model.coefficientMatrix.toArray()
    best = []
    for fold in range(FOLDS):
        unseen = F.coalesce(F.col("fold") == fold, F.lit(False))
        scored = learner.fit(data.filter(~unseen)).transform(data.filter(unseen)).select("probability").collect()
        best += [max(row["probability"].toArray()[:-1]) for row in scored]
    best.sort()
    cut = max(floor, best[int((1 - alarms) * (len(best) - 1))])
    return LicenseModel(
        tuple(NOTICES),
        {g: tuple(float(x) for x in matrix[:, i]) for i, g in enumerate(vocabulary)},
        tuple(float(x) for x in model.interceptVector),
        float(cut),
    )


def _numbers(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _set_apart(family: str, notice: str, holds: float) -> list[str]:
    """Pairs of a notice, numbers as 0, where a sibling's notice that would be confirmed as it goes on otherwise."""

    def pairs(text):
        words = re.findall("[a-z0-9]+", re.sub("[0-9]+", "0", text.lower()))
        return set(zip(words, words[1:], strict=False))

    own, apart = pairs(notice), set()
    siblings = {f for group in SIBLINGS if family in group for f in group} - {family}
    for other in (pairs(n) for f in siblings for n in NOTICES[f]):
        if len(own & other) >= len(own) * holds:
            before, after = {a for a, _ in other}, {b for _, b in other}
            apart |= {(a, b) for a, b in own - other if a in before or b in after}
    return sorted(f"{a} {b}" for a, b in apart)


def _judgeable(docs: DataFrame, keys: list[str]) -> DataFrame:
    """doc_id, n_paragraphs, hits: the lines and the line ends with key words."""
    beyond = LONGEST - 1
    none = F.array().cast("array<string>")

    def known(words):
        return F.exists(words, lambda w: w.isin(keys))

    # A mark at the end of a line before a blank one.
    text = F.translate(F.coalesce("text", F.lit("")), _MARK, "\t")
    lines = F.split(F.regexp_replace(text, r"\n(?=[^\S\n]*\n)", f"{_MARK}\n"), "\n")
    paragraphs = F.filter(lines, lambda p: ~F.trim(p).isin("", _MARK))
    rows = docs.select("doc_id", paragraphs.alias("paragraphs"))
    numbered = F.transform(
        "paragraphs",
        lambda p, i: F.struct(i.alias("paragraph"), p.endswith(_MARK).alias("last"), _words(p).alias("words")),
    )
    worded = F.transform(
        F.filter(numbered, lambda x: F.size(x["words"]) > 0),
        lambda x: F.struct(x["paragraph"], x["last"], x["words"], known(x["words"]).alias("known")),
    )
    rows = rows.select("doc_id", F.size("paragraphs").alias("n_paragraphs"), worded.alias("lines"))

    def following(i):
        return F.slice("lines", i + 2, F.lit(beyond))

    def rest(x, i):
        stop = F.array_position(F.transform(following(i), lambda y: y["last"]), True).cast("int")
        taken = F.slice(following(i), F.lit(1), F.when(stop > 0, stop).otherwise(beyond))
        words = F.slice(F.flatten(F.transform(taken, lambda y: F.slice(y["words"], 1, beyond))), 1, beyond)
        return F.when(x["last"] | ~F.exists(following(i), lambda y: y["known"]) & ~x["known"], none).otherwise(words)

    ends = F.transform("lines", lambda x, i: F.struct(x["paragraph"], x["words"], x["known"], rest(x, i).alias("after")))
    rows = rows.select("doc_id", "n_paragraphs", ends.alias("lines"))
    near = F.filter("lines", lambda x: x["known"] | known(x["after"]))
    rows = rows.select("doc_id", "n_paragraphs", near.alias("lines"))

    def last_words(x):
        return F.slice(x["words"], F.greatest(F.size(x["words"]) - beyond + 1, F.lit(1)), F.lit(beyond))

    def entries(x):
        own = F.struct(
            x["paragraph"], F.lit(False).alias("joined"), x["words"], none.alias("before"), none.alias("after")
        )
        end = F.struct(
            x["paragraph"],
            F.lit(True).alias("joined"),
            F.concat(last_words(x), x["after"]).alias("words"),
            last_words(x).alias("before"),
            x["after"],
        )
        both = F.array(own, end)
        return F.when(F.size(x["after"]) == 0, F.slice(both, 1, 1)).when(x["known"], both).otherwise(F.slice(both, 2, 1))

    hits = F.flatten(F.transform("lines", entries))
    return rows.select("doc_id", "n_paragraphs", hits.alias("hits"))


def license_notices(docs: DataFrame, model: LicenseModel | None = None, holds: float = 0.6) -> DataFrame:
    """One row per row: doc_id, n_paragraphs, n_confirmed, n_unknown, families, found.

    ``found`` is an array of (paragraph, family, probability, confirmed) for
    paragraphs above the cut; ``n_unknown`` counts those with words of notices
    below it.
    """
    model = model or train(docs.sparkSession)
    single = {w for g in model.weights for w in g.split()} - set(PLAIN)
    hits = _judgeable(docs, sorted(single))
    grams = F.transform(
        "hits",
        lambda x: F.struct(
            x["paragraph"],
            x["joined"],
            _pairs(x["words"]).alias("pairs"),
            _grams(x["words"]).alias("grams"),
            _pairs(x["before"]).alias("before"),
            _pairs(x["after"]).alias("after"),
        ),
    )
    rows = hits.select("doc_id", "n_paragraphs", grams.alias("hits"))
    entries = [F.struct(F.lit(g).alias("key"), _numbers(w).alias("value")) for g, w in model.weights.items()]
    weights = F.map_from_entries(F.array(*entries))
    known = F.array(*map(F.lit, model.weights))

    def kept(x):
        return [x[name] for name in ("paragraph", "joined", "pairs", "before", "after")]

    def odds(x):
        found = F.transform(F.array_intersect(x["grams"], known), lambda g: F.element_at(weights, g))
        return F.aggregate(found, _numbers(model.biases), lambda a, w: F.zip_with(a, w, lambda p, q: p + q))

    logits = F.transform("hits", lambda x: F.struct(*kept(x), odds(x).alias("odds")))
    rows = rows.select("doc_id", "n_paragraphs", logits.alias("hits"))

    def shares(x):
        top = F.array_max(x["odds"])
        return F.transform(x["odds"], lambda z: F.exp(z - top))

    exps = F.transform("hits", lambda x: F.struct(*kept(x), shares(x).alias("e")))
    rows = rows.select("doc_id", "n_paragraphs", exps.alias("hits"))
    names = F.array(*map(F.lit, model.families))
    templates = F.array(
        *[
            F.array(
                *[
                    F.struct(
                        _pairs(_words(F.lit(notice))).alias("pairs"),
                        F.array(*map(F.lit, _set_apart(family, notice, holds))).cast("array<string>").alias("apart"),
                    )
                    for notice in NOTICES[family]
                ]
            )
            for family in model.families
        ]
    )

    def judged(x):
        own = F.slice(x["e"], 1, len(model.families))
        best = F.array_max(own)
        which = F.array_position(own, best).cast("int")
        total = F.aggregate(x["e"], F.lit(0.0), lambda a, v: a + v)

        def alike(pairs):
            def like(t):
                held = F.size(F.array_intersect(t["pairs"], pairs)) >= F.size(F.array_distinct(t["pairs"])) * holds
                plain = F.transform(pairs, lambda p: F.regexp_replace(p, "[0-9]+", "0"))
                return held & (F.size(F.array_except(t["apart"], plain)) == 0)

            return F.exists(F.element_at(templates, which), like)

        return F.struct(
            x["paragraph"],
            F.element_at(names, which).alias("family"),
            (best / total).alias("probability"),
            alike(x["pairs"]).alias("confirmed"),
            x["joined"],
            (x["joined"] & alike(x["before"])).alias("before"),
            (x["joined"] & alike(x["after"])).alias("after"),
        )

    def sure(x):
        return F.coalesce(x["confirmed"] & (x["probability"] >= model.cut), F.lit(False))

    def begins(x, i):
        """Is this the line's own judgement, or a notice that no line reports without its end?"""
        own, one, two = (F.get("hits", i + k) for k in (-1, 1, 2))
        own_sure = sure(own) & ~own["joined"] & (own["paragraph"] == x["paragraph"])
        told = own_sure & (x["before"] | (own["family"] == x["family"]))
        told_next = x["after"] & (sure(one) | (sure(two) & (two["paragraph"] == one["paragraph"])))
        return ~x["joined"] | (sure(x) & ~F.coalesce(told, F.lit(False)) & ~F.coalesce(told_next, F.lit(False)))

    def stays(x, i):
        after = F.get("hits", i + 1)
        replaced = after["joined"] & (after["paragraph"] == x["paragraph"])
        return x["joined"] | sure(x) | ~F.coalesce(replaced, F.lit(False))

    rows = rows.select("doc_id", "n_paragraphs", F.transform("hits", judged).alias("hits"))
    rows = rows.select("doc_id", "n_paragraphs", F.filter("hits", begins).alias("hits"))
    rows = rows.select("doc_id", "n_paragraphs", F.filter("hits", stays).alias("hits"))
    found = F.transform(
        F.filter("hits", lambda x: x["probability"] >= model.cut),
        lambda x: F.struct(x["paragraph"], x["family"], x["probability"], x["confirmed"]),
    )
    rows = rows.select("doc_id", "n_paragraphs", F.size("hits").alias("hits"), found.alias("found"))
    confirmed = F.filter("found", lambda x: x["confirmed"])
    return rows.select(
        "doc_id",
        "n_paragraphs",
        F.size(confirmed).alias("n_confirmed"),
        (F.col("hits") - F.size("found")).alias("n_unknown"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(confirmed, lambda x: x["family"]))), ",").alias("families"),
        "found",
    )
