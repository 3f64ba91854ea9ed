from __future__ import annotations

import random

import pytest

# Names that the operators use inside, too.
SCHEMA = (
    "text string, score double, doc_id long, value string, kept boolean, lang string, source string, "
    "n_chars long, first_id long, copy int, block_id long, n_tokens string, copies int, row string, id long"
)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with further columns of clashing names."""

    def build(pairs):
        rows = [
            (text, 0.5, doc, "v", True, ["en", None, "de"][i % 3], [f"src{i % 4}", None][i % 5 == 4], 1, 7, 1, 1, "n", 2, "r", 5)
            for i, (doc, text) in enumerate(pairs)
        ]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return build


WORDS = "the of and to in is it on that with reed token stone cloud river paper glass wind north field".split()


@pytest.fixture
def prose():
    def build(n, seed):
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))

    return build


@pytest.fixture
def hard(prose):
    """Nulls, empty, blank, very long and repeated texts, repeated rows, no id."""
    long = prose(60_000, 1)
    return [
        (1, "a b\t\n c  d"),
        (2, "a b c d"),
        (3, None),
        (4, ""),
        (5, " \t\n"),
        (6, " "),
        (7, long),
        (8, long.replace(" ", "\n", 5)),
        (9, long + " tail"),
        (9, long + " tail"),
        (10, "a b c d "),
        (11, "É日本 <|endoftext|> \x00 ok"),
        (None, "a b c d"),
        (12, "solo"),
    ]
