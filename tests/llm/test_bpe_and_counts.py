from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from storefront_analytics.llm.bpe import encode_documents, load
from storefront_analytics.llm.token_counts import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = [
    "hello", "<|endoftext|>", "<|startoftext|>", " ", "\n", "don't", "x'LL", "123", "!!!", "é", "é", "İ", "ﬁ",
    "日本", "Σ", "ΑΣ", "\x00", "\x1c", " ", "aaaaaaa", "thethe", "ing", "</w>", "<", "/w>", "🙂", "ß", " ",
    "ñ", "'s", "'", "ab" * 5, "̈", "٣", "²", "​", "Ɲ", "Ͱ", "Ᲊ", "—", "’",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_and_text_equal_the_library(library):
    encoder, decoder = load(PATH)
    rng = random.Random(9)
    for _ in range(8000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12)))
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == want, text
        assert decoder.decode(want) == library.decode(want, skip_special_tokens=False)
    for text in ("a" * 3000, "ab" * 2000, "the" * 2000, "z1" * 500):
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_hard_cases(documents, hard, library):
    rows = encode_documents(documents(hard), PATH, with_ids=True).collect()
    assert len(rows) == len(hard)
    want = sorted(((d is None, d or 0), library.encode(t or "", add_special_tokens=False).ids) for d, t in hard)
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.ids) for r in rows)
    assert got == want
    for r in rows:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
        text = library.decode(r.ids, skip_special_tokens=False) if r.ids else ""
        assert r.decoded == text and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert encode_documents(documents(hard).limit(0), PATH).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="word-end"):
        load(public_tokenizers.path("byte_bpe_50k.json"))


def _counts(frame):
    return sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_tokens, r.over_limit) for r in frame.collect())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library(documents, hard, name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(pieces.encode(t))
    else:
        tokenizer = Tokenizer.from_file(path)
        count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    want = sorted(
        ((d is None, d or 0), len((t or "").encode()), count(t or ""), count(t or "") > 2048) for d, t in hard
    )
    assert _counts(token_counts(documents(hard), path)) == want
    assert _counts(token_counts(documents(hard).limit(0), path)) == []


def test_only_misses_are_encoded(spark, documents, tmp_path):
    cache = f"file://{tmp_path}/cache"
    first = documents([(1, "one two"), (2, "one  two "), (3, "three")])
    assert [r[2] for r in _counts(token_counts(first, PATH, cache=cache))] == [2, 2, 1]
    assert spark.read.parquet(cache).count() == 2  # equal after normalising: encoded once
    # A stored count is taken as it is: nothing that is known is encoded again.
    stored = spark.read.parquet(cache).selectExpr("tokenizer", "content", "n_tokens + 100 as n_tokens")
    other = f"file://{tmp_path}/other"
    stored.write.parquet(other)
    second = documents([(1, "one two"), (4, "four five six")])
    assert [r[2] for r in _counts(token_counts(second, PATH, cache=other))] == [102, 3]
    assert spark.read.parquet(other).count() == 3
