"""Exact duplicates by composable polynomial fingerprints.

A text is cut into chunks. Each chunk gets a polynomial hash modulo two primes;
the hash of a text is the sum of its chunk hashes, each shifted by the bytes
that follow it (``h(xy) = h(x) * base^len(y) + h(y)``), so chunks of a huge
text can be hashed anywhere and combined by an aggregate. Texts with equal
fingerprints are then compared chunk by chunk with the first of them, and
those that differ are grouped anew until no doubt is left.

Defined cases: a null text is an empty one. Rows without ``doc_id`` take no
part. Rows repeated with one ``doc_id`` count as one document; if their texts
differ, the one with the smallest SHA-256 counts. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import store
from .common import SPACE, map_rows, one_row_each

CHUNK_BYTES = 1 << 16
#: Members of a group that meet one copy of its first text.
MEMBERS_PER_COPY = 256
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_664_525_013)


def collapse_space(text: bytes) -> bytes:
    """Every run of ASCII white space as one space."""
    if not text:
        return text
    words = text.split()
    if not words:
        return b" "
    body = b" ".join(words)
    # split() knows exactly the six bytes of the pattern.
    return (b" " if text[:1].isspace() else b"") + body + (b" " if text[-1:].isspace() else b"")


@lru_cache(maxsize=2)
def _powers(which: int) -> np.ndarray:
    """base^(CHUNK_BYTES-1) ... base^0 modulo the prime."""
    base, prime = BASES[which], PRIMES[which]
    powers = np.ones(1, dtype=np.uint64)
    while len(powers) < CHUNK_BYTES:
        shift = np.uint64(pow(base, len(powers), prime))
        powers = np.concatenate([powers, powers * shift % np.uint64(prime)])
    return np.ascontiguousarray(powers[:CHUNK_BYTES][::-1])


def chunk_hash(chunk: bytes) -> tuple[int, int]:
    values = np.frombuffer(chunk, dtype=np.uint8).astype(np.uint64)
    # 2^16 products below 2^39 stay below 2^55.
    return tuple(int(values @ _powers(i)[CHUNK_BYTES - len(values) :]) % PRIMES[i] for i in (0, 1))


def combine(left: tuple[int, int], right: tuple[int, int], right_bytes: int) -> tuple[int, int]:
    """Fingerprint of a concatenation."""
    return tuple((left[i] * pow(BASES[i], right_bytes, PRIMES[i]) + right[i]) % PRIMES[i] for i in (0, 1))


def _chunks(text: bytes) -> list[bytes]:
    return [text[i : i + CHUNK_BYTES] for i in range(0, max(1, len(text)), CHUNK_BYTES)]


def _hashed(rows):
    for row in rows:
        text = collapse_space(row["text"])
        digest = hashlib.sha256(text).hexdigest()
        left = len(text)
        for number, chunk in enumerate(_chunks(text)):
            left -= len(chunk)
            a, b = chunk_hash(chunk)
            yield (row["doc_id"], digest, number, len(text), a, b, *(pow(BASES[i], left, PRIMES[i]) for i in (0, 1)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, text_sha256, n_bytes, fp_a, fp_b."""
    chunks = map_rows(
        docs.select("doc_id", "text").filter("doc_id is not null"),
        _hashed,
        "doc_id long, text_sha256 string, chunk int, n_bytes long, a long, b long, shift_a long, shift_b long",
    )
    shifted = [
        F.pmod(F.sum(F.pmod(F.col(c) * F.col(f"shift_{c}"), F.lit(p))), F.lit(p)).alias(f"fp_{c}")
        for c, p in zip("ab", PRIMES, strict=True)
    ]
    # One exchange by document serves all three steps.
    whole = (
        chunks.repartition("doc_id")
        .dropDuplicates(["doc_id", "text_sha256", "chunk"])
        .groupBy("doc_id", "text_sha256", "n_bytes")
        .agg(*shifted)
    )
    one = whole.groupBy("doc_id").agg(F.min(F.struct("text_sha256", "n_bytes", "fp_a", "fp_b")).alias("d"))
    return one.select("doc_id", "d.*")


def _cut(rows):
    for row in rows:
        text = collapse_space(row["text"])
        if hashlib.sha256(text).hexdigest() == row["text_sha256"]:
            for number, chunk in enumerate(_chunks(text)):
                yield row["doc_id"], row["first_id"], row["copies"], row["copy"], number, chunk


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    prints = store(fingerprints(docs), "dedup-prints").frame
    key = ["n_bytes", "fp_a", "fp_b"]
    pending, settled = prints, None
    while True:
        groups = store(
            pending.groupBy(*key)
            .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("members"))
            .filter("members > 1"),
            "dedup-groups",
        ).frame
        copies = F.ceil(F.col("members") / MEMBERS_PER_COPY).cast("int")
        members = (
            pending.join(groups, key)
            .withColumn("copies", copies)
            .select("doc_id", "text_sha256", "first_id", "copies", F.pmod(F.xxhash64("doc_id"), "copies").alias("copy"))
        )
        chunks = store(
            map_rows(
                docs.select("doc_id", "text").join(members, "doc_id"),
                _cut,
                "doc_id long, first_id long, copies int, copy long, chunk int, bytes binary",
            ),
            "dedup-chunks",
        ).frame
        place = ["first_id", "copy", "chunk"]
        firsts = (
            chunks.filter("doc_id = first_id")
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies").cast("long") - 1)))
            .select(*place, F.col("bytes").alias("first_bytes"))
        )
        compared = (
            chunks.filter("doc_id <> first_id")
            .join(firsts, place, "left")
            .groupBy("doc_id", "first_id")
            .agg(F.min(F.coalesce(F.col("bytes") == F.col("first_bytes"), F.lit(False)).cast("int")).alias("same"))
        )
        compared = store(compared, "dedup-compared").frame
        equal = compared.filter("same = 1").select("doc_id", F.col("first_id").alias("keep_id"))
        settled = equal if settled is None else settled.unionByName(equal)
        unlike = compared.filter("same = 0").select("doc_id")
        if unlike.isEmpty():
            break
        # Fingerprints that collided: the rest meet a first text of their own.
        pending = store(prints.join(unlike, "doc_id", "left_semi"), "dedup-pending").frame
    kept = prints.select("doc_id", "text_sha256").join(settled, "doc_id", "left")
    kept = kept.withColumn("keep_id", F.coalesce("keep_id", "doc_id"))
    sizes = store(settled.groupBy("keep_id").agg((F.count("*") + 1).alias("group_size")), "dedup-sizes").frame
    return kept.join(sizes, "keep_id", "left").select(
        "doc_id",
        "keep_id",
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("doc_id") == F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; of its rows with the text that counts, one stays."""
    kept = exact_groups(docs).filter("kept").select("doc_id", "text_sha256")
    normal = F.regexp_replace(F.coalesce(docs["text"], F.lit("")), SPACE, " ")
    same = (docs["doc_id"] == kept["doc_id"]) & (F.sha2(normal, 256) == kept["text_sha256"])
    return one_row_each(docs.join(kept, same, "left_semi"))
