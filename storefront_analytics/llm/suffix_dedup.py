"""Repeated passages by a hash-compared suffix sort.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a
document with a smaller id is removed.

Which suffixes must be sorted together is found first. Each window of LENGTH
bytes has one anchor, the leftmost of its grams of GRAM bytes with the least
hash; equal windows have equal anchors at equal places. Documents are kept as
compressed blocks; the anchors of a block go to hash buckets, which answer
which of them stand in another document, too. Only the stretches of windows
around such anchors move, once per distinct stretch and block. A bucket sorts
the suffixes that start at their windows: prefix polynomial hashes and binary
search give the common extension of two suffixes, so a comparison of the
mergesort takes logarithmic time, and neighbours that share LENGTH bytes are
compared byte by byte. Of equal ones, all but those of the smallest document
go. An anchor of very many blocks is dealt out by its windows instead.

A copy of a whole smaller document is removed as a whole and takes no part.

Defined cases: a null text is an empty one; texts shorter than LENGTH keep all
bytes; rows without ``doc_id`` take no part; rows repeated with one ``doc_id``
each give a row, and never remove one another; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import store
from .common import map_rows
from .rolling import common_extension, mixed, prefix_hashes, suffix_order, undo

LENGTH = 50
GRAM = 24
#: Bytes of text in a block, and documents at most.
BLOCK_BYTES = 4 << 20
BLOCK_DOCS = 20_000
#: Text bytes of the corpus per bucket; anchors in so many blocks are dealt out by window.
BUCKET_BYTES = 4 << 20
HOT_BLOCKS = 256
_CHUNK = 1 << 18


# --- blocks ---------------------------------------------------------------


def _blocks(rows):
    task, number = TaskContext.get().partitionId(), 0
    ids, sizes, digests, texts, held = [], [], [], [], 0

    def block():
        nonlocal number
        number += 1
        data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
        ends = np.cumsum(np.array(sizes, dtype=np.int64))
        packed = np.array(ids, dtype=np.int64).tobytes(), ends.tobytes(), b"".join(digests), data
        return (task << 32) + number, held, *packed

    for row in rows:
        text = row["text"]
        if ids and (held + len(text) > BLOCK_BYTES or len(ids) >= BLOCK_DOCS):
            yield block()
            ids, sizes, digests, texts, held = [], [], [], [], 0
        ids.append(row["doc_id"])
        sizes.append(len(text))
        digests.append(hashlib.sha256(text).digest())
        texts.append(text)
        held += len(text)
    if ids:
        yield block()


def _open(row) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Text, ids and ends of the documents of a block."""
    data = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, row["n_bytes"]))
    return data, np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["ends"], dtype=np.int64)


# --- anchors --------------------------------------------------------------


def _least(hashes: np.ndarray, count: int) -> np.ndarray:
    """Place of the leftmost least hash of every ``count`` neighbours."""
    values, places, size = hashes, np.arange(len(hashes), dtype=np.int32), 1
    while size < count:
        step = min(size, count - size)
        rest = len(values) - step
        less = values[step:] < values[:rest]
        places = np.where(less, places[step:], places[:rest])
        values = np.where(less, values[step:], values[:rest])
        size += step
    return places


def _gram_keys(hashes: np.ndarray, places: np.ndarray, back: np.ndarray) -> np.ndarray:
    """48 bits of the hash of the gram at each place."""
    return mixed((hashes[places + GRAM] - hashes[places]) * back[places]) >> np.uint64(16)


def stretches(data: bytes, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: first window, windows, place of the anchor in it, key, hash, document."""
    values = np.frombuffer(data, dtype=np.uint8)
    found = {name: [] for name in ("first", "count", "anchor", "key", "hash", "doc")}
    for start in range(0, len(values) - LENGTH + 1, _CHUNK):
        part = values[start : start + _CHUNK + LENGTH - 1]
        count = len(part) - LENGTH + 1
        hashes, back = prefix_hashes(part), undo(len(part) + 1)
        grams = mixed((hashes[GRAM:] - hashes[:-GRAM]) * back[: len(part) - GRAM + 1])
        anchor = _least(grams, LENGTH - GRAM + 1)
        low = np.searchsorted(ends, start, side="right")
        borders = ends[low : np.searchsorted(ends, start + count, side="left")] - start
        step = np.zeros(count, dtype=np.int32)
        np.add.at(step, borders, 1)
        doc = low + np.cumsum(step)
        inside = np.arange(count) + LENGTH + start <= ends[np.minimum(doc, len(ends) - 1)]
        same = np.zeros(count + 1, dtype=bool)
        same[1:-1] = (anchor[1:] == anchor[:-1]) & (doc[1:] == doc[:-1]) & inside[:-1]
        first = np.flatnonzero(inside & ~same[:-1])
        same[1:-1] &= inside[1:]
        last = np.flatnonzero(inside & ~same[1:])
        whole = mixed((hashes[last + LENGTH] - hashes[first]) * back[first])
        found["first"].append(first + start)
        found["count"].append(last - first + 1)
        found["anchor"].append(anchor[first] - first)
        found["key"].append(grams[anchor[first]] >> np.uint64(16))
        found["hash"].append(whole)
        found["doc"].append(doc[first])
    return {name: np.concatenate(v) if v else np.empty(0, dtype=np.int64) for name, v in found.items()}


def _block_keys(data: bytes, ends: np.ndarray, ids: np.ndarray, buckets: int):
    """The block's stretches, and its distinct keys by bucket with a bit for those of two documents."""
    runs = stretches(data, ends)
    key, owner = runs["key"].astype(np.uint64), ids[runs["doc"]]
    order = np.lexsort((key, key % np.uint64(buckets)))
    key, owner = key[order], owner[order]
    begins = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, dtype=np.int64)
    if len(key):
        several = np.minimum.reduceat(owner, begins) != np.maximum.reduceat(owner, begins)
    else:
        several = np.empty(0, dtype=bool)
    keys = key[begins]
    cuts = np.searchsorted(keys % np.uint64(buckets), np.arange(buckets + 1))
    return runs, keys, several, cuts


def _pack(keys: np.ndarray, several: np.ndarray) -> bytes:
    """Six bytes a key and a bit each."""
    return np.packbits(several).tobytes() + keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(payload: bytes, count: int) -> tuple[np.ndarray, np.ndarray]:
    head = -(-count // 8)
    wide = np.zeros((count, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(payload, dtype=np.uint8, offset=head).reshape(-1, 6)
    several = np.unpackbits(np.frombuffer(payload, dtype=np.uint8, count=head), count=count).astype(bool)
    return wide.view("<u8").ravel(), several


def _anchors(buckets: int):
    def run(rows):
        for row in rows:
            data, ids, ends = _open(row)
            _, keys, several, cuts = _block_keys(data, ends, ids, buckets)
            for bucket in np.flatnonzero(np.diff(cuts)).tolist():
                part = slice(cuts[bucket], cuts[bucket + 1])
                yield bucket, row["block_id"], int(cuts[bucket + 1] - cuts[bucket]), _pack(keys[part], several[part])

    return run


def _shared_keys(hot_blocks: int):
    def run(table: pa.Table) -> pa.Table:
        """Per block, a bit for each of its keys: in another document, too; and in very many blocks."""
        counts = table["keys"].to_pylist()
        parts = [_unpack(p, c) for p, c in zip(table["payload"].to_pylist(), counts, strict=True)]
        keys, several = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys, kind="stable")
        begins = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
        sizes = np.diff(np.concatenate((begins, [len(keys)])))
        shared, hot = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
        shared[order] = np.repeat((sizes > 1) | np.logical_or.reduceat(several[order], begins), sizes)
        hot[order] = np.repeat(sizes >= hot_blocks, sizes)
        ends = np.cumsum(counts)
        bits = [
            np.packbits(shared[e - c : e]).tobytes() + np.packbits(hot[e - c : e]).tobytes()
            for e, c in zip(ends, counts, strict=True)
        ]
        return pa.table({"block_id": table["block_id"], "bucket": table["bucket"], "bits": pa.array(bits, pa.binary())})

    return run


# --- stretches ------------------------------------------------------------


def _classes(marks: np.ndarray, text: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number per stretch, equal for equal bytes: equal hashes are verified."""
    _, first, of = np.unique(marks, return_index=True, return_inverse=True)
    named = first[of]
    following = len(marks)
    for i in np.flatnonzero(named != np.arange(len(marks))).tolist():
        j = named[i]
        if text[begin[i] : end[i]] != text[begin[j] : end[j]]:
            of[i] = following  # a collision: a class of its own, nothing is taken as equal
            following += 1
    return of


def _marks(runs: dict[str, np.ndarray]) -> np.ndarray:
    shape = runs["anchor"].astype(np.uint64) * np.uint64(64) + runs["count"].astype(np.uint64)
    return runs["hash"].astype(np.uint64) ^ mixed(shape)


def _by_window(runs: dict[str, np.ndarray], data: bytes) -> dict[str, np.ndarray]:
    """Every window as a stretch of its own, its bucket by its own bytes."""
    count = runs["count"]
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    parts = {name: np.repeat(v, count) for name, v in runs.items()}
    parts["first"] = parts["first"] + step
    parts["anchor"] = parts["anchor"] - step
    parts["count"] = np.ones(len(step), dtype=np.int64)
    if len(step):
        windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, dtype=np.uint8), LENGTH)[parts["first"]]
        powers = prefix_hashes(np.zeros(LENGTH, dtype=np.uint8))
        powers = np.diff(powers)
        parts["hash"] = mixed(((windows.astype(np.uint64) + np.uint64(1)) * powers).sum(axis=1, dtype=np.uint64))
    parts["key"] = parts["hash"].astype(np.uint64)
    return parts


def _moving(buckets: int):
    def run(rows):
        for row in rows:
            data, ids, ends = _open(row)
            runs, keys, _, cuts = _block_keys(data, ends, ids, buckets)
            shared, hot = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
            for answer in row["answers"] or ():
                bucket, bits = answer["bucket"], np.frombuffer(answer["bits"], dtype=np.uint8)
                count = cuts[bucket + 1] - cuts[bucket]
                half = -(-count // 8)
                shared[cuts[bucket] : cuts[bucket + 1]] = np.unpackbits(bits[:half], count=count)
                hot[cuts[bucket] : cuts[bucket + 1]] = np.unpackbits(bits[half:], count=count)
            copy = np.zeros(len(ids), dtype=bool)
            copy[[i for i in row["copies"] or ()]] = True
            order = np.argsort(keys, kind="stable")
            at = order[np.searchsorted(keys[order], runs["key"])] if len(keys) else np.empty(0, dtype=np.int64)
            wanted = shared[at] & ~copy[runs["doc"]] if len(keys) else np.empty(0, dtype=bool)
            plain = {n: v[wanted & ~hot[at]] for n, v in runs.items()}
            split = _by_window({n: v[wanted & hot[at]] for n, v in runs.items()}, data)
            runs = {n: np.concatenate((plain[n], split[n])) for n in runs}
            if not len(runs["first"]):
                continue
            first, count = runs["first"], runs["count"].astype(np.int64)
            owner = ids[runs["doc"]]
            of = _classes(_marks(runs), data, first, first + count + LENGTH - 1)
            smallest = np.full(of.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(smallest, of, owner)
            gone = owner > smallest[of]
            # What a smaller document of this block holds is settled here.
            yield buckets + row["block_id"] % buckets, row["block_id"], 0, _answer(first[gone], _full(count[gone]))
            bucket = (runs["key"] % np.uint64(buckets)).astype(np.int64)
            rest = np.flatnonzero(~gone)
            rest = rest[np.lexsort((first[rest], bucket[rest]))]
            cuts = np.searchsorted(bucket[rest], np.arange(buckets + 1))
            for number in np.flatnonzero(np.diff(cuts)).tolist():
                some = rest[cuts[number] : cuts[number + 1]]
                end = first[some] + count[some] + LENGTH - 1
                texts = b"".join([data[a:b] for a, b in zip(first[some], end, strict=True)])
                head = [owner[some], first[some].astype(np.int64)]
                head += [runs["anchor"][some].astype(np.int8), count[some].astype(np.uint8)]
                payload = b"".join(h.tobytes() for h in head) + texts
                yield number, row["block_id"], len(some), zstandard.ZstdCompressor(level=3).compress(payload)

    return run


def _full(count: np.ndarray) -> np.ndarray:
    return ((np.uint64(1) << count.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)


def _answer(places: np.ndarray, masks: np.ndarray) -> bytes:
    """First windows and which of the windows from there go."""
    return places.astype(np.int64).tobytes() + masks.astype(np.uint32).tobytes()


def _removed_windows(table: pa.Table) -> pa.Table:
    """Sort the suffixes of a bucket; per block, the windows that go."""
    blocks, sizes = table["block_id"].to_pylist(), table["entries"].to_pylist()
    answers, found, texts = [], {"doc": [], "first": [], "anchor": [], "count": []}, []
    for block, size, payload in zip(blocks, sizes, table["payload"].to_pylist(), strict=True):
        if not size:
            answers.append((block, payload))  # settled in the block
            continue
        raw, at = zstandard.ZstdDecompressor().decompress(payload), 0
        for name, kind in (("doc", np.int64), ("first", np.int64), ("anchor", np.int8), ("count", np.uint8)):
            found[name].append(np.frombuffer(raw, dtype=kind, count=size, offset=at).astype(np.int64))
            at += size * np.dtype(kind).itemsize
        texts.append(raw[at:])
    if texts:
        runs = {name: np.concatenate(v) for name, v in found.items()}
        masks = sort_windows(b"".join(texts), runs["doc"], runs["anchor"], runs["count"])
        end = 0
        for block, size in zip(blocks, sizes, strict=True):
            own, end = slice(end, end + size), end + size
            some = masks[own] > 0
            if some.any():
                answers.append((block, _answer(runs["first"][own][some], masks[own][some])))
    kinds = (pa.int64(), pa.binary())
    columns = list(zip(*answers, strict=True)) or [[], []]
    return pa.Table.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["block_id", "payload"]
    )


def sort_windows(text: bytes, doc: np.ndarray, anchor: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which windows of each stretch go, as bits; the stretches stand one after another in ``text``."""
    values = np.frombuffer(text, dtype=np.uint8)
    hashes, back = prefix_hashes(values), undo(len(values) + 1)
    size = count + LENGTH - 1
    end = np.cumsum(size)
    begin = end - size
    key = _gram_keys(hashes, begin + anchor, back)
    whole = mixed((hashes[end] - hashes[begin]) * back[begin])
    of = _classes(_marks({"anchor": anchor, "count": count, "hash": whole}), text, begin, end)
    classes = of.max() + 1
    smallest = np.full(classes, np.iinfo(np.int64).max)
    np.minimum.at(smallest, of, doc)
    sample = np.empty(classes, dtype=np.int64)
    sample[of] = np.arange(len(of))

    # Suffixes at the windows of distinct stretches whose anchor others have, too.
    _, group, members = np.unique(key[sample], return_inverse=True, return_counts=True)
    several = np.flatnonzero(members[group] > 1)
    masks = np.zeros(classes, dtype=np.uint32)
    if len(several):
        windows = count[sample[several]]
        step = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        stretch = np.repeat(several, windows)
        place = begin[sample[stretch]] + step
        # Equal windows have the anchor at the same distance.
        segment = group[stretch] * 256 + (anchor[sample[stretch]] - step + 128)
        order = np.argsort(segment, kind="stable")
        stretch, step, place, segment = stretch[order], step[order], place[order], segment[order]
        differs = segment[1:] != segment[:-1]
        alone = np.concatenate(([True], differs)) & np.concatenate((differs, [True]))
        stretch, step, place, segment = stretch[~alone], step[~alone], place[~alone], segment[~alone]
        if len(place):
            order = suffix_order(values, hashes, back, place, segment, LENGTH)
            stretch, step, place = stretch[order], step[order], place[order]
            shared = common_extension(hashes, back, place[:-1], place[1:], LENGTH) == LENGTH
            alike = (segment[1:] == segment[:-1]) & shared
            pairs = np.flatnonzero(alike)
            view = np.lib.stride_tricks.sliding_window_view(values, LENGTH)
            for part in np.array_split(pairs, max(1, len(pairs) >> 16)):
                alike[part] = (view[place[part]] == view[place[part + 1]]).all(axis=1)
            begins = np.flatnonzero(np.concatenate(([True], ~alike)))
            least = np.minimum.reduceat(smallest[stretch], begins)
            least = np.repeat(least, np.diff(np.concatenate((begins, [len(place)]))))
            gone = least < smallest[stretch]
            np.bitwise_or.at(masks, stretch[gone], np.uint32(1) << step[gone].astype(np.uint32))
    return np.where(doc > smallest[of], _full(count), masks[of])


# --- result ---------------------------------------------------------------


def _results(rows):
    for row in rows:
        data, ids, ends = _open(row)
        values = np.frombuffer(data, dtype=np.uint8)
        change = np.zeros(len(values) + 1, dtype=np.int32)
        for payload in row["payloads"] or ():
            count = len(payload) // 12
            places = np.frombuffer(payload, dtype=np.int64, count=count)
            masks = np.frombuffer(payload, dtype=np.uint32, offset=8 * count)
            for step in range(LENGTH - GRAM + 1):
                starts = places[(masks >> np.uint32(step)) & np.uint32(1) > 0] + step
                np.add.at(change, starts, 1)
                np.add.at(change, starts + LENGTH, -1)
        begins = np.concatenate(([0], ends[:-1]))
        for copy in row["copies"] or ():
            if ends[copy] > begins[copy]:
                change[begins[copy]] += 1
                change[ends[copy]] -= 1
        removed = np.cumsum(change[:-1]) > 0
        for doc, low, high in zip(ids.tolist(), begins.tolist(), ends.tolist(), strict=True):
            part = removed[low:high]
            if part.any():
                edges = np.flatnonzero(np.diff(np.concatenate(([0], part.view(np.int8), [0]))))
                spans = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]
                kept = values[low:high][~part].tobytes()
            else:
                spans, kept = [], data[low:high]
            flat = [x for span in spans for x in span]
            yield doc, high - low, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest(), flat


def _documents_of(rows):
    for row in rows:
        ids, ends = np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["ends"], dtype=np.int64)
        sizes = np.diff(np.concatenate(([0], ends)))
        for place, (doc, size) in enumerate(zip(ids.tolist(), sizes.tolist(), strict=True)):
            if size >= LENGTH:
                yield row["block_id"], place, doc, row["digests"][32 * place : 32 * place + 32]


def remove_repeats(docs: DataFrame, hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (starts and ends in turn, in bytes)."""
    docs = docs.select("doc_id", "text").filter("doc_id is not null")
    schema = "block_id long, n_bytes long, ids binary, ends binary, digests binary, data binary"
    blocks = store(map_rows(docs, _blocks, schema, batch_rows=1000), "suffix-blocks").frame
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(8, -(-total // BUCKET_BYTES))

    listed = map_rows(
        blocks.select("block_id", "ids", "ends", "digests"),
        _documents_of,
        "block_id long, place int, doc_id long, digest binary",
    )
    listed = store(listed, "suffix-documents").frame
    firsts = listed.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1")
    copies = listed.join(store(firsts, "suffix-firsts").frame, "digest").filter("doc_id > first_id")
    # At most the documents of a block.
    copies = store(copies.groupBy("block_id").agg(F.collect_list("place").alias("copies")), "suffix-copies").frame

    text = blocks.select("block_id", "n_bytes", "ids", "ends", "data")
    anchors = map_rows(text, _anchors(buckets), "bucket int, block_id long, keys int, payload binary")
    answers = anchors.groupBy("bucket").applyInArrow(
        _shared_keys(hot_blocks), "block_id long, bucket int, bits binary"
    )
    # A few bits per anchor of a block.
    answers = answers.groupBy("block_id").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))
    answers = store(answers.join(copies, "block_id", "full"), "suffix-answers").frame

    moving = map_rows(
        text.join(answers, "block_id"), _moving(buckets), "bucket long, block_id long, entries int, payload binary"
    )
    removed = moving.groupBy("bucket").applyInArrow(_removed_windows, "block_id long, payload binary")
    removed = removed.groupBy("block_id").agg(F.collect_list("payload").alias("payloads"))
    removed = store(removed, "suffix-removed").frame
    whole = text.join(removed, "block_id", "left").join(copies, "block_id", "left")
    return map_rows(
        whole,
        _results,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>",
    )
