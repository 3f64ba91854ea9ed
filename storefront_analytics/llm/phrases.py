"""Phrase collocations from weighted acyclic automata.

A count transducer is an acyclic automaton over the words of n-grams, read as
(lang, word, .., word), whose arcs carry how often the words up to there occur.
Tasks read their documents into shards of ``shard_words`` words, sort the
places of a shard by the words that follow, and build its transducer in that
order: a state is finished when the sorted n-grams have left it, and finished
states with equal arcs are one. Sampled n-grams cut all shards into the same
prefix ranges; of each range the shards' transducers are united, weights of
equal n-grams are summed, and what may be frequent is kept. Weights of the parts
of candidates are looked up by composing a transducer of the asked parts with
the one of the counts. Arithmetic is exact (integers of any size).

Bounds: a shard and a range are of fixed size, so ranges grow in number with
the documents; the driver sees at most ``samples`` n-grams, of which it takes
the bounds of the ranges. A shard is cut into ``most_pieces`` at most: when there
are more ranges, it is dealt to wide ones first, whose pieces are united in
bundles of a shard's size and dealt again, so pieces grow with the documents and
not with their square. A frequent word or phrase is one arc per shard, and
if its continuations fill several ranges, each holds a part of its weight and
the parts are summed.

Defined cases: null texts are empty, a null lang is ``und``; every row counts,
repeated ones and those without ``doc_id`` too; equal scores and counts are ranked
by phrase; further columns are ignored; without candidates there are no rows.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import store
from .common import map_rows

LONGEST = 5
UNKNOWN_LANG = "und"
#: Bytes of a text that are split into words at a time.
SLICE_BYTES = 1 << 20
#: Sorted n-grams that become states at a time.
BLOCK_PLACES = 1 << 16
_BORDERS = bytes.maketrans(b".,;:!?\x0b\x0c\x0d\t", b"\n" * 9 + b" ")
#: As ``_BORDERS``, and ASCII letters small.
_PLAIN = bytes(range(256)).lower().translate(_BORDERS)
DEPTH = LONGEST + 1


@dataclass(frozen=True)
class PhraseConfig:
    least: int = 100
    top: int = 2000
    scale: int = 1000
    #: Words of a shard, places of a range, n-grams from which the bounds of ranges are taken.
    shard_words: int = 1_000_000
    range_places: int = 500_000
    samples: int = 100_000
    #: Pieces that a shard, or a bundle of pieces, is cut into at most.
    most_pieces: int = 1000
    #: Frequent n-grams of a lookup task.
    lookup_rows: int = 200_000


# --- The transducer.
class Transducer:
    """Arcs of all states in one array each, states by their first arc; state 0 is the end, the last one the start.

    ``words`` are the symbols, joined by line ends.
    """

    def __init__(self, words: bytes, first, labels, weights, targets):
        self.words, self.first, self.labels, self.weights, self.targets = words, first, labels, weights, targets

    @cached_property
    def symbols(self) -> list[bytes]:
        return self.words.split(b"\n")

    @property
    def start(self) -> int:
        return len(self.first) - 2

    @classmethod
    def of_sorted(cls, symbols: list[bytes], columns: list[np.ndarray], counts: np.ndarray) -> Transducer:
        """From sorted n-grams: a column of symbol numbers per place (0: ended before) and how often each occurs."""
        if not len(counts):
            none = np.empty(0, dtype=np.int32)
            return cls(b"\n".join(symbols), np.zeros(3, dtype=np.int64), none, none, none)  # an empty start beside the end
        sizes, *arcs = next(_states(columns, counts, np.array([0, len(counts)])))
        return cls(b"\n".join(symbols), _firsts(sizes), *arcs)

    @classmethod
    def cut(cls, symbols: list[bytes], columns: list[np.ndarray], counts: np.ndarray, edges: np.ndarray) -> Iterator[Transducer]:
        """As ``of_sorted``, one transducer for what stands between two edges each, many of them built at once."""
        names, rank = np.array(symbols, dtype=object), np.zeros(len(symbols), dtype=np.int32)
        for sizes, labels, weights, targets in _states_by_block(columns, counts, edges):
            used = np.sort(labels)
            used = used[np.flatnonzero(np.diff(used, prepend=0))]
            rank[used] = np.arange(1, len(used) + 1, dtype=np.int32)
            yield cls(b"\n".join([b"", *names[used].tolist()]), _firsts(sizes), rank[labels], weights, targets)

    def expanded(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Columns and counts of the n-grams that end somewhere, sorted."""
        columns, counts = _ended(self.first, self.labels, self.weights, self.targets, np.array([self.start]))
        order = _order(columns)
        return [c[order] for c in columns], counts[order]

    def prefixes(self, least: int) -> Iterator[tuple[list[bytes], int]]:
        """Prefixes with a weight of at least ``least``; and those that other ranges may share: langs, first and last."""
        at, chosen = np.array([self.start]), [np.zeros(1, dtype=np.int64)]
        edges = np.array([[True], [True]])  # on the first and the last line
        while len(at):
            size = self.first[at + 1] - self.first[at]
            arcs = np.repeat(self.first[at] - np.cumsum(np.append(0, size[:-1])), size) + np.arange(size.sum())
            ends = np.cumsum(size)
            edges = np.repeat(edges, size, axis=1)
            outer = np.zeros_like(edges)
            outer[0, (ends - size)[size > 0]] = True
            outer[1, ends[size > 0] - 1] = True
            edges &= outer
            keep = (self.weights[arcs] >= least) | edges.any(axis=0) | (len(chosen) == 1)
            labels = [np.repeat(c, size)[keep] for c in chosen[1:]] + [self.labels[arcs][keep]]
            chosen, edges = [chosen[0], *labels], edges[:, keep]
            for row in zip(*[c.tolist() for c in labels], self.weights[arcs][keep].tolist(), strict=True):
                yield [self.symbols[i] for i in row[:-1]], row[-1]
            at = self.targets[arcs][keep]

    def packed(self) -> bytes:
        """States are numbered as arcs come to them first, so most targets are the next number: these become 0."""
        most = np.maximum.accumulate(np.concatenate((np.zeros(1, self.targets.dtype), self.targets)))
        new = most[1:] > most[:-1]
        targets = np.where(new, 0, self.targets + 1)
        arrays = [np.diff(self.first), self.labels, self.weights, targets]
        kinds = [a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0)) for a in arrays]
        head = struct.pack("<q", len(self.words)) + b"".join(struct.pack("<qc", len(a), a.dtype.char.encode()) for a in kinds)
        # Bytes of one weight stand together.
        planes = [(a >> a.dtype.type(8 * i)).astype(np.uint8).tobytes() for a in kinds for i in range(a.itemsize)]
        return zstandard.compress(head + self.words + b"".join(planes), 1)

    @classmethod
    def unpacked(cls, data: bytes) -> Transducer:
        data = zstandard.decompress(data)
        length, at, arrays = struct.unpack_from("<q", data)[0], 8, []
        shapes = []
        for _ in range(4):
            shapes.append(struct.unpack_from("<qc", data, at))
            at += 9
        words = data[at : at + length]
        at += length
        for size, kind in shapes:
            kind = np.dtype(kind.decode())
            planes = np.frombuffer(data, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
            arrays.append(np.ascontiguousarray(planes.T).view(kind).reshape(size))
            at += size * kind.itemsize
        sizes, labels, weights, targets = arrays
        new = targets == 0
        targets = np.where(new, np.cumsum(new, dtype=np.int32), targets.astype(np.int32) - 1)
        return cls(words, np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), labels.astype(np.int32), weights, targets)

    def compose(self, other: Transducer) -> Iterator[tuple[list[bytes], int]]:
        """The n-grams that end in ``other`` and are prefixes here, with their weight here: both are walked as one."""
        known = {s: i for i, s in enumerate(self.symbols)}
        names = [known.get(s, -1) for s in other.symbols]
        todo = [(self.start, other.start, [])]
        while todo:
            mine, asked, words = todo.pop()
            low, high = self.first[mine], self.first[mine + 1]
            own = self.labels[low:high]
            for arc in range(other.first[asked], other.first[asked + 1]):
                name = names[other.labels[arc]]
                place = int(np.searchsorted(own, own.dtype.type(name))) if name > 0 else len(own)
                if place == len(own) or own[place] != name:
                    continue
                here = [*words, other.symbols[other.labels[arc]]]
                following = other.targets[arc]
                inside = int(other.weights[other.first[following] : other.first[following + 1]].sum())
                if other.weights[arc] > inside:
                    yield here, int(self.weights[low + place])
                todo.append((self.targets[low + place], following, here))


def _firsts(sizes: np.ndarray) -> np.ndarray:
    """Where the arcs of each state begin; state 0 has none."""
    return np.concatenate(([0, 0], np.cumsum(sizes, dtype=np.int64)))


def _arcs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places from each of ``first`` on, ``size`` of them."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _differs(columns: list[np.ndarray]) -> np.ndarray:
    """The first column in which a sorted n-gram is another than the one before it; 0 for the first one."""
    differs = np.full(len(columns[0]), len(columns), dtype=np.int8)
    for depth in range(len(columns) - 1, -1, -1):
        differs[1:][columns[depth][1:] != columns[depth][:-1]] = depth
    differs[:1] = 0
    return differs


def _states(columns: list[np.ndarray], counts: np.ndarray, edges: np.ndarray) -> Iterator[tuple]:
    """Sizes of the states but state 0, labels, weights and targets of the arcs, for each stretch between two edges."""
    n, pieces = len(counts), len(edges) - 1
    total = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    if total[-1] < 1 << 31:
        total = total.astype(np.int32)
    differs = _differs(columns)
    differs[edges[:-1]] = 0
    piece_of = np.repeat(np.arange(pieces, dtype=np.int32), np.diff(edges))
    # Prefixes of each length: where they begin and end, and the number of the one that a place is in.
    heads, spans, inside = [], [], []
    for depth, column in enumerate(columns):
        breaks = np.flatnonzero(differs <= depth)
        own = np.flatnonzero(column[breaks])
        heads.append(breaks[own])
        spans.append(np.append(breaks, n)[own + 1])
        mark = np.zeros(n, dtype=np.int32)
        mark[heads[-1]] = 1
        inside.append(np.cumsum(mark, dtype=np.int32) - 1)
    layers, below = [], None
    states = np.ones(pieces, dtype=np.int32)  # state 0 has no arcs
    for depth in range(len(columns) - 1, -1, -1):
        head = heads[depth]
        if not len(head):
            continue
        label = columns[depth][head]
        weight = total[spans[depth]] - total[head]
        target = np.zeros(len(head), dtype=np.int32)
        if below is not None:
            owners, numbers = below
            # The state below an arc belongs to the prefix that begins where the arc does.
            target[inside[depth][owners]] = numbers
        # Arcs of one state share the prefix before them.
        groups = inside[depth - 1][head] if depth else piece_of[head]
        new = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
        size = np.diff(np.append(new, len(head)))
        piece = piece_of[head[new]]
        same, kept = _registered(new, size, label, weight, target, piece)
        size, piece = size[kept], piece[kept]
        arcs = _arcs(new[kept], size)
        # States are numbered in each stretch, in the order of their first use.
        borders = np.searchsorted(piece, np.arange(pieces + 1))
        numbers = (states - borders[:-1])[piece] + np.arange(len(kept), dtype=np.int32)
        below = (head[new], numbers[same])
        states = states + np.diff(borders).astype(np.int32)
        ends = np.concatenate(([0], np.cumsum(size)))[borders]
        layers.append((borders.tolist(), ends.tolist(), size.astype(np.int32), label[arcs], weight[arcs], target[arcs]))
    for i in range(pieces):
        yield (
            np.concatenate([size[at[i] : at[i + 1]] for at, _, size, *_ in layers]),
            *(np.concatenate([layer[k][layer[1][i] : layer[1][i + 1]] for layer in layers]) for k in (3, 4, 5)),
        )


def _states_by_block(columns: list[np.ndarray], counts: np.ndarray, edges: np.ndarray) -> Iterator[tuple]:
    """As ``_states``, for as many stretches at a time as fit a processor's cache."""
    at = 0
    while at < len(edges) - 1:
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + BLOCK_PLACES, side="right")) - 1)
        low, high = edges[at], edges[to]
        yield from _states([c[low:high] for c in columns], counts[low:high], edges[at : to + 1] - low)
        at = to


def _registered(new, size, label, weight, target, piece) -> tuple[np.ndarray, np.ndarray]:
    """For each state its place among the distinct ones of its stretch, and the first of each of these."""
    with np.errstate(over="ignore"):
        arc = label.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        arc += weight.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        arc += target.astype(np.uint64) * np.uint64(0x165667B19E3779F9)
        if len(new) < len(label):
            arc += (np.arange(len(label)) - np.repeat(new, size)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            prints = np.add.reduceat(_mixed(arc), new)
        else:
            prints = _mixed(arc)
        prints += piece.astype(np.uint64) * np.uint64(0x27D4EB2F165667C5)
    order = np.argsort(prints)
    ordered = prints[order]
    firsts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    like = np.empty(len(prints), dtype=np.int64)
    like[order] = np.repeat(np.minimum.reduceat(order, firsts), np.diff(np.append(firsts, len(order))))
    # Equal prints must be equal arcs; a state for which they are not stays on its own.
    later = np.flatnonzero(like != np.arange(len(like)))
    alike = (size[like[later]] == size[later]) & (piece[like[later]] == piece[later])
    if len(later):
        rows, own = _arcs(np.where(alike, new[like[later]], new[later]), size[later]), _arcs(new[later], size[later])
        equal = (label[rows] == label[own]) & (weight[rows] == weight[own]) & (target[rows] == target[own])
        alike &= np.logical_and.reduceat(equal, np.cumsum(size[later]) - size[later])
        odd = later[~alike]
        like[odd] = odd
    number = np.cumsum(like == np.arange(len(like))) - 1
    return number[like], np.flatnonzero(like == np.arange(len(like)))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9 | 1)
    return values ^ (values >> np.uint64(27))


def _ended(first, labels, weights, targets, at) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns and counts of the n-grams that end somewhere on the ways from the states ``at``."""
    ended: list[tuple[list[np.ndarray], np.ndarray]] = []
    chosen: list[np.ndarray] = []
    weight = None
    while len(at):
        begin = first[at]
        size = first[at + 1] - begin
        arcs = _arcs(begin, size)
        taken = weights[arcs]
        if weight is not None:
            spent = np.concatenate(([0], np.cumsum(taken, dtype=np.int64)))
            ends = np.cumsum(size)
            own = weight - (spent[ends] - spent[ends - size])
            here = np.flatnonzero(own)
            ended.append(([c[here] for c in chosen], own[here]))
        chosen = [np.repeat(c, size) for c in chosen] + [labels[arcs]]
        weight, at = taken.astype(np.int64), targets[arcs]
    columns = [
        np.concatenate([c[k] if k < len(c) else np.zeros(len(own), dtype=np.int32) for c, own in ended] or [np.empty(0, np.int32)])
        for k in range(DEPTH)
    ]
    return columns, np.concatenate([own for _, own in ended] or [np.empty(0, np.int64)])


def _order(columns: list[np.ndarray]) -> np.ndarray:
    """Sorts by all columns, as many of them in one key as fit."""
    if not len(columns[0]):
        return np.empty(0, dtype=np.int64)
    keys, wide = [], 64
    for column in columns:
        bits = int(column.max()).bit_length()
        if wide + bits > 63:
            keys.append((np.zeros(len(column), dtype=np.int64), 0))
            wide = 0
        key, wide = keys[-1][0], wide + bits
        key <<= bits
        key |= column
        keys[-1] = (key, wide)
    if len(keys) > 2:
        return np.lexsort([key for key, _ in keys][::-1])
    order = np.argsort(keys[0][0])
    if len(keys) == 2:
        # Only rows that are equal in the first key are sorted by the second.
        ordered = keys[0][0][order]
        same = ordered[1:] == ordered[:-1]
        tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
        group = np.cumsum(~np.append(False, same)[tied])
        rows, (key, bits) = order[tied], keys[1]
        if len(tied) and int(group[-1]).bit_length() + bits <= 63:
            order[tied] = rows[np.argsort(group << bits | key[rows])]
        elif len(tied):
            order[tied] = rows[np.lexsort((key[rows], group))]
    return order


# --- Shards.
def _lang_symbol(lang: str | None) -> bytes:
    return b"\0" + (UNKNOWN_LANG if lang is None else lang).encode().hex().encode()


class Shard:
    """Words of many texts, whether a border stands before each, and its lang."""

    def __init__(self, parts=(), border: bool = True):
        self.parts, self.border = list(parts), border
        self.size = sum(len(words) for words, _, _ in self.parts)

    def add(self, texts: list[tuple[bytes, bytes]]):
        """Lang and text of each, with plain borders; words end with their text."""
        data = np.frombuffer(b"".join(text for _, text in texts), dtype=np.uint8)
        border = data == 10
        inside = (data != 32) & ~border
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        begins = np.flatnonzero(begins)
        before = np.searchsorted(begins, np.flatnonzero(border))
        apart = np.zeros(len(begins) + 1, dtype=bool)
        apart[before] = True
        apart[0] |= self.border
        self.border = bool(apart[-1])
        if not len(begins):
            return
        letters = data[inside]
        offsets = np.append(np.cumsum(inside, dtype=np.int32)[begins] - 1, len(letters)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        ends = np.searchsorted(begins, np.cumsum([len(text) for _, text in texts]))
        langs = pa.array([lang for lang, _ in texts], pa.binary()).dictionary_encode()
        of = langs.indices.to_numpy()[np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))]
        self.parts.append((words, apart[:-1], pa.DictionaryArray.from_arrays(pa.array(of), langs.dictionary)))
        self.size += len(begins)

    def following(self) -> Shard:
        """The next shard, which begins with the last words, as they have to be read again with those that follow."""
        tail, missing = [], LONGEST - 1
        for words, apart, of in reversed(self.parts):
            if missing:
                tail.insert(0, (words[-missing:], apart[-missing:], of[-missing:]))
                missing -= len(tail[0][0])
        return Shard(tail, self.border)

    def places(self, along: int = 0) -> tuple[list[bytes], list[np.ndarray]]:
        """All places but the last ``along``, with the words that follow, sorted: symbols and their numbers."""
        langs = [of.dictionary for _, _, of in self.parts]
        begins = np.cumsum([0, *[len(names) for names in langs]])
        of = np.concatenate([of.indices.to_numpy() + begin for (_, _, of), begin in zip(self.parts, begins, strict=False)])
        names = pa.concat_arrays([words for words, _, _ in self.parts] + langs).dictionary_encode()
        symbols, rank = _ranked(names.dictionary)
        words = rank[names.indices.to_numpy()]
        words, langs = words[: self.size], words[self.size :]
        piece = np.cumsum(np.concatenate([apart for _, apart, _ in self.parts]), dtype=np.int32)
        n = self.size - along
        words = np.concatenate((words, np.zeros(LONGEST, dtype=np.int32)))
        piece = np.concatenate((piece, np.full(LONGEST, -1, dtype=np.int32)))
        columns = [langs[of[:n]], *[words[k : k + n] * (piece[k : k + n] == piece[:n]) for k in range(LONGEST)]]
        order = _order(columns)
        return symbols, [c[order] for c in columns]


def _ranked(names: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """The sorted symbols, after an empty one, and the number of each name among them."""
    order = pc.sort_indices(names)
    rank = np.empty(len(names), dtype=np.int32)
    rank[order.to_numpy()] = np.arange(1, len(names) + 1, dtype=np.int32)
    names = names.take(order)
    offsets, letters = np.frombuffer(names.buffers()[1], np.int32, len(names) + 1).tolist(), names.buffers()[2]
    letters = letters.to_pybytes() if letters else b""
    return [b"", *[letters[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]], rank


def _slices(text: bytes) -> Iterator[bytes]:
    """Parts of a text with plain borders that end where a word ends."""
    at = 0
    while at < len(text):
        end = at + SLICE_BYTES
        if end < len(text):
            back = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end))
            if back < at:
                ahead = [p for p in (text.find(b" ", end), text.find(b"\n", end)) if p >= 0]
                back = min(ahead, default=len(text) - 1)
            end = back + 1
        yield text[at:end]
        at = end


def _texts(rows, bytes_each: int) -> Iterator[list[tuple[bytes, bytes]]]:
    """Lang and text of rows or of their slices, some at a time; a border ends each text."""
    held, size = [], 0
    for row in rows:
        lang = _lang_symbol(row["lang"])
        for part in _slices(row["text"].translate(_PLAIN)):
            held.append((lang, part))
            size += len(part)
            if size >= bytes_each:
                yield held
                held, size = [], 0
        held.append((lang, b"\n"))
    if held:
        yield held


def shards(rows, shard_words: int) -> Iterator[tuple[Shard, int]]:
    """Shards of a task's rows, each with the number of its last words that the next one counts."""
    shard = Shard()
    for texts in _texts(rows, min(SLICE_BYTES, 6 * shard_words)):
        shard.add(texts)
        if shard.size >= shard_words:
            following = shard.following()
            yield shard, following.size
            shard = following
    if shard.size:
        yield shard, 0


def cuts(symbols: list[bytes], columns: list[np.ndarray], bounds: list[list[bytes]]) -> list[int]:
    """Where each bound stands among sorted n-grams: before the first that isn't less."""
    found = []
    for bound in bounds:
        low, high = 0, len(columns[0])
        for column, symbol in zip(columns, bound, strict=False):
            place = bisect_left(symbols, symbol)
            # A number of another type would have the whole column converted.
            rank, part = column.dtype.type(place), column[low:high]
            if place == len(symbols) or symbols[place] != symbol:
                low += int(np.searchsorted(part, rank))
                break
            low, high = low + int(np.searchsorted(part, rank)), low + int(np.searchsorted(part, rank, side="right"))
        found.append(low)
    return found


def _trimmed(columns: list[np.ndarray], counts: np.ndarray, least: int) -> list[np.ndarray]:
    """Sorted n-grams cut off where their weight falls below ``least``; those on the first and the last line stay."""
    n = len(counts)
    total = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    differs, alive, out = _differs(columns), np.ones(n, dtype=bool), []
    for depth, column in enumerate(columns):
        breaks = np.append(np.flatnonzero(differs <= depth), n)
        keep = (np.diff(total[breaks]) >= least) | (depth == 0)
        keep[:1] = keep[-1:] = True
        alive &= np.repeat(keep, np.diff(breaks))
        out.append(column * alive)
    return out


def _together(parts: list[Transducer]) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    """Symbols, columns and counts of the n-grams of all parts, sorted; all parts are walked at once."""
    letters = np.frombuffer(b"".join(p.words + b"\n" for p in parts), dtype=np.uint8)
    ends = np.flatnonzero(letters == 10)
    # An offset per symbol, without the line ends between them.
    offsets = np.concatenate(([0], ends - np.arange(len(ends)))).astype(np.int32)
    letters = letters[letters != 10]
    names = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    symbols, rank = _ranked(names.dictionary)
    symbols, rank = symbols[1:], rank[names.indices.to_numpy()] - 1  # the empty symbol is one of theirs
    lines = np.cumsum([0, *[p.words.count(b"\n") + 1 for p in parts]], dtype=np.int32)
    states = np.cumsum([0, *[len(p.first) - 1 for p in parts]])
    arcs = [len(p.labels) for p in parts]
    labels = np.concatenate([p.labels for p in parts])
    labels += np.repeat(lines[:-1], arcs)
    targets = np.concatenate([p.targets for p in parts]).astype(np.int64) + np.repeat(states[:-1], arcs)
    first = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(p.first) for p in parts]))))
    columns, counts = _ended(first, rank[labels], np.concatenate([p.weights for p in parts]), targets, states[1:] - 1)
    order = _order(columns)
    return symbols, [c[order] for c in columns], counts[order]


def united(parts: list[Transducer], least: int = 0) -> Transducer:
    """One transducer with the summed weights; n-grams that can't reach ``least`` get no states."""
    symbols, columns, counts = _together(parts)
    return Transducer.of_sorted(symbols, _trimmed(columns, counts, least) if least else columns, counts)


def dealt(symbols: list[bytes], columns: list[np.ndarray], counts: np.ndarray, bounds: list[list[bytes]]) -> Iterator[tuple[int, bytes]]:
    """Packed transducers of sorted n-grams by the number of their range."""
    edges = np.array([0, *cuts(symbols, columns, bounds), len(counts)])
    filled = np.flatnonzero(np.diff(edges))
    whole = Transducer.cut(symbols, columns, counts, np.append(edges[filled], len(counts)))
    for number, piece in zip(filled.tolist(), whole, strict=True):
        yield number, piece.packed()


# --- The operator.
def _bounds(docs: DataFrame, config: PhraseConfig) -> list[list[bytes]]:
    """Bounds of the prefix ranges, from a bounded sample of n-grams at drawn places of the texts."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, int(total // (6 * config.range_places)))
    wanted = min(config.samples, 40 * ranges)
    if ranges == 1:
        return []
    rate = wanted / total

    def draw(rows):
        for row in rows:
            text = row["text"]
            random = np.random.default_rng([len(text), zlib.crc32(text[:4096])])
            for at in random.integers(0, max(1, len(text)), random.poisson(rate * len(text))):
                window = text[at : at + 400].lower().translate(_BORDERS)
                begin = min((p for p in (window.find(b" "), window.find(b"\n")) if p >= 0), default=None)
                words = [w for w in window[begin:].lstrip(b" \n").split(b"\n")[0].split(b" ") if w] if begin is not None else []
                if words:
                    yield [_lang_symbol(row["lang"]), *words[:LONGEST]],

    drawn = map_rows(docs.select("lang", "text"), draw, "ngram array<binary>").collect()
    keys = sorted(r["ngram"] for r in drawn)
    chosen = [[bytes(w) for w in keys[len(keys) * i // ranges]] for i in range(1, ranges)] if keys else []
    return [b for i, b in enumerate(chosen) if i == 0 or b != chosen[i - 1]]


def _widths(ranges: int, most_pieces: int) -> list[int]:
    """How many ranges are one at first, and after each step of dealing: none makes more than ``most_pieces`` of one."""
    steps = 1
    while max(2, most_pieces) ** steps < ranges:
        steps += 1
    fan = next(f for f in range(1, ranges + 1) if f**steps >= ranges)
    return [fan**k for k in range(steps, -1, -1)]


def _again(deal):
    """Unites the pieces of a bundle and deals them to narrower ranges."""

    def run(table: pa.Table) -> pa.Table:
        whole = _together([Transducer.unpacked(t.as_py()) for t in table["transducer"]])
        rows = zip(*deal(table["range"][0].as_py(), *whole), strict=True)
        return pa.table([pa.array(v, t) for v, t in zip(rows, (pa.int32(), pa.int32(), pa.binary()), strict=True)], ["range", "bundle", "transducer"])

    return run


def ngram_counts(docs: DataFrame, config: PhraseConfig) -> DataFrame:
    """lang, phrase, size, f of all n-grams with f of at least ``least``; phrase '' of size 0 has the words of a lang."""
    docs = docs.select("lang", "text")
    found = _bounds(docs, config)
    bounds = docs.sparkSession.sparkContext.broadcast(found)
    shard_words, least, ranges = config.shard_words, config.least, len(found) + 1
    widths = _widths(ranges, config.most_pieces)

    def dealer(step: int, bundles: int):
        """Deals n-grams of a range of one step to the narrower ones of the next, and those to bundles."""
        wide, narrow = widths[step], widths[step + 1]

        def deal(number, symbols, columns, counts):
            low = number * wide
            inner = [bounds.value[i - 1] for i in range(low + narrow, min(low + wide, ranges), narrow)]
            for place, data in dealt(symbols, columns, counts, inner):
                yield low // narrow + place, zlib.crc32(data) % bundles, data

        return deal

    def bundles(step: int) -> int:
        """Of a range after the step: those of several ranges hold a shard's words each, one range is one bundle."""
        return max(1, -(-widths[step + 1] * config.range_places // shard_words)) if widths[step + 1] > 1 else 1

    spread = dealer(0, bundles(0))

    def fragments(rows):
        for shard, along in shards(rows, shard_words):
            symbols, columns = shard.places(along)
            if len(columns[0]):
                yield from spread(0, symbols, columns, np.ones(len(columns[0]), dtype=np.int64))

    schema = "range int, bundle int, transducer binary"
    pieces = map_rows(docs, fragments, schema)
    for step in range(1, len(widths) - 1):
        pieces = pieces.groupBy("range", "bundle").applyInArrow(_again(dealer(step, bundles(step))), schema)

    def unite(table: pa.Table) -> pa.Table:
        whole = united([Transducer.unpacked(t.as_py()) for t in table["transducer"]], least)
        out: dict[str, list] = {"lang": [], "phrase": [], "size": [], "f": []}
        for names, weight in whole.prefixes(least):
            out["lang"].append(bytes.fromhex(names[0][1:].decode()).decode("utf-8", "replace"))
            out["phrase"].append(b" ".join(names[1:]).decode("utf-8", "replace"))
            out["size"].append(len(names) - 1)
            out["f"].append(weight)
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), (pa.string(), pa.string(), pa.int32(), pa.int64()), strict=True)})

    found = pieces.drop("bundle").groupBy("range").applyInArrow(unite, "lang string, phrase string, size int, f long")
    # A prefix that several ranges hold comes in parts.
    return found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).filter((F.col("f") >= least) | (F.col("size") == 0))


def _table_transducer(table: pa.Table) -> Transducer:
    """Of lang, phrase (all of one size) and f."""
    rows = [[_lang_symbol(lang), *phrase.encode().split(b" ")] for lang, phrase in zip(table["lang"].to_pylist(), table["phrase"].to_pylist(), strict=True)]
    symbols = [b"", *sorted({s for r in rows for s in r})]
    ranks = {s: i for i, s in enumerate(symbols)}
    columns = [np.array([ranks[r[k]] if k < len(r) else 0 for r in rows], dtype=np.int64) for k in range(DEPTH)]
    order = _order(columns)
    return Transducer.of_sorted(symbols, [c[order] for c in columns], table["f"].to_numpy()[order])


def part_weights(asked: DataFrame, counts: DataFrame, groups: int) -> DataFrame:
    """lang, phrase, f of the asked phrases (lang, phrase, size), by composition with the counted ones."""
    group = F.pmod(F.xxhash64("lang", "phrase"), F.lit(groups)).alias("group")
    asked = asked.select("lang", "phrase", "size", F.lit(1).cast("long").alias("f"), group).groupBy("size", "group")
    counts = counts.filter("size > 0").select("lang", "phrase", "size", "f", group).groupBy("size", "group")

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"lang": [], "phrase": [], "f": []}
        if left.num_rows and right.num_rows:
            for names, weight in _table_transducer(right).compose(_table_transducer(left)):
                out["lang"].append(bytes.fromhex(names[0][1:].decode()).decode())
                out["phrase"].append(b" ".join(names[1:]).decode())
                out["f"].append(weight)
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), (pa.string(), pa.string(), pa.int64()), strict=True)})

    return asked.cogroup(counts).applyInArrow(look_up, "lang string, phrase string, f long")


def collocations(docs: DataFrame, config: PhraseConfig = PhraseConfig()) -> DataFrame:
    """The best phrases of each lang: lang, rank, phrase, a, l, r, n, score."""
    counted = store(ngram_counts(docs, config), "phrase-counts")
    counts = counted.frame
    words = F.split("phrase", " ")
    candidates = counts.filter((F.col("size") >= 2) & (F.col("f") >= config.least)).withColumnRenamed("f", "a")
    cut = candidates.withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))

    def side(name, begin, length):
        return F.struct(F.lit(name).alias("side"), F.array_join(F.slice(words, begin, length), " ").alias("part"), length.alias("part_size"))

    k, size = F.col("k"), F.col("size")
    sides = F.explode(F.array(side("l", F.lit(1), k), side("r", k + 1, size - k)))
    asked = cut.withColumn("s", sides).select("lang", "phrase", "size", "a", "k", "s.*")
    asked = store(asked, "phrase-parts").frame
    distinct = asked.select("lang", F.col("part").alias("phrase"), F.col("part_size").alias("size")).distinct()
    groups = max(1, -(-counted.rows // config.lookup_rows))
    weights = part_weights(distinct, counts, groups).withColumnsRenamed({"phrase": "part", "f": "part_f"})
    known = store(asked.join(weights, ["lang", "part"]), "phrase-weights").frame

    # Inside a longer candidate that is as frequent: one word longer is enough, frequencies only fall.
    inside = known.filter("part_size >= 2 and part_size = size - 1 and a >= part_f").select("lang", F.col("part").alias("phrase"))
    totals = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    split = known.groupBy("lang", "phrase", "size", "a", "k").agg(
        *[F.max(F.when(F.col("side") == s, F.col("part_f"))).alias(s) for s in "lr"]
    )
    big = {c: F.col(c).cast("decimal(19,0)") for c in "anlr"}
    split = split.join(totals, "lang").withColumns({"up": big["a"] * big["n"] * F.lit(config.scale), "down": big["l"] * big["r"]})
    split = split.withColumn("score", F.expr("up div down"))
    best = split.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    best = best.join(inside.distinct(), ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "n", "b.*")
    best = store(best, "phrase-best")
    # A lang's phrases are dealt out; the first of each deal hold the first of all.
    deals = max(1, -(-best.rows // 100_000))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    deal = F.pmod(F.xxhash64("phrase"), F.lit(deals))
    first = best.frame.withColumn("rank", F.row_number().over(W.partitionBy("lang", deal).orderBy(*order)))
    first = first.filter(F.col("rank") <= config.top)
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= config.top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
