"""BPE encoding by backtracking, decoding by an offset table.

The encoder finds the longest token at each place with an Aho-Corasick
automaton over the vocabulary and takes it if it is compatible with the token
before it, that is, if the merges of both, run side by side, leave the border
between them alone. If not, it tries shorter tokens, then steps back. A place
that was left once is not entered again, so the time is linear in the word.
The first chain that reaches the end is the one that merging gives.

It reads tokenizer files whose normaliser, splitting and model are those of a
word-end BPE: NFC, white space dropped, lower case, byte-level symbols, a
suffix at the end of each word. Other files are refused.

Defined cases: a null or empty text has no tokens and decodes to the empty
text; every input row gives one output row, repeated rows and rows without
``doc_id`` too; further columns are ignored. Strings of added tokens inside a
text become these tokens, as the library does by default.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache
from itertools import accumulate

import ahocorasick
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import REMEMBERED_WORDS, Remembered, map_rows

#: Letters and signs whose normal form, kind and lower case all Unicode versions agree on are the others.
USUAL = (range(0x250), range(0x2010, 0x2028), range(0x2030, 0x205F), range(0x20AC, 0x20AD))
UNUSUAL = re.compile("[^\x00-\u024f\u2010-\u2027\u2030-\u205e\u20ac]")
#: Stands for the end of a word; no byte-level symbol.
END = "\ue000"


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def usual_words(pattern: str):
    """The file's splitting pattern for usual characters, with their kinds spelled out."""
    kinds = {"L": "", "N": ""}
    usual = {chr(c) for part in USUAL for c in part}
    for sign in sorted(usual | set("".join(usual).lower())):
        kind = unicodedata.category(sign)[0]
        if kind in kinds:
            kinds[kind] += f"\\u{ord(sign):04x}"
    pattern = pattern.replace(r"\p{L}", kinds["L"]).replace(r"\p{N}", kinds["N"])
    return re.compile(pattern.replace(r"\s", r"\t-\r \x85\xa0")).findall


class Vocabulary:
    """Tokens in the order of their merges, with spines of merged parts."""

    def __init__(self, tokenizer: dict):
        model = tokenizer["model"]
        self.suffix = model["end_of_word_suffix"]
        kinds = [n["type"] for n in (tokenizer.get("normalizer") or {}).get("normalizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or not self.suffix or model["type"] != "BPE":
            raise ValueError("not a word-end BPE file")
        self.strings = {i: t for t, i in model["vocab"].items()}
        self.ids = {self._inner(t): i for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in tokenizer["added_tokens"]}
        self.strings |= {i: t for t, i in self.added.items()}
        self.split_pattern = tokenizer["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        #: token -> (rank, left, right); rank of a pair of tokens
        self.parts: dict[int, tuple[int, int, int]] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            a, b = self.ids[self._inner(left)], self.ids[self._inner(right)]
            merged = self.ids[self._inner(left + right)]
            self.parts.setdefault(merged, (rank, a, b))
            self.pairs[a, b] = rank

    def _inner(self, token: str) -> str:
        return token[: -len(self.suffix)] + END if token.endswith(self.suffix) else token


class Encoder:
    def __init__(self, vocabulary: Vocabulary, library: Tokenizer):
        self.vocabulary, self.library = vocabulary, library
        self.symbols = byte_symbols()
        self.bytes_of = {s: b for b, s in enumerate(self.symbols)}
        self.automaton = ahocorasick.Automaton()
        for token, number in vocabulary.ids.items():
            self.automaton.add_word(token, (number, len(token)))
        self.automaton.make_automaton()
        self._compatible: dict[tuple[int, int], bool] = {}
        added = "|".join(re.escape(t) for t in sorted(vocabulary.added, key=len, reverse=True))
        self.cut_added = re.compile(f"({added})").split if added else lambda text: [text]
        self.words = usual_words(vocabulary.split_pattern)

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(rank, token) of the parts at one border of a token, from one symbol to the whole."""
        found = []
        while token in self.vocabulary.parts:
            rank, *halves = self.vocabulary.parts[token]
            found.append((rank, token))
            token = halves[side]
        found.append((-1, token))
        return found[::-1]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging both tokens' symbols together gives these two tokens."""
        key = (left, right)
        if key not in self._compatible:
            if len(self._compatible) > 10 * REMEMBERED_WORDS:
                self._compatible.clear()
            self._compatible[key] = self._border_stays(left, right)
        return self._compatible[key]

    def _border_stays(self, left: int, right: int) -> bool:
        # Both borders grow as ranks go by. Parts x and y face each other from
        # the rank at which the later of them is made; they merge if their own
        # rank comes before the next merge of either (equal ranks: leftmost first).
        a, b = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        never = len(self.vocabulary.pairs)
        while True:
            next_a = a[i + 1][0] if i + 1 < len(a) else never
            next_b = b[j + 1][0] if j + 1 < len(b) else never
            rank = self.vocabulary.pairs.get((a[i][1], b[j][1]), never)
            if rank < never and rank < next_a and rank <= next_b:
                return False
            if next_a == next_b == never:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def encode_word(self, word: str) -> list[int]:
        """Tokens of one word, its bytes given as symbols."""
        text = word + END
        size = len(text)
        # Tokens not tried yet at each place, the longest last. A place is on
        # the chain at most once: when it is left, all its tokens were tried.
        waiting: list[list] = [[] for _ in range(size)]
        for end, found in self.automaton.iter(text):
            waiting[end + 1 - found[1]].append(found)
        known, compatible = self._compatible, self.compatible
        closed = set()
        chain: list[int] = []
        places: list[int] = []
        here, last = 0, -1
        while here < size:
            candidates = waiting[here]
            while candidates:
                token, length = candidates.pop()
                if here + length not in closed:
                    fits = last < 0 or known.get((last, token))
                    if fits or fits is None and compatible(last, token):
                        chain.append(token)
                        places.append(here)
                        here += length
                        last = token
                        break
            else:
                if not chain:
                    raise ValueError(f"no tokens for {word!r}")
                closed.add(here)
                chain.pop()
                here = places.pop()
                last = chain[-1] if chain else -1
        return chain

    def pieces(self, text: str):
        """Words, and ids of added tokens, in order."""
        for number, part in enumerate(self.cut_added(text)):
            if number % 2:
                yield self.vocabulary.added[part]
            elif part and not UNUSUAL.search(part):
                yield from self.words(part.lower())
            elif part:
                yield from self._unusual(part)

    def _unusual(self, text: str):
        """Words by the library's own normaliser and splitter, whose Unicode tables may be others."""
        text = self.library.normalizer.normalize_str(text)
        for word, _ in self.library.pre_tokenizer.pre_tokenize_str(text):
            yield bytes(map(self.bytes_of.__getitem__, word)).decode()

    def encode_piece(self, piece: str | int) -> list[int]:
        if isinstance(piece, int):
            return [piece]
        return self.encode_word("".join(map(self.symbols.__getitem__, piece.encode())))

    def encode(self, text: str) -> list[int]:
        return [token for piece in self.pieces(text) for token in self.encode_piece(piece)]


class Decoder:
    """All token strings in one long string; a token is a stretch of it."""

    def __init__(self, vocabulary: Vocabulary):
        strings = [vocabulary.strings.get(i, "") + " " for i in range(max(vocabulary.strings) + 1)]
        self.strings = "".join(strings)
        self.offsets = [0, *accumulate(map(len, strings))]

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by spaces: the file names no decoder."""
        strings, offsets = self.strings, self.offsets
        return "".join([strings[offsets[i] : offsets[i + 1]] for i in ids])[:-1]


@lru_cache(maxsize=4)
def load(path: str) -> tuple[Encoder, Decoder]:
    with open(path, encoding="utf-8") as file:
        vocabulary = Vocabulary(json.load(file))
    return Encoder(vocabulary, Tokenizer.from_file(path)), Decoder(vocabulary)


def encode_documents(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ``with_ids`` adds the ids and the decoded text. The tokenizer file at
    ``path`` has to be in the same place on every machine.
    """

    def run(rows):
        encoder, decoder = load(path)

        def make(piece):
            ids = encoder.encode_piece(piece)
            return len(ids), " ".join(map(str, ids)), decoder.decode(ids)

        known = Remembered(make)
        for row in rows:
            found = [known[p] for p in encoder.pieces(row["text"].decode())]
            counts, ids, strings = zip(*found, strict=True) if found else ((), (), ())
            joined, decoded = " ".join(ids), " ".join(strings)
            digests = (hashlib.sha256(s.encode()).hexdigest() for s in (joined, decoded))
            more = (list(map(int, joined.split())), decoded) if with_ids else ()
            yield row["doc_id"], sum(counts), *digests, *more

    more = ", ids array<int>, decoded string" if with_ids else ""
    return map_rows(
        docs.select("doc_id", "text"),
        run,
        f"doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string{more}",
    )
