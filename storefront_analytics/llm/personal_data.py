"""Personal data by weak supervision.

Wide expressions propose spans. Labelers of three sorts (forms, gazetteers,
words around the span) each vote for, against or not at all. The votes of all
documents are counted by pattern; expectation-maximisation estimates from the
counts, without any label, how reliable each labeler is and how likely each
pattern is personal data. A logistic span classifier is trained on these
estimates, on votes and shape of a span, and decides which proposals are added
to the base spans. Base spans (email, ip, card, phone) follow fixed expressions
and always stay.

Bounds: what reaches the driver is one row per pattern, that is per kind, votes
and shape, whatever the number of documents. Every expression has bounded
repeats or is anchored at a sign it can't cross, so a text is read in linear
time.

Defined cases: a null text is an empty one and has no spans; every input row
gives one output row, repeated rows and rows without ``doc_id`` too. Offsets
count code points; further columns are ignored. Without documents the model is
its priors.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

# Kinds that have to be reported, in their order.
BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds that the classifier may add, in their order after the base ones.
MORE_KINDS = ("spelled_email", "local_phone", "social_number", "iban", "birth_date", "name")
KINDS = BASE_KINDS + MORE_KINDS
_RANK = {kind: i for i, kind in enumerate(KINDS)}

_LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Runs of digits begin where no digit stands before them: a start inside a run fails as the run did.
_IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9]){12,}+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(rb"[^0-9]+")

_WIDE = {
    "spelled_email": re.compile(
        rb"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}"
        rb"(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]{1,63}){1,4}"
    ),
    "local_phone": re.compile(
        rb"(?<![0-9+.(-])\(?[0-9]{2,4}\)?[\x20./-][0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9.-]?[0-9])"
    ),
    "social_number": re.compile(rb"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])"),
    "iban": re.compile(rb"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "birth_date": re.compile(rb"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![0-9/-])"),
    "name": re.compile(rb"(?<![A-Za-z])[A-Z][a-z]{1,20}\x20[A-Z][a-z]{1,20}(?![A-Za-z])"),
}

# Gazetteers and words around a span: common knowledge, lower case.
_FIRST_NAMES = frozenset(
    b"james mary john patricia robert jennifer michael linda david elizabeth william barbara richard susan joseph "
    b"jessica thomas sarah karen lisa daniel nancy anna peter paul laura maria jose juan carlos ana luis carmen "
    b"sofia pablo elena jean pierre marie jacques claire louis camille julie nicolas hans klaus ursula jurgen "
    b"sabine stefan heike petra andreas monika alice bob emma olivia noah lucas mia leon felix".split()
)
_NO_NAMES = frozenset(
    b"the this that these those new old united north south east west general january february march april may june "
    b"july august september october november december monday tuesday wednesday thursday friday saturday sunday "
    b"high supreme street road university company limited public license section chapter figure table".split()
)
_TOP_DOMAINS = frozenset(b"com org net edu gov info io de fr es uk eu us ca au ch at it nl be".split())
_IBAN_LENGTHS = {b"DE": 22, b"FR": 27, b"ES": 24, b"GB": 22, b"IT": 27, b"NL": 18, b"BE": 16, b"AT": 20, b"CH": 21}
_CUES = {
    "email": b"mail e-mail contact write courriel correo",
    "ip": b"ip host server address client peer",
    "card": b"card visa mastercard credit karte carte tarjeta",
    "phone": b"phone tel telephone call mobile fax cell telefon",
    "spelled_email": b"mail e-mail contact write reach courriel correo",
    "local_phone": b"phone tel telephone call mobile fax cell telefon",
    "social_number": b"ssn social security number",
    "iban": b"iban account bank konto compte cuenta",
    "birth_date": b"born birth birthday dob geboren naissance nacido nacida",
    "name": b"name named dear mr mrs ms dr contact signed regards herr frau senor senora monsieur madame",
}
_CUES = {kind: frozenset(words.split()) for kind, words in _CUES.items()}
_COUNTER_CUES = frozenset(
    b"version release isbn issn order invoice figure fig page section part item sku serial build price total".split()
)
_WORD = re.compile(rb"[A-Za-z][A-Za-z-]*")
BEFORE, AFTER = 40, 24


def _emails(text: bytes) -> list[tuple[int, int]]:
    found, after, low = [], 0, 0
    at = text.find(b"@")
    while at >= 0:
        part = text[max(after, low) : at]
        length = len(part) - len(part.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if length else None
        if domain:
            after = domain.end()
            found.append((at - length, after))
        low = at + 1
        at = text.find(b"@", low)
    return found


def _luhn(digits: bytes) -> bool:
    values = [d - 48 for d in reversed(digits)]
    doubled = (2 * v - 9 * (v > 4) for v in values[1::2])
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def _is_ip(span: bytes) -> bool:
    parts = [p.lstrip(b"0") for p in span.split(b".")]
    return all(len(p) < 3 or (len(p) == 3 and p <= b"255") for p in parts)


def base_spans(text: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes by kind, then start."""
    found = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if _is_ip(m[0])]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub(b"", m[0])
        if len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    if b"+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub(b"", m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


# --- Labelers: 1 for personal data, -1 against it, 0 no vote. Each gets a proposal.
@dataclass(frozen=True)
class Proposal:
    kind: str
    span: bytes
    before: frozenset[bytes]
    digit_share: float
    near_base: bool

    @property
    def digits(self) -> bytes:
        return _NOT_DIGIT.sub(b"", self.span)


def _form(p: Proposal) -> int:
    """The checks that a form carries in itself."""
    if p.kind == "social_number":
        area, group, serial = p.span.split(b"-")
        return 1 if area not in (b"000", b"666") and area < b"900" and group != b"00" and serial != b"0000" else -1
    if p.kind == "iban":
        whole = p.span.replace(b" ", b"")
        number = "".join(str(int(chr(c), 36)) for c in whole[4:] + whole[:4])
        return 1 if int(number) % 97 == 1 else -1
    if p.kind == "birth_date":
        parts = sorted(map(int, re.split(rb"[./-]", p.span)))
        return 1 if 1900 <= parts[2] <= 2025 and 1 <= parts[0] <= 12 and 1 <= parts[1] <= 31 else -1
    if p.kind == "local_phone":
        return 1 if len(p.digits) in (9, 10, 11) else -1
    if p.kind == "name":
        return 0
    return 1


def _varied_digits(p: Proposal) -> int:
    """Numbers that people make up repeat few digits."""
    digits = p.digits
    if len(digits) < 7:
        return 0
    return -1 if len(set(digits)) <= 2 else 1


def _gazetteer(p: Proposal) -> int:
    if p.kind == "name":
        words = p.span.lower().split()
        if words[0] in _FIRST_NAMES:
            return 1
        return -1 if any(w in _NO_NAMES for w in words) else 0
    if p.kind == "iban":
        length = _IBAN_LENGTHS.get(p.span[:2])
        return 0 if length is None else 1 if length == len(p.span.replace(b" ", b"")) else -1
    if p.kind in ("email", "spelled_email"):
        return 1 if _WORD.findall(p.span.lower())[-1:] and _WORD.findall(p.span.lower())[-1] in _TOP_DOMAINS else 0
    return 0


def _cue(p: Proposal) -> int:
    return 1 if not p.before.isdisjoint(_CUES[p.kind]) else 0


def _counter_cue(p: Proposal) -> int:
    return -1 if not p.before.isdisjoint(_COUNTER_CUES) else 0


def _other_cue(p: Proposal) -> int:
    """A word that announces another kind."""
    return -1 if any(not p.before.isdisjoint(w) for k, w in _CUES.items() if not w & _CUES[p.kind]) else 0


def _among_numbers(p: Proposal) -> int:
    return -1 if p.digit_share > 0.4 else 0


def _company(p: Proposal) -> int:
    """Personal data seldom come alone."""
    return 1 if p.near_base else 0


LABELERS = (_form, _varied_digits, _gazetteer, _cue, _counter_cue, _other_cue, _among_numbers, _company)
SHAPES = 4


def _shape(p: Proposal) -> int:
    """Short or long, one part or several."""
    return 2 * (len(p.span) > 14) + (b" " in p.span)


def proposals(text: bytes, base: list[tuple[str, int, int]]):
    """(kind, start, end, pattern) of all base spans and wide proposals; a pattern is (kind, votes, shape)."""
    found = base + [(kind, *m.span()) for kind, rule in _WIDE.items() for m in rule.finditer(text)]
    if not found:
        return
    starts = sorted(a for _, a, _ in base)
    for kind, a, b in found:
        before, after = text[max(0, a - BEFORE) : a], text[b : b + AFTER]
        around = before + after
        digits = len(around) - len(around.translate(None, b"0123456789"))
        place = bisect_left(starts, a)
        near = any(s != a and -80 <= s - a <= 80 for s in starts[max(0, place - 1) : place + 2])
        p = Proposal(kind, text[a:b], frozenset(_WORD.findall(before.lower())), digits / max(1, len(around)), near)
        yield kind, a, b, (kind, tuple(labeler(p) for labeler in LABELERS), _shape(p))


# --- The label model and the span classifier, from counts per pattern.
@dataclass(frozen=True)
class VoteModel:
    """``reliability[labeler][truth][vote + 1]``, the share of personal data per kind, the classifier's weights."""

    reliability: np.ndarray
    share: np.ndarray
    weights: np.ndarray

    def probability(self, pattern) -> float:
        return float(1 / (1 + np.exp(-np.clip(_features([pattern]) @ self.weights, -40, 40)))[0])


#: Votes expected of a labeler before any are seen: it abstains a lot, and is right more often than wrong.
PRIOR = np.array([[0.30, 0.55, 0.15], [0.08, 0.42, 0.50]])
PRIOR_VOTES = 30.0


def _estimate(votes, kinds, counts, rounds=60):
    """Expectation-maximisation: reliabilities, shares and the probability of each pattern."""
    m = len(LABELERS)
    reliability = np.repeat(PRIOR[None], m, axis=0)
    share = np.full(len(KINDS), 0.5)
    truth = np.zeros(len(votes))
    for _ in range(rounds):
        logs = np.log(reliability)
        yes, no = np.log(share[kinds]), np.log(1 - share[kinds])
        for j in range(m):
            yes = yes + logs[j, 1, votes[:, j] + 1]
            no = no + logs[j, 0, votes[:, j] + 1]
        truth = 1 / (1 + np.exp(np.clip(no - yes, -40, 40)))
        for y, part in ((1, truth), (0, 1 - truth)):
            for j in range(m):
                seen = np.bincount(votes[:, j] + 1, weights=part * counts, minlength=3)
                reliability[j, y] = (seen + PRIOR_VOTES * PRIOR[y]) / (seen.sum() + PRIOR_VOTES)
        found = np.bincount(kinds, weights=truth * counts, minlength=len(KINDS))
        share = (found + 5) / (np.bincount(kinds, weights=counts, minlength=len(KINDS)) + 10)
    return reliability, share, truth


def _features(patterns) -> np.ndarray:
    """Bias, kind, one-hot votes, shape."""
    m = len(LABELERS)
    rows = np.zeros((len(patterns), 1 + len(KINDS) + 3 * m + SHAPES))
    for i, (kind, votes, shape) in enumerate(patterns):
        rows[i, 0] = 1
        rows[i, 1 + _RANK[kind]] = 1
        for j, vote in enumerate(votes):
            rows[i, 1 + len(KINDS) + 3 * j + vote + 1] = 1
        rows[i, 1 + len(KINDS) + 3 * m + shape] = 1
    return rows


def train(counts: dict[tuple, int], steps: int = 600, rate: float = 1.0, decay: float = 1e-4) -> VoteModel:
    """From the number of proposals per pattern (kind, votes, shape)."""
    # One proposal of each single vote keeps the classifier defined where nothing was seen.
    patterns = sorted(counts)
    weight = np.array([counts[p] for p in patterns], dtype=float)
    empty = tuple([0] * len(LABELERS))
    prior = [(k, empty[:j] + (v,) + empty[j + 1 :], 0) for k in KINDS for j in range(len(LABELERS)) for v in (-1, 1)]
    votes = np.array([p[1] for p in patterns], dtype=int).reshape(-1, len(LABELERS))
    kinds = np.array([_RANK[p[0]] for p in patterns], dtype=int)
    reliability, share, truth = _estimate(votes, kinds, weight)
    odds = np.log(reliability[:, 1] / reliability[:, 0])
    prior_truth = []
    for kind, pattern, _ in prior:
        z = np.log(share[_RANK[kind]] / (1 - share[_RANK[kind]])) + sum(odds[j, v + 1] for j, v in enumerate(pattern))
        prior_truth.append(1 / (1 + np.exp(-z)))
    rows = _features(patterns + prior)
    target = np.concatenate((truth, prior_truth))
    # Logarithms: a frequent pattern must not drown a rare one.
    weight = np.concatenate((np.log1p(weight), np.ones(len(prior))))
    weight /= weight.sum()
    weights = np.zeros(rows.shape[1])
    momentum = np.zeros_like(weights)
    for _ in range(steps):
        guess = 1 / (1 + np.exp(-np.clip(rows @ weights, -40, 40)))
        gradient = rows.T @ (weight * (guess - target)) + decay * weights
        momentum = 0.9 * momentum - rate * gradient
        weights = weights + momentum
    return VoteModel(reliability, share, weights)


def fit(docs: DataFrame) -> VoteModel:
    """The model of all documents: votes are counted by pattern on the executors."""

    def count(rows):
        seen: Counter = Counter()
        for row in rows:
            seen.update(p for *_, p in proposals(row["text"], base_spans(row["text"])))
        for (kind, votes, shape), n in seen.items():
            yield kind, list(votes), shape, n

    counted = map_rows(docs.select("text"), count, "kind string, votes array<int>, shape int, n long")
    totals = counted.groupBy("kind", "votes", "shape").agg(F.sum("n").alias("n")).collect()
    return train({(r["kind"], tuple(r["votes"]), r["shape"]): r["n"] for r in totals})


def find_spans(text: bytes, model: VoteModel, cut: float, known: dict | None = None) -> list[tuple[str, int, int]]:
    """Base spans and those that the classifier adds, in bytes, by kind, then start."""
    known = {} if known is None else known
    base = base_spans(text)
    added = []
    for kind, a, b, pattern in proposals(text, base):
        if kind in BASE_KINDS:
            continue
        if pattern not in known:
            known[pattern] = model.probability(pattern)
        if known[pattern] >= cut:
            added.append((-known[pattern], _RANK[kind], a, b))
    if added:
        taken = _Taken((a, b) for _, a, b in base)
        # The likelier of overlapping proposals stays.
        added = [(KINDS[rank], a, b) for _, rank, a, b in sorted(added) if taken.take(a, b)]
    return sorted(base + added, key=lambda s: (_RANK[s[0]], s[1]))


class _Taken:
    """Parts of a text that spans hold; base spans may overlap each other, added ones nothing."""

    def __init__(self, spans):
        self.parts: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if self.parts and a < self.parts[-1][1]:
                self.parts[-1] = (self.parts[-1][0], max(b, self.parts[-1][1]))
            else:
                self.parts.append((a, b))

    def take(self, a: int, b: int) -> bool:
        place = bisect_right(self.parts, (a, b))
        if place and self.parts[place - 1][1] > a or place < len(self.parts) and self.parts[place][0] < b:
            return False
        insort(self.parts, (a, b))
        return True


def _points(text: bytes, spans):
    if not spans or text.isascii():
        return spans
    before = np.concatenate(([0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)))
    return [(kind, int(before[a]), int(before[b])) for kind, a, b in spans]


def personal_spans(docs: DataFrame, cut: float = 0.9, model: VoteModel | None = None) -> DataFrame:
    """One row per row: doc_id, counts of the base kinds, digest of the base spans, all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))

    def scan(rows):
        known: dict = {}
        for row in rows:
            spans = _points(row["text"], find_spans(row["text"], shared.value, cut, known))
            named = [(k, f"{k}:{a}:{b}") for k, a, b in spans]
            own = ",".join(n for k, n in named if k in BASE_KINDS)
            counts = [sum(k == kind for k, _ in named) for kind in BASE_KINDS]
            yield row["doc_id"], *counts, hashlib.sha256(own.encode()).hexdigest(), ",".join(n for _, n in named)

    counts = ", ".join(f"n_{kind} long" for kind in BASE_KINDS)
    return map_rows(docs.select("doc_id", "text"), scan, f"doc_id long, {counts}, base_sha256 string, spans string")
