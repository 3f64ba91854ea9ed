"""Secret scans by one combined automaton over all rules.

Each rule is a base expression and a least number of characters; a match is
leftmost, as long as possible, and matches of one rule don't overlap. Matches
that are too short use up their text and are dropped.

Defined cases: a null text is an empty one and has no spans; every input row
gives one output row, repeated rows and rows without ``doc_id`` too. Offsets
count code points; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
from pyspark.sql import DataFrame

from .automaton import compile_rules, parse, reverse
from .common import map_rows


@dataclass(frozen=True)
class Rule:
    """``least`` counts the closing run of accepted bytes: those from the first to the last end of a match."""

    kind: str
    pattern: str
    least: int
    base: bool = True


# The kinds and expressions that the scan has to report.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=\-]+""",
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 12),
    Rule("hex", r"[0-9a-f]+", 32),
)
#: Further kinds, reported beside the base ones.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----", 1, False),
    Rule("web_token", r"eyJ[A-Za-z0-9_\-]+\.eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+", 16, False),
)
RULES = BASE_RULES + MORE_RULES


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        nodes = [parse(r.pattern) for r in rules]
        self.forward = compile_rules(nodes, search=True)
        self.anchored = [compile_rules([n], search=False) for n in nodes]
        self.backward = [compile_rules([reverse(n)], search=False) for n in nodes]
        # Rules all of whose matches consist of ends of matches: [..]+ alone.
        self.whole = [n[0] == "cat" and len(n[1]) == 1 and n[1][0][0] == "plus" for n in nodes]
        # Rows that hold their successors, and last their number.
        rows: list[list] = [[] for _ in self.forward.rows]
        for number, targets in enumerate(self.forward.rows):
            rows[number].extend(rows[t] for t in targets)
            rows[number].append(number)
        self.start, self.kind = rows[0], np.min_scalar_type(len(rows))
        accepts = np.zeros((len(rules), len(rows)), dtype=bool)
        for state, which in enumerate(self.forward.accepts):
            for rule in which:
                accepts[rule, state] = True
        self.accepts = accepts

    def spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, by start, then rule."""
        states = np.fromiter(
            map(itemgetter(256), accumulate(text, getitem, initial=self.start)), self.kind, count=len(text) + 1
        )
        found = []
        for number, rule in enumerate(self.rules):
            ends = np.flatnonzero(self.accepts[number][states])
            if len(ends) < (rule.least if self.whole[number] else 1):
                continue
            breaks = np.flatnonzero(np.diff(ends) > 1)
            first = ends[np.concatenate(([0], breaks + 1))]
            last = ends[np.concatenate((breaks, [len(ends) - 1]))]
            if self.whole[number]:
                long = last - first + 1 >= rule.least
                found += [(int(a) - 1, number, int(b)) for a, b in zip(first[long], last[long], strict=True)]
                continue
            after = 0
            for low, high in zip(first.tolist(), last.tolist(), strict=True):
                start = self._start(number, text, high)
                if start >= after:
                    todo = [(start, low, high)]
                else:
                    # Ends of an attempt inside an earlier match: look at what follows it.
                    todo = self._matches(number, text, max(after, start), high)
                for start, low, end in todo:
                    after = end
                    if end - low + 1 >= rule.least:
                        found.append((start, number, end))
        return sorted(found)

    def _start(self, rule: int, text: bytes, end: int) -> int:
        """The leftmost start of a match that ends at ``end``."""
        machine = self.backward[rule]
        state, start = 0, end
        for at in range(end - 1, -1, -1):
            state = machine.rows[state][text[at]]
            if state == machine.dead:
                break
            if machine.accepts[state]:
                start = at
        return start

    def _matches(self, rule: int, text: bytes, at: int, stop: int) -> list[tuple[int, int, int]]:
        """(start, first end, last end) of the matches in a part of the text."""
        machine, found = self.anchored[rule], []
        while at < stop:
            state, low, high = 0, None, None
            for place in range(at, len(text)):
                state = machine.rows[state][text[place]]
                if state == machine.dead:
                    break
                if machine.accepts[state]:
                    low, high = low or place + 1, place + 1
            if high:
                found.append((at, low, high))
            at = high or at + 1
        return found


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def _points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans in code points."""
    if not spans or text.isascii():
        return spans
    values = np.frombuffer(text, dtype=np.uint8)
    before = np.concatenate(([0], np.cumsum((values & 0xC0) != 0x80)))
    return [(int(before[a]), rule, int(before[b])) for a, rule, b in spans]


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, counts per base kind, spans and their digest."""

    def scan(rows):
        machine = scanner(rules)
        base = [i for i, r in enumerate(rules) if r.base]
        for row in rows:
            found = _points(row["text"], machine.spans(row["text"]))
            named = [(f"{rules[r].kind}:{a}:{b}", r) for a, r, b in found]
            own = ",".join(n for n, r in named if rules[r].base)
            counts = [sum(r == i for _, r, _ in found) for i in base]
            digest = hashlib.sha256(own.encode()).hexdigest()
            yield row["doc_id"], *counts, digest, ",".join(n for n, _ in named)

    counts = ", ".join(f"n_{r.kind} long" for r in rules if r.base)
    return map_rows(docs.select("doc_id", "text"), scan, f"doc_id long, {counts}, base_sha256 string, spans string")
