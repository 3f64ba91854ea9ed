"""Regular expressions over bytes as one minimal deterministic automaton.

All rules become one automaton: a Thompson automaton per rule, one subset
construction over all of them in which a new attempt may start at every byte,
and minimisation by partition refinement. A state knows which rules it
accepts, so one pass over the bytes finds where matches of every rule end.
Where a match begins is found by running the rule's reversed automaton back
from its end.

Syntax: literals, ``\\xNN`` and escaped characters, classes with ranges,
groups, ``|``, ``?``, ``*``, ``+``, ``{n}``.
"""

from __future__ import annotations

from dataclasses import dataclass, field


# --- syntax: ("set", frozenset of bytes) | ("cat", [..]) | ("alt", [..]) | ("star" | "plus" | "opt", node)
class _Reader:
    def __init__(self, pattern: str, fold_case: bool):
        self.text, self.at, self.fold = pattern, 0, fold_case

    def peek(self) -> str:
        return self.text[self.at] if self.at < len(self.text) else ""

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            node = self.atom()
            while self.peek() and self.peek() in "?*+{":
                sign = self.take()
                if sign == "{":
                    end = self.text.index("}", self.at)
                    node = ("cat", [node] * int(self.text[self.at : end]))
                    self.at = end + 1
                else:
                    node = ({"?": "opt", "*": "star", "+": "plus"}[sign], node)
            parts.append(node)
        return ("cat", parts)

    def character(self) -> int:
        sign = self.take()
        if sign != "\\":
            return ord(sign)
        if self.peek() == "x":
            self.at += 3
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(self.take())

    def cased(self, codes: set[int]) -> tuple:
        if self.fold:
            codes |= {c ^ 32 for c in codes if chr(c).isalpha()}
        if max(codes) > 127:
            raise ValueError(f"not ASCII: {self.text}")
        return ("set", frozenset(codes))

    def atom(self):
        if self.peek() == "(":
            self.take()
            node = self.alternatives()
            self.take()
            return node
        if self.peek() != "[":
            return self.cased({self.character()})
        self.take()
        codes: set[int] = set()
        while self.peek() != "]":
            low = self.character()
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                codes |= set(range(low, self.character() + 1))
            else:
                codes.add(low)
        self.take()
        return self.cased(codes)


def parse(pattern: str, fold_case: bool = False):
    """``(?i:...)`` around a leading part folds the case of that part only."""
    if pattern.startswith("(?i:"):
        depth, end = 1, 4
        while depth:
            depth += {"(": 1, ")": -1}.get(pattern[end], 0) * (pattern[end - 1] != "\\")
            end += 1
        return ("cat", [parse(pattern[4 : end - 1], True), parse(pattern[end:])])
    return _Reader(pattern, fold_case).alternatives()


def reverse(node):
    kind, value = node
    if kind == "cat":
        return kind, [reverse(v) for v in reversed(value)]
    if kind == "alt":
        return kind, [reverse(v) for v in value]
    return (kind, value) if kind == "set" else (kind, reverse(value))


@dataclass
class _Nfa:
    empty: list[list[int]] = field(default_factory=list)
    moves: list[tuple[frozenset[int], int] | None] = field(default_factory=list)

    def state(self) -> int:
        self.empty.append([])
        self.moves.append(None)
        return len(self.moves) - 1

    def add(self, node, start: int) -> int:
        """Adds ``node`` after ``start``; its end."""
        kind, value = node
        if kind == "set":
            end = self.state()
            middle = self.state()
            self.empty[start].append(middle)
            self.moves[middle] = (value, end)
            return end
        if kind == "cat":
            for part in value:
                start = self.add(part, start)
            return start
        end = self.state()
        if kind == "alt":
            for option in value:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.add(option, first)].append(end)
            return end
        first = self.state()
        self.empty[start].append(first)
        last = self.add(value, first)
        self.empty[last].append(end)
        if kind in ("star", "plus"):
            self.empty[last].append(first)
        if kind in ("star", "opt"):
            self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for other in self.empty[todo.pop()]:
                if other not in seen:
                    seen.add(other)
                    todo.append(other)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``rows[state][byte]`` is the next state; state 0 is the start."""

    rows: list[list[int]]
    accepts: list[frozenset[int]]
    dead: int | None


def compile_rules(nodes: list, search: bool) -> Automaton:
    """One minimal automaton for all ``nodes``; ``search``: attempts start at every byte."""
    nfa = _Nfa()
    root = nfa.state()
    ends = {}
    for number, node in enumerate(nodes):
        first = nfa.state()
        nfa.empty[root].append(first)
        ends[nfa.add(node, first)] = number
    start = nfa.closure([root])
    # Bytes that no rule tells apart share a class.
    signature: dict[tuple, list[int]] = {}
    sets = [m[0] for m in nfa.moves if m]
    for byte in range(256):
        signature.setdefault(tuple(byte in s for s in sets), []).append(byte)
    classes = list(signature.values())
    index, todo, table = {start: 0}, [start], []
    for subset in todo:
        row = []
        for members in classes:
            reached = {nfa.moves[s][1] for s in subset if nfa.moves[s] and members[0] in nfa.moves[s][0]}
            target = nfa.closure(reached | {root} if search else reached)
            if target not in index:
                index[target] = len(todo)
                todo.append(target)
            row.append(index[target])
        table.append(row)
    accepts = [frozenset(ends[s] for s in subset if s in ends) for subset in todo]
    # Minimisation: split blocks until all members move alike.
    block = {a: i for i, a in enumerate(dict.fromkeys(accepts))}
    of = [block[a] for a in accepts]
    while True:
        keys = [(of[s], *(of[t] for t in table[s])) for s in range(len(table))]
        names = {k: i for i, k in enumerate(dict.fromkeys(keys))}
        new = [names[k] for k in keys]
        if len(names) == len(set(of)):
            break
        of = new
    size = len(set(of))
    rows, kept = [[0] * 256 for _ in range(size)], [frozenset()] * size
    for state, row in enumerate(table):
        kept[of[state]] = accepts[state]
        for members, target in zip(classes, row, strict=True):
            for byte in members:
                rows[of[state]][byte] = of[target]
    dead = next((s for s in range(size) if not kept[s] and set(rows[s]) == {s}), None)
    if of[0] != 0:
        raise AssertionError("the start is named first")
    return Automaton(rows, kept, dead)
