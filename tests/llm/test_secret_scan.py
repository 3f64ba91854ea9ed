from __future__ import annotations

import random
import re

import pytest

from storefront_analytics.llm.automaton import compile_rules, parse
from storefront_analytics.llm.secret_scan import RULES, secret_spans, scanner

ASSIGN = re.compile(
    r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def _base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


PIECES = [
    "token", "password", "passwd", "secret", "api_key", "apikey", "API_KEY", "Token", '"', "'", " ", "  ", ":", "=",
    "==", "abcdefgh", "0123456789abcdef", "AKIA", "ABCDEF0123", "AKIAABCDEFGH1234", "é", "ß日", "x", "\n", ".", "-", "/",
    "eyJ", "pass", "tok", "a" * 8,
]


def test_spans_equal_the_expressions():
    rng, machine = random.Random(5), scanner(RULES)
    for _ in range(20_000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 14)))
        data = text.encode()
        got = [(len(data[:a].decode()), r, len(data[:b].decode())) for a, r, b in machine.spans(data) if r < 3]
        assert got == _base(text), text


@pytest.mark.parametrize("pattern", ["a(b|cd)*e", "[a-c]+d?", "ab{3}", "x|yz+", "(?i:key)=[0-9]+"])
def test_automata_accept_what_the_expression_does(pattern):
    rng = random.Random(2)
    machine = compile_rules([parse(pattern)], search=False)
    for _ in range(3000):
        text = "".join(rng.choice("abcdexyzKEYkey=01") for _ in range(rng.randint(0, 7)))
        state = 0
        for byte in text.encode():
            state = machine.rows[state][byte]
        assert bool(machine.accepts[state]) == bool(re.fullmatch(pattern, text)), text


def test_hard_cases(documents, hard):
    pairs = [*hard, (20, "é token = 'abcdefgh9' " + "f" * 40), (21, "-----BEGIN RSA PRIVATE KEY-----")]
    rows = secret_spans(documents(pairs)).collect()
    assert len(rows) == len(pairs)
    by = {r.doc_id: r for r in rows}
    assert by[20].spans == "assign:2:20,hex:22:62" and (by[20].n_assign, by[20].n_access, by[20].n_hex) == (1, 0, 1)
    assert by[21].spans == "private_key:0:31" and by[21].base_sha256 == by[3].base_sha256
    assert by[3].spans == "" and None in by
    assert secret_spans(documents(pairs).limit(0)).count() == 0
