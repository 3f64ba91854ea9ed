from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from storefront_analytics.llm import personal_data as P

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, span):
    digits = re.sub("[^0-9]", "", span)
    if kind == "ip":
        return all(int(p) <= 255 for p in span.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = 0
        for i, d in enumerate(reversed(digits)):
            v = int(d) * (1 + i % 2)
            total += v - 9 * (v > 9)
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return True


def _expected(text):
    text = text or ""
    return [(k, *m.span()) for k, r in RULES.items() for m in re.finditer(r, text) if _passes(k, m[0])]


def test_base_spans_against_the_expressions():
    rng = random.Random(3)
    alphabets = ["a.@-1 b@", "0123.456 ", "0123456789- ", "+(1) 23.4-56+", "a@b.c +49 30 1.2.3.4 4111-1111 é"]
    for i in range(12_000):
        text = "".join(rng.choice(alphabets[i % 5]) for _ in range(rng.randint(0, 60)))
        raw = text.encode()
        assert P._points(raw, P.base_spans(raw)) == _expected(text), text
    for text in ("4111 1111 1111 1111", "x 4111111111111111 1", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "+1 (509) 555-6973 .", "0300.1.2.3"):
        assert P.base_spans(text.encode()) == _expected(text)


def test_long_runs_take_linear_time():
    for part in ("9", "a", "1.", "a@", "+1 ", "4-", "a.b@", "Ab ", "(at)", "AB12 ABCD "):
        text = (part * 400_000).encode()
        P.find_spans(text[: 400_000], P.train({}), 0.9)


def _votes(rng, truth):
    out = []
    for j in range(len(P.LABELERS)):
        right = 0.95 if j < 3 else 0.7
        said = 0 if rng.random() < 0.3 else (1 if (rng.random() < right) == truth else -1)
        out.append(said)
    return tuple(out)


def test_reliabilities_are_estimated_without_labels():
    rng = random.Random(1)
    counts, truths = {}, []
    for _ in range(20_000):
        truth = rng.random() < 0.3
        pattern = ("iban", _votes(rng, truth), 0)
        truths.append((pattern, truth))
        counts[pattern] = counts.get(pattern, 0) + 1
    model = P.train(counts)
    good = model.reliability[:, 1, 2] / (model.reliability[:, 1, 0] + model.reliability[:, 1, 2])
    assert (abs(good[:3] - 0.95) < 0.03).all() and (abs(good[3:] - 0.7) < 0.04).all()
    assert abs(model.share[P.KINDS.index("iban")] - 0.3) < 0.02
    # No worse than with the true reliabilities.
    known = [0.95] * 3 + [0.7] * 5
    best = 0
    for (_, votes, _), truth in truths:
        z = np.log(0.3 / 0.7) + sum(v * np.log(r / (1 - r)) for v, r in zip(votes, known))
        best += (z >= 0) == truth
    right = sum((model.probability(p) >= 0.5) == t for p, t in truths)
    assert right >= best - 0.003 * len(truths)


def test_counts_follow_all_documents(documents):
    texts = ["My IBAN: DE89 3704 0044 0532 0130 00.", "write to a@b.com or call +49 30 1234567", None, ""]
    docs = documents([(i, t) for i, t in enumerate(texts * 30)])
    seen = {}
    for t in texts * 30:
        raw = (t or "").encode()
        for *_, p in P.proposals(raw, P.base_spans(raw)):
            seen[p] = seen.get(p, 0) + 1
    expected, got = P.train(seen), P.fit(docs)
    assert (expected.weights == got.weights).all() and (expected.reliability == got.reliability).all()


def test_spans(documents, hard, prose):
    added = [
        (100, "Mail a.b@mail.example.com, my bank account IBAN DE89 3704 0044 0532 0130 00 please"),
        (101, "SSN 219-09-9999, born 12.03.1984, phone 555-010-9988 by a@x.org"),
        (102, "release 219-09-9999 page 666-00-0000 Version 3 figure 11.11.1111"),
        (103, "Card 4111 1111 1111 1111 É +1 (509) 555-6973 10.0.0.1"),
    ]
    pairs = hard + added + [(200 + i, prose(300, i)) for i in range(40)]
    got = {r.doc_id: r for r in P.personal_spans(documents(pairs)).collect()}
    for doc, text in pairs:
        base = _expected(text)
        row = got[doc]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in base) for k in P.BASE_KINDS]
        spans = [s for s in row.spans.split(",") if s]
        assert [s for s in spans if s.split(":")[0] in P.BASE_KINDS] == listed.split(",") * bool(listed)
        order = [(P.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order)
        if doc is not None and doc < 100 or doc is not None and doc >= 200:
            assert len(spans) == len(base)
    kinds = {d: {s.split(":")[0] for s in got[d].spans.split(",")} for d in (100, 101, 102)}
    assert kinds[100] == {"email", "iban"} and {"social_number", "birth_date"} <= kinds[101]
    assert kinds[102] <= {""}


def test_rows_and_empty_tables(documents):
    docs = documents([(1, "a@b.c"), (1, "a@b.c"), (None, "a@b.c"), (2, None)])
    assert sorted((r.doc_id or 0, r.n_email) for r in P.personal_spans(docs).collect()) == [(0, 1), (1, 1), (1, 1), (2, 0)]
    assert P.personal_spans(docs.filter("doc_id < 0")).collect() == []
