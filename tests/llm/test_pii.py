from __future__ import annotations

import hashlib
import random
import re

from corpuslab.llm import pii

BASE = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def brute(text):
    out = []
    for kind, pattern in enumerate(BASE):
        for found in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", found.group())
            if kind == 1 and any(int(p) > 255 for p in found.group().split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((found.start(), kind, found.end()))
    return sorted(out)


def test_base_spans_like_the_patterns():
    rng, anchors = random.Random(1), pii.build_anchors()
    pieces = ["1.2.3.4", "256", ".", "@", "a", "b.c", "+1", "4111 1111 1111 1111", "-", " ", "12", "é", "+49 (30) 1234-567", "١"]
    for n in range(20_000):
        text = "".join(rng.choice("0123459..@@+- ab()-" if n % 2 else pieces) for _ in range(rng.randint(0, 40)))
        assert [s for s in pii.spans_of(text, anchors) if s[1] < 4] == brute(text), text


def test_added_kinds():
    anchors = pii.build_anchors()
    found = lambda t: [(pii.KINDS[k], t[s:e]) for s, k, e in pii.spans_of(t, anchors) if k > 3]
    assert found("IBAN: DE89 3704 0044 0532 0130 00 OK") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert found("account no. 12345678, x") == [("account", "12345678")]
    assert found("ssh://bob:pw@host.org/x y") == [("address", "ssh://bob:pw@host.org/x")]
    assert found("accounts 99999999, accountant 1234567, see http://x.org/a") == []


def test_query_and_redaction(odd, none, documents):
    for docs in (odd, documents):
        texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=str)
        got = sorted((tuple(r) for r in pii.pii_digests(docs).collect()), key=str)
        assert len(got) == len(texts)
        want = []
        for i, text in texts:
            base = brute(text)
            joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
            counts = [sum(k == x for _, k, _ in base) for x in range(4)]
            want.append((i, *counts, hashlib.sha256(joined.encode()).hexdigest()))
        assert sorted((g[:6] for g in got), key=str) == sorted(want, key=str)
    assert pii.pii_digests(none).count() == 0
    row = odd.filter("text LIKE 'mail%'")
    clean = pii.with_spans(row).select(pii.redacted(pii.F.col("text"), pii.F.col("spans")).alias("t")).first().t
    assert clean == "mail [email] and [phone]"
