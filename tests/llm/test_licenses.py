from __future__ import annotations

import random
import re

from corpuslab.llm import licenses as lic


def test_plain_occurrences_are_found(documents):
    got = {(r.doc_id, r.license, r.containment) for r in lic.scan_licenses(documents).collect()}
    fold = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    for r in documents.collect():
        for name, text in lic.TEMPLATES.items():
            if fold(text) in fold(r.text):
                assert (r.doc_id, name, 1.0) in got


def test_like_brute_force():
    rng, known = random.Random(4), lic.Templates(lic.TEMPLATES)
    filler = [f"w{i}" for i in range(500)]
    for _ in range(60):
        name = rng.choice(sorted(lic.TEMPLATES))
        words = re.findall(r"[^\W_]+", lic.TEMPLATES[name].lower())
        before = [rng.choice(filler) for _ in range(rng.randint(0, 300))]
        text = " ".join(before + words + [rng.choice(filler) for _ in range(rng.randint(0, 300))])
        hits = [m for m in known.scan(text.encode()) if m[0] == name]
        assert [(m[1], m[2], m[3]) for m in hits] == [(len(before), len(before) + len(words), 1.0)]


def test_one_changed_word_is_still_found_and_half_is_not():
    known = lic.Templates(lic.TEMPLATES)
    words = lic.TEMPLATES["MIT-grant"].split()
    changed = words.copy()
    changed[30] = "zzz"
    assert any(m[0] == "MIT-grant" and m[3] < 1 for m in known.scan(" ".join(changed).encode()))
    assert not any(m[0] == "MIT-grant" for m in known.scan(" ".join(words[:30]).encode()))


def test_bands_miss_rarely():
    for text in lic.TEMPLATES.values():
        assert lic.miss_chance(len(re.findall(r"[^\W_]+", text))) < 1e-3


def test_edges(odd, none):
    assert lic.scan_licenses(none).count() == 0
    assert lic.scan_licenses(odd, {"x": "one two", "empty": "..."}).count() == 2  # doc 4 and the row without id
    many = " ".join(["released under the mit license"] * 3000)
    assert sum(m[0] == "MIT" for m in lic.Templates(lic.TEMPLATES).scan(many.encode())) >= 1
