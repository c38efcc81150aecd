from __future__ import annotations

import random

import fixtures
from tallyforge.llm import licenses
from tallyforge.llm.licenses import LicenseIndex, align
from tallyforge.llm.words import WordHashes


def test_every_license_and_notice_is_found_with_its_place(spark):
    rows = fixtures.awkward_rows()
    planted = []
    for k, (_, notice) in enumerate(licenses.TEMPLATES.items()):
        before, after = fixtures.prose(k, 40), fixtures.prose(k + 99, 40)
        planted.append((500 + k, f"{before}\n{notice.upper() if k % 2 else notice}.\n{after}", None, None, None))
    docs = fixtures.scanned(spark, fixtures.awkward(spark, rows + planted + planted[:1]))
    got = licenses.license_report(docs).collect()
    assert {(row.doc_id, row.license) for row in got} == {(500 + k, name) for k, name in enumerate(licenses.TEMPLATES)}
    assert len(got) == len(planted) + 1  # the repeated row is reported twice
    texts = {row[0]: row[1] for row in planted}
    for row in got:
        stretch = texts[row.doc_id][row.start : row.end]
        assert licenses.license_words(stretch) == licenses.license_words(licenses.TEMPLATES[row.license])
        assert row.coverage == 1.0 and row.matched_words == row.last_word - row.first_word + 1


def test_at_least_fifteen_whole_licenses():
    whole = set(licenses.TEMPLATES) - set(licenses.NOTICES)
    assert len(whole) >= 15 and all(len(licenses.license_words(licenses.TEMPLATES[name])) > 30 for name in whole)


def test_two_clauses_are_not_three():
    index, codes = LicenseIndex(licenses.TEMPLATES), WordHashes()
    for name in ("BSD-2-Clause", "BSD-3-Clause", "MIT", "MIT-0", "ISC", "0BSD", "GPL-2.0", "GPL-3.0", "LGPL-2.1"):
        words = ["x"] * 9 + licenses.license_words(licenses.TEMPLATES[name]) + ["y"] * 9
        assert [f.license for f in index.scan(words, codes)] == [name]


def test_changed_words_lower_the_coverage():
    index, codes = LicenseIndex(licenses.TEMPLATES), WordHashes()
    for name in ("BSD-3-Clause", "GPL-3.0 (notice)"):
        words = licenses.license_words(licenses.TEMPLATES[name])
        changed = words[:5] + ["really"] + words[5:9] + words[10:]
        found = index.scan(["x"] * 30 + changed + ["y"] * 30, codes)
        assert [(f.license, f.matched, f.first) for f in found] == [(name, len(words) - 1, 30)]
        assert name not in [f.license for f in index.scan(words[: len(words) // 2], codes)]


def test_short_notices_with_a_changed_word_are_found():
    index, codes = LicenseIndex(licenses.TEMPLATES), WordHashes()
    found = index.scan("x released under an mit license y licensed with cc by nc 4 0 z".split(), codes)
    assert [(f.license, f.coverage) for f in found] == [("MIT (reference)", 0.8), ("CC-BY-NC-4.0 (reference)", 6 / 7)]


def every_diagonal(index, words):
    """Finds by alignment of every template along every diagonal, without fingerprints."""
    aligned = set()
    for name in index.names:
        template = index.words[name]
        for diagonal in range(-len(template), len(words)):
            matched, first, last = align(template, words, diagonal, index.band_of(name, licenses.BAND))
            if matched >= licenses.MIN_COVERAGE * len(template):
                aligned.add(licenses.Found(name, matched, matched / len(template), first, last))
    kept = []
    for found in sorted(aligned, key=lambda f: (-f.matched, -f.coverage, f.last - f.first, f.first, f.license)):
        if all(found.last < other.first or found.first > other.last for other in kept):
            kept.append(found)
    return sorted((f.license, f.matched, f.first, f.last) for f in kept)


def test_finds_equal_alignment_along_every_diagonal():
    names = ["MIT (reference)", "Apache-2.0 (reference)", "GPL-2.0 (notice)", "WTFPL", "CC-BY-4.0 (reference)"]
    index, codes = LicenseIndex({name: licenses.TEMPLATES[name] for name in names}), WordHashes()
    rng = random.Random(5)
    for _ in range(12):
        words = fixtures.prose(rng.random(), 15).split()
        for name in rng.sample(names, 2):
            own = list(index.words[name])
            for _ in range(len(own) // 8):
                place = rng.randrange(len(own))
                own[place : place + rng.randrange(2)] = rng.choice([[], ["new"]])
            words += own + fixtures.prose(rng.random(), 9).split()
        words = [word.replace("é", "e") for word in words]
        got = sorted((f.license, f.matched, f.first, f.last) for f in index.scan(words, codes))
        assert [row[:2] for row in got] == [row[:2] for row in every_diagonal(index, words)]


def test_a_very_long_text(spark):
    text = " ".join([fixtures.prose(1, 200_000), licenses.TEMPLATES["MIT"], fixtures.prose(2, 100_000)])
    (found,) = licenses.license_report(fixtures.awkward(spark, [(1, text, None, None, None)])).collect()
    assert found.license == "MIT" and text[found.start : found.end].startswith("Permission is hereby")


def test_two_of_a_kind_and_short_templates():
    index, codes = LicenseIndex({"tiny": "MIT License", "one": "Beerware", "empty": ""}), WordHashes()
    found = index.scan("x mit license y beerware z MIT license".lower().split(), codes)
    assert [(f.license, f.first, f.last) for f in found] == [("tiny", 1, 2), ("one", 4, 4), ("tiny", 6, 7)]
    assert LicenseIndex({}).scan(["a", "b"], codes) == []


def test_alignment():
    template = "a b c d e".split()
    assert align(template, "x a b c d e y".split(), 1, 2) == (5, 1, 5)
    assert align(template, "a b x c d e".split(), 0, 2) == (5, 0, 5)
    assert align(template, "a b d e".split(), 0, 2) == (4, 0, 3)
    assert align(template, "x y z".split(), 0, 2)[0] == 0


def test_empty_table(spark):
    assert licenses.license_report(fixtures.awkward(spark, [])).collect() == []
