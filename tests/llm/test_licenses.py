import random
from collections import Counter
from functools import cache

import numpy as np
import pytest

from basketflow.llm import licenses as l
from basketflow.llm.words import plain_words

SF = "/root/testdata/sf0.001"
ALL = l.TEMPLATES | l.NOTICES


@cache
def known_templates(share):
    return l.Templates(ALL, share)


def windows_with(template, text, share=l.CONTAINMENT):
    """The best containment in any window of the template's class, and how many have enough."""
    known = known_templates(share)
    own = l.shingles(plain_words(ALL[template].encode()))
    words = plain_words((text or "").encode())
    length = len(own) + l.SHINGLE - 1
    (span, stride), = [(s, t) for a, b, s, t in known.classes if a <= length <= b]
    shares = [len(set(own) & set(l.shingles(words[i : i + span]))) / len(set(own)) for i in range(0, max(1, len(words) - l.SHINGLE + 1), stride)]
    return max(shares, default=0), sum(s >= share - 1e-9 for s in shares)


def expected(rows):
    found = {}
    for key, text in rows:
        words = plain_words((text or "").encode())
        for name, notice in ALL.items():
            own = plain_words(notice.encode())
            if len(own) < l.SHINGLE:
                best, count = 1.0, sum(words[i : i + len(own)] == own for i in range(len(words)))
            else:
                best, count = windows_with(name, text)
            if count:
                found[str(key), name] = (count, best)
    return found


def found(df):
    return {(str(r.doc_id), r.license): (r.windows, r.containment) for r in df.collect()}


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got, want = found(l.op5_licenses(spark, SF)), expected(rows)
    assert want and set(got) == set(want)
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}


def test_classes_cover_all_lengths_and_miss_little():
    lengths = [5, 6, 7, 12, 13, 40, 41, 90, 400]
    found = l.classes(lengths)
    for n in lengths:
        (shortest, longest, span, stride), = [c for c in found if c[0] <= n <= c[1]]
        assert span >= n + stride - 1
        assert l.miss_chance(l.least_similarity(n, span)) <= l.MOST_MISSED
    assert l.classes([]) == []


def all_bands_of_all_windows(known, words):
    """Candidates as the method states them: least values of every window against every template."""
    found = set()
    hashes = known.hashes.of(words)
    hashed = known._hashed(hashes, l.SHINGLE)
    for c, (shortest, longest, span, stride) in enumerate(known.classes):
        width = span - l.SHINGLE + 1
        for t, name in enumerate(known.names):
            own = plain_words(l.TEMPLATES[name].encode())
            if not shortest <= len(own) <= longest:
                continue
            mine = known._hashed(known.hashes.of(own), l.SHINGLE)
            for band in range(l.least_bands(l.least_similarity(shortest, span))):
                values = known._values(hashed, band)
                least = known._values(mine, band).min()
                for begin in range(0, len(hashed), stride):
                    if values[begin : begin + width].min() == least:
                        found.add(((c, t), begin))
    return found


def test_candidates_are_those_of_all_windows():
    known = l.Templates(l.TEMPLATES, l.CONTAINMENT)
    rng = random.Random(3)
    for _ in range(4):
        words = [f"w{rng.randrange(30)}" for _ in range(rng.randrange(9))]
        for _ in range(4):
            own = rng.choice(list(l.TEMPLATES.values())).split()
            cut = rng.randrange(len(own))
            words += own[cut // 3 :] + own[:cut] + [f"w{rng.randrange(30)}" for _ in range(rng.randrange(40))]
        words = plain_words(" ".join(words).encode())
        got = list(known._candidates(words, known.hashes.of(words)))
        assert len(got) == len(set(got)) and set(got) == all_bands_of_all_windows(known, words)


def test_every_class_has_bands_enough():
    known = l.Templates(l.TEMPLATES, l.CONTAINMENT)
    for shortest, _, span, _ in known.classes:
        similarity = l.least_similarity(shortest, span)
        assert l.miss_chance(similarity, l.least_bands(similarity)) <= l.MOST_MISSED


@pytest.mark.parametrize("scan", [1 << 16, 37])
def test_edited_notices(spark, docs_of, monkeypatch, scan):
    monkeypatch.setattr(l, "SCAN_WORDS", scan)
    rng = random.Random(9)
    rows = [(0, None), (1, ""), (2, "license"), (None, l.TEMPLATES["MIT"])]
    for i in range(60):
        words = rng.choice(list(l.TEMPLATES.values())).split()
        for _ in range(rng.randrange(0, 3)):
            words[rng.randrange(len(words))] = "changed"
        before, after = (" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 90))) for _ in range(2))
        rows.append((10 + i, f"{before} {' '.join(words).upper()}\n{after}"))
    rows.append((500, "word " * 100000 + l.TEMPLATES["MIT-text"]))
    docs = docs_of(rows).selectExpr("*", "1 AS license", "2 AS windows")
    got, want = found(l.licenses(docs)), expected(rows[:-1])
    assert {k: v[1] for k, v in got.items() if k[0] != "500"} == {k: v[1] for k, v in want.items()}
    assert got["500", "MIT-text"][1] == 1.0
    twice = l.licenses(docs_of([(1, l.TEMPLATES["MIT"])] * 2)).collect()
    assert [(r.doc_id, r.license, r.first_word) for r in twice] == [(1, "MIT", 0)] * 2


def test_empty_tables_and_templates(spark, docs_of):
    assert l.licenses(docs_of([])).count() == 0
    assert l.licenses(docs_of([(1, "a b c d e")]), {}).count() == 0
    assert l.licenses(docs_of([(1, "a b c d")]), {"short": "a b c d"}).count() == 1


def test_short_templates_have_a_class_of_their_own(spark, docs_of):
    rows = [
        (1, "Text.\nAll rights reserved.\nMore, ALL RIGHTS RESERVED"),
        (2, "// SPDX-License-Identifier: MIT"),
        (3, "SPDX-License-Identifier: Custom-1.0"),
        (4, "all rights are reserved"),
        (5, "reserved"),
        (6, None),
        (None, "all rights reserved"),
    ]
    got = sorted((str(r.doc_id), r.license, r.first_word, r.windows, r.containment) for r in l.licenses(docs_of(rows)).collect())
    assert got == [
        ("1", "All-rights-reserved", 1, 2, 1.0),
        ("2", "SPDX", 0, 1, 1.0),
        ("2", "SPDX-MIT", 0, 1, 1.0),
        ("3", "SPDX", 0, 1, 1.0),
        ("None", "All-rights-reserved", 0, 1, 1.0),
    ]
    pair = l.licenses(docs_of([(1, "x a b c d")]), {"one": "a", "same": "A.", "four": "a b c d", "none": "..."}).collect()
    assert sorted((r.license, r.first_word) for r in pair) == [("four", 1), ("one", 1), ("same", 1)]


def test_common_licenses_are_known_by_their_own_words():
    known = l.Templates(l.TEMPLATES | l.NOTICES, l.CONTAINMENT)
    for name, text in (l.TEMPLATES | l.NOTICES).items():
        assert (name, 1.0) in {(hit[0], hit[3]) for hit in known.search(f"before it {text} after it".encode())}
    for version, license in (("2", "GPL-2.0"), ("3", "GPL-3.0-header")):
        header = l.TEMPLATES["GPL-3.0-header"].replace("version 3", f"version {version}")
        names = {hit[0] for hit in known.search(header.encode()) if hit[3] == 1.0}
        assert names == ({"GPL-2.0-header"} if version == "2" else {license})


def test_every_planted_line_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    planted = docs.where("text RLIKE '(?i)licen[sc]e|rights reserved|spdx'").select("doc_id")
    hits = l.op5_licenses(spark, "/root/testdata/sf0.1").collect()
    got = {r.doc_id for r in hits}
    assert {r.doc_id for r in planted.collect()} == got and len(got) == 328
    assert Counter(r.license for r in hits) == {
        "All-rights-reserved": 66, "Apache-2.0": 57, "CC-BY-NC-4.0": 63, "GPL-3.0": 79, "MIT": 63,
    }
