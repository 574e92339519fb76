import re
from collections import Counter

import brute
import numpy as np
import pytest

from basketflow.llm import quality as q

SF = "/root/testdata/sf0.01"


def base(text):
    text = text or ""
    words = brute.words(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if brute.words(line)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    n = len(words)
    return (n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)), n < 50 or 100 * len(covered) > 50 * n


def own_grams(text):
    """Buckets by the same hash, gram by gram."""
    import xxhash

    tokens = re.findall(rb"[0-9A-Za-z_\x80-\xff]+|[^0-9A-Za-z_\x80-\xff\s]+", (text or "").encode())
    word = [xxhash.xxh64_intdigest(t) for t in tokens]
    full = (1 << 64) - 1
    pair = [(a * 0x9E3779B97F4A7C15 + (b ^ 0xC2B2AE3D27D4EB4F)) & full for a, b in zip(word, word[1:])]
    return [(h * 0xD6E8FEB86659FD93 & full) >> (64 - q.BUCKET_BITS) for h in word + pair]


def expected(rows, good):
    corpus, target = np.ones(q.BUCKETS), np.ones(q.BUCKETS)
    for key, text in rows:
        for g in own_grams(text):
            corpus[g] += 1
            target[g] += key in good
    ratio = np.round((np.log(target / target.sum()) - np.log(corpus / corpus.sum())) * q.UNIT).astype(int)
    if target.sum() == q.BUCKETS:
        ratio[:] = 0
    found = []
    for key, text in rows:
        counts, failed = base(text)
        grams = own_grams(text)
        score = int(ratio[grams].sum()) / len(grams) / q.UNIT if grams else 0.0
        found.append((str(key), *counts, score, failed, not failed and score >= q.LEAST_SCORE))
    return sorted(found)


def found(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality}
    assert found(q.op7_quality(spark, sf)) == expected(rows, good)


def test_verdicts_agree_with_labels(spark):
    judged = q.op7_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = judged.join(labels, "doc_id").where("NOT base_failed").collect()
    kept = {v: np.mean([r.kept for r in rows if r.quality == v]) for v in (0, 1)}
    assert kept[1] >= 0.99 and kept[0] <= 0.05


TEXTS = [
    None, "", " \n\t", "one", "a b c", "a b c a b c", "a b a b a b a", "x\ny\nx\n\n\nx \nx", "é ü\x0b#*$%&|<>",
    "\x1c\x85 　 word", "w " * 60, " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(49)),
    " ".join(f"w{i % 40}" for i in range(100000)), "日本 語\n日本 語",
]


@pytest.mark.parametrize("most", [500_000, 3])
def test_edge_texts(spark, docs_of, monkeypatch, most):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a b"), (3, "again"), (3, "again")]
    labels = spark.createDataFrame([(11, 1, 0), (12, 1, 0), (12, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    docs = docs_of(rows).selectExpr("*", "1 AS score", "'x' AS _id")
    assert found(q.quality(docs, labels)) == expected(rows, {11})
    none = labels.where("quality = 5")
    assert found(q.quality(docs, none)) == expected(rows, set())
    assert q.quality(docs_of([]), labels).count() == 0


def test_many_different_words_in_one_text(monkeypatch):
    words = [b"%d" % i for i in range(10)] * 3 + [b"x"]
    want = q.repeated_words(words)
    assert want == 30
