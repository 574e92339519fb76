import random

import numpy as np

from basketflow.llm import toxicity as t

SF = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    """Fitted without half of the labels, it finds the toxic ones of that half and few others."""
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    model = t.fit(t.labelled_sample(docs, labels.where("doc_id % 2 = 0")))
    scored = docs.withColumn("severity", t.severity(model)).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    toxic = [r.severity >= t.SEVERE for r in scored if r.toxic]
    clean = [r.severity >= t.SEVERE for r in scored if not r.toxic]
    assert np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.02


def sparse(own):
    """Row, feature and value of each cell, for rows given as lists of features."""
    cells = [(r, f, np.log1p(o.count(f))) for r, o in enumerate(own) for f in sorted(set(o))]
    return tuple(np.array(x) for x in zip(*cells, strict=True))


def test_grades_are_ordered():
    rng = np.random.default_rng(1)
    own = [[int(c) for c in rng.integers(0, 5, rng.integers(0, 9))] for _ in range(800)]
    weight = np.array([2.0, 1.0, 0.0, -1.0, 0.5])
    score = np.array([sum(weight[w] * np.log1p(o.count(w)) for w in set(o)) for o in own])
    grades = np.digitize(score + rng.logistic(size=800) * 0.3, [0.5, 1.5, 2.5])
    weights, thresholds = t._ordinal(*sparse(own), grades, 5)
    assert np.all(np.diff(thresholds) > 0)
    assert np.corrcoef(weights, weight)[0, 1] > 0.98


def test_fit_is_the_maximum():
    """No small change of any weight or threshold makes the data likelier."""
    rng = np.random.default_rng(2)
    own = [[int(c) for c in rng.integers(0, 3, 4)] for _ in range(300)]
    grades = rng.integers(0, 4, 300)
    weights, thresholds = t._ordinal(*sparse(own), grades, 3, steps=2000)

    def loss(w, th):
        score = np.array([sum(w[c] * np.log1p(o.count(c)) for c in set(o)) for o in own])
        above = np.column_stack([np.ones(300), t._logistic(score[:, None] - th), np.zeros(300)])
        at = np.arange(300)
        return -np.log(above[at, grades] - above[at, grades + 1]).sum() + t.RIDGE / 2 * (w**2).sum()

    best = loss(weights, thresholds)
    for i in range(3):
        for change in (-0.05, 0.05):
            moved_w, moved_t = weights.copy(), thresholds.copy()
            moved_w[i] += change
            moved_t[i] += change
            assert loss(moved_w, thresholds) > best and loss(weights, moved_t) > best


def test_grams_stay_within_words():
    text = t.padded("Ab cdefghij, é!".encode())
    found = {g.to_bytes(8, "big").lstrip(b"\0") for _, gram in t.grams(text) for g in gram.tolist()}
    want = set()
    for size in t.SIZES:
        cut = [text[i : i + size] for i in range(len(text) - size + 1)]
        want |= {c for c in cut if b" " not in c[1:-1]}
    assert text == " ab cdefghij é ".encode() and found == want


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def toy(docs_of, spark, n=200):
    rng = random.Random(3)
    calm = [f"calm{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(calm, k=30)
        if i % 4 == 0:
            words[: 1 + i % 12] = ["Vile!"] * (1 + i % 12)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    return rows, labels


def test_edge_rows(spark, docs_of):
    rows, labels = toy(docs_of, spark)
    more = [(None, "vile vile vile"), (500, None), (501, ""), (502, "calm1 " * 100000), (503, "VILE vile (vile) vile"), (503, "calm2 calm3")]
    docs = docs_of(rows + more).selectExpr("*", "1 AS severity", "0 AS toxic")
    labels = labels_of(spark, [*labels, (None, 1, 1), (7, None, None), (9, 1, 0), (9, 1, 0)])
    kept = t.keep_civil(docs, labels)
    assert kept.columns == docs.columns
    want = [(i, x) for i, x in rows if i % 4] + [more[1], more[2], more[3], more[5]]
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted((str(i), str(x)) for i, x in want)


def test_severity_rises_with_the_number_of_toxic_words(spark, docs_of):
    rows, labels = toy(docs_of, spark, 600)
    model = t.fit(t.labelled_sample(docs_of(rows), labels_of(spark, labels)))
    texts = [" ".join(["calm7"] * 30 + ["vile"] * n).encode() for n in range(0, 12)]
    severity = model.expected(texts)
    assert severity[0] < 0.3 < t.SEVERE < severity[1] and np.all(np.diff(severity) > 0)


def test_no_evidence(spark, docs_of):
    rows, labels = toy(docs_of, spark, 40)
    for some in ([], [r for r in labels if not r[2]], [(99999, 1, 1)]):
        assert t.keep_civil(docs_of(rows), labels_of(spark, some)).count() == 40
    assert t.keep_civil(docs_of([]), labels_of(spark, labels)).count() == 0


def test_sample_is_bounded(spark, docs_of):
    rows, labels = toy(docs_of, spark)
    assert t.labelled_sample(docs_of(rows), labels_of(spark, labels), rows=50).count() == 50
