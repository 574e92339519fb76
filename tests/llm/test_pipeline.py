"""The pipeline's rows against plain Python, stage by stage."""

import random
import struct
import zlib

import brute
import corpus_pipeline
import pytest
from tokenizers import Tokenizer

from basketflow.llm import mixing, records
from basketflow.llm.toxicity import SEVERE, fit, labelled_sample

SF = "/root/testdata/sf0.001"
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def written(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_stages_in_turn(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    kept = {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "decontamination", "mixing_sources", "token_records",
    ]
    (_, civil), (_, dedup), (_, clean), (_, mixed), (_, tokens) = corpus_pipeline.STAGES

    docs = written(civil(spark, docs, SF), tmp_path / "1")
    assert docs.columns == DOCUMENT
    model = fit(labelled_sample(spark.read.parquet(f"{SF}/documents.parquet"), labels))
    severity = model.expected([(r.text or "").encode() for r in kept.values()])
    kept = {k: r for (k, r), s in zip(kept.items(), severity) if s < SEVERE}
    assert {r.doc_id for r in docs.collect()} == set(kept)

    docs = written(dedup(spark, docs, SF), tmp_path / "2")
    prints = {k: brute.simhash(r.text) for k, r in kept.items()}
    roots = brute.groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    kept = {k: r for k, r in kept.items() if roots[k] == k}
    assert docs.columns == DOCUMENT and sorted(docs.collect()) == sorted(kept.values())

    docs = written(clean(spark, docs, SF), tmp_path / "3")
    left = {r.doc_id for r in docs.collect()}
    assert left <= set(kept) and not any(i.text in kept[k].text for k in left for i in items)
    assert len(set(kept) - left) < 0.2 * len(kept)
    kept = {k: kept[k] for k in left}

    placed = mixing.mix(docs, mixing.TARGET_PARTS, mixing.BLOCK_ROWS)
    order = [r.doc_id for r in placed.orderBy("position", "place").collect()]
    docs = written(mixed(spark, docs, SF), tmp_path / "4")
    assert docs.columns == DOCUMENT and sorted(docs.collect()) == sorted(kept.values())

    tokenizer = Tokenizer.from_file(records.tokenizer_path())
    start, want = 0, []
    for k in order:
        ids = [*tokenizer.encode(kept[k].text or "", add_special_tokens=False).ids, 0]
        want.append((k, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    found = tokens(spark, docs, SF).orderBy("start").collect()
    assert [tuple(r)[:4] for r in found] == want
    whole = corpus_pipeline.run(spark, SF).orderBy("start").collect()
    assert [tuple(r)[:4] for r in whole] == want


@pytest.mark.parametrize("kind", ["empty", "edges"])
def test_unusual_tables(spark, docs_of, sf_dir_of, kind):
    rng = random.Random(4)
    rows = [] if kind == "empty" else [
        (None, None), (None, None), (1, ""), (2, "a b c d e f"), (2, "a b c d e f"), (3, "w" * 200000, None),
        (4, " ".join(f"x{rng.randrange(999)}" for _ in range(50000)), "new"), (5, None, "src1"),
    ]
    tables = {
        "documents": docs_of(rows).selectExpr("*", "1 AS _row", "2 AS severity", "'z' AS _id"),
        "labels": spark.createDataFrame([(2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, None), (None, "")], "item_id long, text string"),
    }
    sf = sf_dir_of(**tables)
    found = corpus_pipeline.run(spark, sf).orderBy("start").collect()
    ids = sorted(str(r.doc_id) for r in found)
    # Texts without words are one group; copies go.
    assert ids == ([] if kind == "empty" else ["1", "2", "3", "4"])
    assert [r.start for r in found] == [sum(x.n_tokens for x in found[:i]) for i in range(len(found))]
