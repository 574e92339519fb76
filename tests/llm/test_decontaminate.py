import random

import numpy as np
import pytest

from basketflow.llm import decontaminate as d

SF = "/root/testdata/sf0.001"
ITEMS = "item_id long, text string"


def plain(text):
    table = d._plain_table()
    return "".join(map(chr, d.characters(text, table).tolist()))


def least_edits(item, text):
    """Fewest edits that turn the item into any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def expected(docs, items):
    found = {}
    for key, text in docs:
        for item, sought in items:
            if text and len(sought) >= d.Q:
                edits = least_edits(plain(sought), plain(text))
                if edits <= d.edit_budget(len(sought)):
                    found[key, item] = edits
    return found


def test_grams_hash_alike():
    codes = np.frombuffer("abcdefghijklm abcdefghijklm".encode("utf-32-le"), np.uint32)
    grams = d.gram_hashes(codes)
    assert len(grams) == len(codes) - d.Q + 1 and grams[0] == grams[14] and len(set(grams.tolist())) == len(grams) - 4


def test_query_finds_exactly_the_documents_with_items(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    found = {(r.doc_id, r.item_id): (r.begin, r.end, r.edits) for r in d.op2_decontaminate(spark, SF).collect()}
    verbatim = {(x.doc_id, i.item_id) for x in docs for i in items if i.text in (x.text or "")}
    assert verbatim and verbatim <= set(found)
    texts, sought = {x.doc_id: x.text for x in docs}, {i.item_id: i.text for i in items}
    for (doc, item), (begin, end, edits) in found.items():
        assert edits <= d.edit_budget(len(sought[item]))
        assert least_edits(plain(sought[item]), plain(texts[doc][begin:end])) == edits


@pytest.mark.parametrize("scan", [1 << 21, 500])
def test_edited_passages_equal_brute_force(spark, docs_of, monkeypatch, scan):
    monkeypatch.setattr(d, "SCAN_CHARS", scan)
    rng = random.Random(4)
    letters = "abcdef ghijkl\n"

    def text(n):
        return "".join(rng.choices(letters, k=n))

    items = [(n, text(rng.randrange(12, 130))) for n in range(6)] + [(6, "short"), (7, None), (8, ""), (None, text(40))]
    docs = [(1, None), (2, ""), (3, "tiny")]
    for n in range(4, 30):
        sought = list(rng.choice(items[:6])[1])
        for _ in range(rng.randrange(0, int(len(sought) * 0.12) + 1)):
            at = rng.randrange(len(sought))
            sought[at : at + 1] = rng.choice(["", "x", text(2)])
        docs.append((n, text(rng.randrange(0, 60)) + "".join(sought).upper() + text(rng.randrange(0, 60))))
    found = d.contaminated(docs_of(docs), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id): r.edits for r in found} == expected(docs, [i for i in items if i[1]])


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, d.contaminated(docs, items).collect()))
    monkeypatch.setattr(d, "BLOCK_CHARS", 3000)
    assert len(list(d.blocks_of(items))) > 2
    assert sorted(map(tuple, d.contaminated(docs, items).collect())) == whole


def test_keep_clean(spark, docs_of):
    item = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(1, f"so {item} it was"), (2, "clean"), (2, f"x {item}"), (None, item), (None, None), (3, ""), (4, "word " * 200000 + item)]
    docs = docs_of(rows).selectExpr("*", "1 AS item_id")
    items = spark.createDataFrame([(1, item), (1, item), (2, None)], ITEMS)
    kept = d.keep_clean(docs, items)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "None"] and kept.columns == docs.columns
    assert d.keep_clean(docs, items.limit(0)).count() == len(rows)
    assert d.contaminated(docs_of([]), items).count() == 0
    found = d.contaminated(docs_of([(4, rows[-1][1])]), items).first()
    assert (found.begin, found.end) == (1000000, 1000000 + len(item))


def test_items_of_any_length_are_aligned():
    rng = random.Random(11)
    item = "".join(rng.choice("abcdefgh ") for _ in range(30000))
    changed = list(item)
    for at in range(100, 30000, 600):  # 50 changes of a character
        changed[at] = "#"
    texts = ["x" * 40 + item, None, "y" * 7 + "".join(changed) + "z" * 9, item[: len(item) // 2], "".join(changed)[200:]]
    items = d.Items.of([(5, item)], d.EDIT_SHARE)
    found = sorted(items.search_all(texts))
    assert found[:2] == [(0, 0, 40, 30040, 0), (2, 0, 7, 30007, 50)]
    # What is cut off counts as edits: 199 characters without a change, and the 49 changes after them.
    assert [(t, edits) for t, _, _, _, edits in found[2:]] == [(4, 249)]
