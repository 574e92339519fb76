import random

import brute
import numpy as np
import pytest

from basketflow.llm import simhash
from basketflow.llm.components import components

SF = "/root/testdata/sf0.001"


def found(df):
    return sorted((r.doc_id, r.fingerprint, r.component_id) for r in df.collect())


def expected(rows, bits=4):
    prints = {i: brute.simhash(t) for i, t in rows}
    roots = brute.groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= bits)
    return sorted((i, f"{p:016x}", roots[i]) for i, p in prints.items())


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(simhash.op10_simhash(spark, SF)) == expected(rows)


def test_edge_texts(spark, docs_of, sf_dir_of):
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(40000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "oNE  TWO"), (6, "É È"), (7, "é è"),
            (8, long), (9, long + " end"), (10, "a b c d e"), (11, "\x1c x"), (12, "x")]
    sf = sf_dir_of(documents=docs_of(rows))
    assert found(simhash.op10_simhash(spark, sf)) == expected(rows)


def test_empty_table_null_keys_and_more_columns(spark, docs_of):
    assert simhash.near_duplicates(docs_of([]), text="text").count() == 0
    docs = docs_of([(None, "a b c"), (None, "a b c"), (7, "z y x w v u")]).selectExpr("*", "1 AS fingerprint", "2 AS root")
    rows = simhash.near_duplicates(docs).collect()
    assert sorted(str(r.component_id) for r in rows) == ["7", "None", "None"]
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == 2


def test_keep_first_keeps_one_row_per_group(spark, docs_of):
    rows = [(3, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (9, "q r s t u"), (4, None), (5, "")]
    kept = sorted(r.doc_id for r in simhash.keep_first(docs_of(rows)).collect())
    assert kept == [2, 4, 9]


@pytest.mark.parametrize("tile", [4096, 16])
def test_buckets_of_any_size(spark, tmp_path, monkeypatch, tile):
    """Chains, clusters and noise; small tiles split every bucket."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    centre = int(codes[0])
    near = [centre ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 64, (150, 3))]
    chain = [int(codes[1])]
    for bit in range(0, 60, 4):
        chain.append(chain[-1] ^ (0xF << bit))
    values = sorted({*map(int, codes), *near, *chain})
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    df = spark.createDataFrame(signed, "fingerprint long").repartition(4)
    roots = {r.fingerprint % (1 << 64): r.root for r in simhash.groups(df, 4).collect()}
    want = brute.groups(values, lambda a, b: (a ^ b).bit_count() <= 4)
    assert set(roots) == set(values)
    pairs = {(want[v], roots[v]) for v in values}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_a_crowded_value_sends_each_code_a_fixed_number_of_times(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 64)
    rng = np.random.default_rng(6)
    for n in (1000, 8000):
        # All agree in the first block; 64 bits by five blocks are 12 or 13 each.
        codes = rng.integers(0, 1 << 52, n, dtype=np.int64)
        rows = [(0, 7, int(c)) for c in codes]
        coded = spark.createDataFrame(rows, "block int, value long, code long")
        cuts = [64 * i // 5 for i in range(6)]
        dealt = simhash.buckets(coded, cuts, 4)
        assert dealt.count() <= 5 * n
        assert dealt.groupBy("bucket").count().agg({"count": "max"}).head()[0] <= 2 * 64


def test_components_of_long_path(spark):
    rng = random.Random(3)
    names = list(range(300))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(299) if i != 150] + [(1000, 1001), (1000, 1000)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    sets = {}
    for node, root in roots.items():
        sets.setdefault(root, set()).add(node)
    assert sorted(map(len, sets.values())) == [2, 149, 151]
