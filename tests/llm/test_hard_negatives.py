import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow.llm import hard_negatives as h

SCHEMA = "id long, label long, vector array<long>"


def plain(rows, anchor, positives=5, negatives=3, share=(50, 95)):
    rows = [r for r in rows if None not in r and None not in r[2]]
    dims = max((len(v) for _, _, v in rows), default=0)
    rows = [(i, label, [*v, *[0] * (dims - len(v))]) for i, label, v in rows]
    found = []
    for n, (a, label, vector) in enumerate(rows):
        if not anchor(a):
            continue
        scored = [
            (-sum(x * y for x, y in zip(vector, v)), i, other == label)
            for m, (i, other, v) in enumerate(rows)
            if m != n
        ]
        scored.sort()
        for p, pid, _ in [s for s in scored if s[2]][:positives]:
            inside = [s for s in scored if not s[2] and -share[0] * p <= -100 * s[0] <= -share[1] * p]
            found += [(a, pid, rank, i, -p, -s) for rank, (s, i, _) in enumerate(inside[:negatives], 1)]
    return sorted(found)


def got(df):
    return sorted(map(tuple, df.collect()))


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    brute.assert_equals_sql(h.op11_hard_negatives(spark, sf), h.OP11_SQL, sf)


def random_rows(seed, n, dims, labels, spread):
    pick = random.Random(seed)
    centres = [[pick.randint(-spread, spread) for _ in range(dims)] for _ in range(6)]
    rows = []
    for _ in range(n):
        centre = pick.choice(centres)
        # Few different values: many ties, equal vectors, ids given twice.
        rows.append((pick.randint(0, 2 * n), pick.randint(0, labels), [c + pick.randint(-1, 1) for c in centre]))
    return rows + rows[: n // 10]


@pytest.mark.parametrize(
    "seed,n,dims,labels,spread,block,group,page",
    [(1, 300, 4, 3, 3, 16, 4, 3), (2, 300, 1, 40, 5, 7, 64, 256), (3, 200, 9, 0, 2, 300, 3, 1), (4, 200, 3, 2, 40_000, 5, 5, 2)],
)
def test_small_blocks_change_nothing(spark, seed, n, dims, labels, spread, block, group, page):
    rows = random_rows(seed, n, dims, labels, spread)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = h.hard_negatives(table, F.col("id") % 5 == 0, 4, 2, (30, 100), block=block, group=group, page=page)
    assert got(found) == plain(rows, lambda i: i % 5 == 0, 4, 2, (30, 100))


def test_blocks_are_left_out(spark):
    """On clustered vectors the bounds keep most blocks from being read."""
    pick = random.Random(7)
    rows = [(i, i % 2, [(i // 100) * 100 + pick.randint(0, 9), 1000 - (i // 100) * 50 + pick.randint(0, 9)]) for i in range(2000)]
    table = spark.createDataFrame(rows, SCHEMA).select("id", "label", (F.col("id") % 50 == 0).alias("anchor"), "vector")
    layout = h.Layout([(0, 2000), (0, 1010)])
    index = h.blocks(table, layout, 20)
    groups, zones = h.anchor_groups(index, layout, 8), h.pages(index, 16)
    whole = groups.select(
        "group", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("anchor"),
        F.lit(0).alias("window"), F.lit(15_000_00).cast("long").alias("least"), F.lit(h.ANY).alias("most"),
    )
    chosen = h._choose(h._limited(groups, whole), zones, layout, True, False)
    assert 0 < chosen.select(F.sum(F.size("wanted"))).head()[0] < 40 * index.count() / 3


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (5, 2), (4, 1)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        keys = h.hilbert_keys(cells, bits)
        path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert len(set(keys)) == len(cells)
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_hundredths(spark):
    values = [-201, -200, -199, -101, -100, -1, 0, 1, 99, 100, 101, 1 << 60, -(1 << 60)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    rows = df.select("v", h._hundredths(F.col("v"), True), h._hundredths(F.col("v"), False)).collect()
    assert [tuple(r) for r in rows] == [(v, -(-v // 100), v // 100) for v in values]


def test_special_tables(spark, sf_dir_of):
    schema = "vec_id long, embedding array<float>, label int"

    def query(rows, columns=("*",)):
        return got(h.op11_hard_negatives(spark, sf_dir_of(embeddings=spark.createDataFrame(rows, schema).selectExpr(*columns))))

    assert query([]) == []
    assert query([(1, [1.0], 1), (2, [1.0], 2)]) == []
    bad = [(50, None, 1), (100, [1.0, None], 1), (150, [float("nan"), 1.0], 1), (200, [float("inf"), 1.0], 1), (250, [1.0], None)]
    assert query(bad) == []
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 1), (2, [0.75, 9.0], 2), (None, [0.8], 3), (3, [0.5], 3), (4, [0.49], 3), *bad]
    clashing = ("*", "1 as id", "2 as block", "3 as `group`", "4 as anchor", "5 as vector", "6 as key")
    # 0 has label 1 now; 3 is filled up with zeros and just inside, 4 outside.
    assert query(rows, clashing) == [(0, 1, 1, 2, 65536, 49152), (0, 1, 2, 3, 65536, 32768)]
    # A repeated anchor is a row: the other one is its positive, and both are anchors.
    twice = [(50, [1.0], 1), (50, [1.0], 1), (3, [0.75], 2)]
    assert query(twice) == [(50, 50, 1, 3, 65536, 49152)] * 2
    assert query([(50, [], 1), (51, [], 1), (52, [], 2)]) == [(50, 51, 1, 52, 0, 0)]


def test_too_large_vectors_are_an_error(spark):
    table = spark.createDataFrame([(0, 1, [1 << 40])], SCHEMA)
    with pytest.raises(ValueError, match="too large"):
        h.hard_negatives(table, F.col("id") == 0)


def test_large_values_are_exact(spark):
    rows = [(i, i % 2, [(1 << 26) + i, -(1 << 26) + 3 * i]) for i in range(20)]
    table = spark.createDataFrame(rows, SCHEMA)
    found = h.hard_negatives(table, F.col("id") % 5 == 0, share=(50, 100))
    assert got(found) == plain(rows, lambda i: i % 5 == 0, share=(50, 100))
