import random
import zlib
from collections import Counter, defaultdict

import pytest

from basketflow.llm import sharding as s

SF = "/root/testdata/sf0.01"


def check(rows, placed, shards):
    """Sizes, checksums, even counts and gapless slots."""
    want = sorted((str(k), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in placed) == want
    slots = defaultdict(list)
    for r in placed:
        slots[r.shard].append(r.slot)
    counts = [len(slots[i]) for i in range(shards)]
    assert set(slots) <= set(range(shards)) and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def parts_of_groups(rows, placed):
    """Of each text that stands more than once: its rows, and in how many shards they are."""
    by_key = {r.doc_id: r.shard for r in placed}
    groups = defaultdict(list)
    for k, t in rows:
        groups[t or ""].append(by_key[k])
    return [(len(v), len(set(v))) for v in groups.values() if len(v) > 1]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    placed = s.op6_shards(spark, SF).collect()
    check(rows, placed, 24)
    assert {(r.law, r.grown_shard) for r in placed} == {("rows", None)}
    assert all(n == 1 for _, n in parts_of_groups(rows, placed))


def test_hot_group_fills_few_shards(spark, docs_of):
    rng = random.Random(2)
    rows = [(i, "hot") for i in range(400)] + [(1000 + i, f"pair {i // 2}") for i in range(200)]
    rows += [(5000 + i, f"alone {i}") for i in range(601)]
    rng.shuffle(rows)
    placed = s.shard_rows(docs_of(rows), shards=24).collect()
    check(rows, placed, 24)
    parts = parts_of_groups(rows, placed)
    hot = [n for size, n in parts if size == 400][0]
    assert hot <= 12  # ten are needed; shards that already hold pairs take fewer
    assert sum(n == 1 for size, n in parts if size == 2) >= 95


def test_only_linked_rows_change_places(spark, docs_of):
    rows = [(i, f"group {i % 30}") for i in range(240)]
    placed = s.shard_rows(docs_of(rows), shards=8).collect()
    check(rows, placed, 8)
    start = 240 - 30  # links that a random deal cuts, nearly
    cut = sum(n - 1 for _, n in parts_of_groups(rows, placed))
    assert cut < start / 2


def test_edge_rows(spark, docs_of):
    rows = [(None, None), (None, ""), (1, "é\n"), (1, "é\n"), (1, "other"), (2, "x" * 300000), (3, None)]
    docs = docs_of(rows).selectExpr("*", "1 AS shard", "2 AS slot", "3 AS `row`", "4 AS `all`", "'y' AS drawn")
    check(rows, s.shard_rows(docs, shards=4).collect(), 4)
    check(rows, s.shard_rows(docs, shards=24).collect(), 24)
    assert s.shard_rows(docs_of([])).count() == 0
    assert s.shard_rows(docs_of([])).columns == s.shard_rows(docs).columns


@pytest.mark.parametrize(("rows", "shards"), [(0, 3), (7, 3), (24, 24), (1000, 24)])
def test_capacities(rows, shards):
    found = s.capacities(rows, shards)
    assert sum(found) == rows and max(found) - min(found) <= 1


def test_quotas_never_overfill():
    class Row:
        def __init__(self, shard, to, n):
            self.shard, self.to, self.n = shard, to, n

    class Wishes:
        def groupBy(self, *_):
            return self

        def agg(self, *_):
            return self

        def collect(self):
            return [Row(0, 1, 10), Row(1, 0, 4), Row(2, 1, 5), Row(1, 2, 1)]

    quota = s._quotas(Wishes(), [0, 3, 0])
    change = Counter()
    for (a, b), n in quota.items():
        change[a] -= n
        change[b] += n
    assert all(change[i] <= room for i, room in enumerate([0, 3, 0]))


def test_rows_without_a_key_are_numbered_in_many_tasks(spark, docs_of):
    from basketflow.llm.ranking import in_ranges, ranked
    from pyspark.sql import functions as F

    rows = [(None, "same")] * 900 + [(None, f"t{i}") for i in range(900)] + [(i, f"k{i}") for i in range(1800)]
    docs = docs_of(rows, 6).withColumn("all", F.lit("")).withColumn("drawn", s.drawn("doc_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in in_ranges(docs, ["all", "drawn", "doc_id"]).groupBy("_part").count().collect()]
        assert len(sizes) == 8 and max(sizes) <= 2 * len(rows) / 8
        found = ranked(docs, "all", "drawn", ["doc_id"], "place").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r.place for r in found) == list(range(len(rows)))
    order = [r.drawn for r in sorted(found, key=lambda r: r.place)]
    assert order == sorted(order)
    check(rows, s.shard_rows(docs_of(rows)).collect(), 24)
