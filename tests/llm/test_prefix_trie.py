import hashlib
import random
import zlib

import brute
import pytest

from basketflow.llm import prefix_trie as p

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """Conversation -> turns (role, text), by the rule of the query. No ties in the order."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {conv: [t for _, t in sorted(turns, key=lambda x: x[0])] for conv, turns in own.items()}
    heads = {conv: zlib.crc32(str(conv).encode()) % 4 for conv in own}
    return {c: own.get(c - c % 20, [])[: heads[c]] + turns[heads[c] :] for c, turns in own.items()}


def plain(conversations):
    members = {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    found = []
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    def subtree(node):
        waiting = [node]
        while waiting:
            node = waiting.pop()
            yield node
            waiting += kids.get(node, [])

    for node, convs in members.items():
        below = list(subtree(node))
        saved = sum((len(members[u]) - 1) * len(brute.words(u[-1][1])) for u in below if u)
        ends = sorted(c for c in convs if len(conversations[c]) == len(node))
        found.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                len(kids.get(node, [])),
                sum(u not in kids for u in below),
                saved,
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert got(p.op12_prefix_trie(spark, sf)) == plain(rebuilt(rows))


def random_rows(seed, convs, most, words):
    """Conversations over few different turns, some equal, some without a leader."""
    pick = random.Random(seed)
    rows = []
    for conv in pick.sample(range(4 * convs), convs):
        for turn in range(pick.randint(1, most)):
            text = " ".join(pick.choice("ab") for _ in range(pick.randint(0, words)))
            rows.append((conv, turn or None, pick.choice(["user", None, ""]), text or None))
    return rows


@pytest.mark.parametrize("seed,block,shard", [(1, 256, 4096), (2, 2, 3), (3, 3, 1), (4, 1, 7), (5, 4, 64)])
def test_blocks_and_shards_change_nothing(spark, monkeypatch, seed, block, shard):
    monkeypatch.setattr(p, "LISTED", 2)
    rows = random_rows(seed, 60, 9, 2)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    nodes, ends = p.trie(p.grafted(p.numbered_turns(table), 20, 3), block, shard)
    joined = nodes.join(p.end_digests(ends), p.NODE, "left").drop(*p.NODE)
    empty = hashlib.sha256().hexdigest()
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got(joined.fillna(empty, ["ends_sha256"]).select(columns)) == plain(rebuilt(rows))


def test_a_few_turns_a_shard(spark, monkeypatch):
    monkeypatch.setattr(p, "SHARD_TURNS", 5)
    rows = random_rows(6, 40, 9, 2)
    table = spark.createDataFrame(rows, SCHEMA)
    placed = p.prefixes(p.grafted(p.numbered_turns(table), 20, 3), 4)
    small = p.shard_nodes(placed, turns=5)
    counted = small.groupBy("key1", "key2").sum("n_convs").collect()
    assert sorted(r[2] for r in counted) == sorted(r[3] for r in plain(rebuilt(rows)))


def test_numbers_over_many_ranges(spark):
    """One conversation with nearly all rows, many of them equal, is numbered without a gap."""
    rows = [(5, None, None, None)] * 300 + [(5, t, "user", f"t{t % 7}") for t in range(300)] + [(6, 0, "user", "x")]
    table = spark.createDataFrame(rows, SCHEMA).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = p.numbered_turns(table)
        assert sorted((r.conv_id, r.pos, r.n) for r in turns.collect()) == [(5, i, 600) for i in range(1, 601)] + [(6, 1, 1)]
        part_sizes = turns.groupBy("conv_id").count().collect()
        assert sorted(map(tuple, part_sizes)) == [(5, 600), (6, 1)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_special_tables(spark, sf_dir_of):
    def query(rows, extra=False):
        table = spark.createDataFrame(rows, SCHEMA)
        if extra:
            table = table.selectExpr("*", "1 as pos", "2 as n", "'x' as key1", "3 as part", "4 as depth")
        return got(p.op12_prefix_trie(spark, sf_dir_of(conversations=table)))

    assert query([]) == []
    assert query([(None, 1, "user", "a")]) == []
    # 1 takes two turns from a conversation that is not there and has only one of its own.
    lone = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 2][0]
    nothing = hashlib.sha256(str(lone).encode()).hexdigest()
    assert query([(lone, 1, "user", "a")], extra=True) == [(lone, 0, None, 1, 0, 1, 0, nothing)]
    rows = [(20, None, None, None), (20, 1, "", "a b"), (40, None, "", ""), (40, 1, None, "a b"), (40, 2, "a", "b"), (41, 1, "ab", "")]
    rows += [(None, 1, "user", "a b"), (60, 1, "", "long " * 50_000)]
    assert query(rows, extra=True) == plain(rebuilt(rows))
    # A turn that is there twice is two turns; equal numbers are ordered alike in all conversations.
    twice = [(20, 1, "user", "a"), (20, 1, "user", "a"), (20, 1, "user", "b"), (40, 1, "user", "b"), (40, 1, "user", "a"), (40, 1, "user", "a")]
    top = [r for r in query(twice) if r[1] == 3]
    assert len(top) == 1 and top[0][3] == 2
