"""A trie of conversation prefixes by vertical bitmaps.

Every distinct sequence of first turns is a node. Its key is the exclusive or, over its turns, of a
128-bit hash of position and turn; so all prefixes of a conversation, however long, have their keys
from running aggregates over blocks of ``BLOCK`` positions and the totals of the blocks before.
No text is moved: a turn is 16 bytes of digest and its number of words.

*Shards.* Conversations are dealt by block of positions and ranges of their ids, and cut into
shards of at most ``SHARD_CONVERSATIONS`` conversations and ``SHARD_TURNS`` turns. A shard indexes
(position, turn) to a bitset of its conversations and goes down depth first: the bitset of a node,
intersected with the postings of the next position, gives the children; counting bits gives
members, the lowest bit the smallest conversation, and the bitset of the conversations that stop
there the end list. A prefix of one conversation needs no intersection: the rest is a chain.
A block other than the first begins with the groups of conversations that have the same key so far.

*Whole trie.* Nodes of shards with the same key are added up. What a node sums over its subtree is
a sum over its members: going down, conversation ``m`` is the smallest member of every node from
some depth on. The words of its turns before that depth, ``shared``, are said by a smaller one
too, and the part of them from a node on is what ``m`` adds to the node's saved tokens; ``m`` adds
a leaf if it is the smallest member of a childless node. So no step goes level by level, and a
node with many members is summed up before it is shuffled.

Defined results: rows without ``conv_id`` belong to no conversation. A null role or text counts as
empty. Turns are ordered by ``turn``, null first, ties by a digest of role and text; a repeated row
is a turn of its own. A table without conversations has no nodes, not even a root. Only the
four columns of the table are read, so further columns cannot clash. Two different sequences
would be taken for one if their 128-bit keys met, which is left out of account.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketflow.llm.tables import keep

BLOCK = 256  # positions
SHARD_CONVERSATIONS = 4096
SHARD_TURNS = 1 << 16
LISTED = 1024  # ids in one row of an end list

NODE = ["key1", "key2"]
PARENT = ["parent1", "parent2"]

FOUND = (
    "key1 long, key2 long, depth long, parent1 long, parent2 long, conv_id long, n_convs long, "
    "words long, before long, ends array<long>"
)


# Turns


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, n, digest, words)``: a row per turn, numbered from 1 to ``n``.

    Rows are sorted in ranges, so a conversation may span many tasks; its places in a range
    and the sizes of its ranges before, at most one range more than there are tasks, give the
    number.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", "turn", "digest", "row"]
    # A table, since finding ranges takes a pass of its own.
    ranges = keep(turns, "digests").repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = ranges.select(
        "conv_id",
        "digest",
        "words",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("place"),
    )
    ranges = keep(ranges, "turns")
    spans = ranges.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count("*").alias("size"))
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "conv_id",
        "part",
        (F.col("first") - F.coalesce(F.sum("size").over(earlier), F.lit(0))).alias("first"),
        F.sum("size").over(whole).alias("n"),
    )
    joined = ranges.join(spans, ["conv_id", "part"])
    return joined.select("conv_id", (F.col("place") - F.col("first") + 1).alias("pos"), "n", "digest", "words")


def with_roots(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """``turns`` and a row of position 0 for each conversation of ``sizes(conv_id, n)``."""
    return turns.unionByName(
        sizes.select(
            "conv_id",
            F.lit(0).cast("long").alias("pos"),
            "n",
            F.lit(None).cast("binary").alias("digest"),
            F.lit(0).cast("long").alias("words"),
        )
    )


def grafted(turns: DataFrame, every: int, most: int) -> DataFrame:
    """Conversations whose first turns are those of another: what ``trie`` takes.

    Conversation ``c`` begins with the first ``h`` turns of conversation ``c - c % every``, all if
    there are fewer, and goes on with its own after its first ``h``; ``h`` is the CRC-32 of the
    decimal ``c``, modulo ``most + 1``. ``%`` has the sign of ``c``, as in SQL.
    """
    turns = keep(turns, "numbered")
    convs = turns.where("pos = 1").select(
        "conv_id",
        "n",
        F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most + 1)).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
    )
    bases = convs.where("conv_id = base").select("base", F.col("n").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n")
    )
    convs = keep(convs, "grafts")
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") <= most))
    heads = heads.select(F.col("conv_id").alias("base"), "pos", "digest", "words")
    begun = convs.join(heads, "base").where("pos <= h").select("conv_id", "pos", "n", "digest", "words")
    own = turns.drop("n").join(convs, "conv_id").where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "n", "digest", "words")
    return with_roots(begun.unionByName(own), convs)


# Prefixes


def prefixes(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The turns with the key of the prefix that ends there, of the one before, and words before.

    Running values go over one block of a conversation; the totals of the blocks before are joined
    on, for conversations that are longer than a block.
    """
    hashed = [
        F.when(F.col("pos") > 0, F.xxhash64(F.lit(seed), "pos", "digest")).otherwise(0).alias(f"hash{seed}")
        for seed in (1, 2)
    ]
    rows = turns.select(
        "conv_id", "pos", "words", *hashed, F.expr(f"pos div {block}").alias("block"), (F.col("pos") == F.col("n")).alias("ends")
    )
    running = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(
        "*",
        F.bit_xor("hash1").over(running).alias("key1"),
        F.bit_xor("hash2").over(running).alias("key2"),
        (F.sum("words").over(running) - F.col("words")).alias("before"),
    )
    rows = keep(rows, "blocks")
    # The last row of each full block has its totals.
    totals = rows.where(F.col("pos") % block == block - 1).select(
        "conv_id", "block", "key1", "key2", (F.col("before") + F.col("words")).alias("sum")
    )
    past = Window.partitionBy("conv_id").orderBy("block")
    totals = totals.select(
        "conv_id",
        (F.col("block") + 1).alias("block"),
        F.bit_xor("key1").over(past).alias("past1"),
        F.bit_xor("key2").over(past).alias("past2"),
        F.sum("sum").over(past).alias("past"),
    )
    none = F.lit(0).cast("long")
    rows = rows.join(totals, ["conv_id", "block"], "left").select(
        "conv_id",
        "pos",
        "block",
        "words",
        "ends",
        "hash1",
        "hash2",
        *[F.col(f"key{i}").bitwiseXOR(F.coalesce(f"past{i}", none)).alias(f"key{i}") for i in (1, 2)],
        (F.col("before") + F.coalesce("past", none)).alias("before"),
    )
    parents = [F.col(f"key{i}").bitwiseXOR(F.col(f"hash{i}")).alias(f"parent{i}") for i in (1, 2)]
    return rows.select("*", *parents)


# Shards


def shard_nodes(placed: DataFrame, conversations: int = SHARD_CONVERSATIONS, turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of every shard with members, smallest member and end list (``FOUND``).

    An end list of more than ``LISTED`` ids goes on in further rows, which count no members. Lists
    of a node from different shards hold ids of different ranges.
    """
    columns = ["block", "conv_id", "pos", "words", "ends", "hash1", "hash2", *NODE, *PARENT, "before"]
    dealt = placed.select(columns).repartitionByRange("block", "conv_id").sortWithinPartitions("block", "conv_id", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, conversations, turns):
            yield _nodes(shard)

    return dealt.mapInArrow(run, FOUND)


def _shards(batches: Iterator[pa.RecordBatch], conversations: int, turns: int) -> Iterator[dict[str, np.ndarray]]:
    """Whole pieces (a conversation's turns in a block) of one block, up to the size of a shard."""
    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        waiting.append(batch)
        rows += len(batch)
        if rows >= turns:
            rest = yield from _cut(waiting, conversations, turns, last=False)
            waiting, rows = [rest], len(rest)
    if waiting:
        yield from _cut(waiting, conversations, turns, last=True)


def _cut(waiting: list[pa.RecordBatch], conversations: int, turns: int, last: bool):
    table = pa.Table.from_batches(waiting).combine_chunks()
    block, conv = table["block"].to_numpy(), table["conv_id"].to_numpy()
    new = np.ones(len(conv), bool)
    new[1:] = (block[1:] != block[:-1]) | (conv[1:] != conv[:-1])
    borders = np.append(np.flatnonzero(new), len(conv))
    if not last:
        borders = borders[:-1]  # the last piece may go on in the next batch
    begin = 0
    for i in range(1, len(borders)):
        end = i == len(borders) - 1
        full = i - begin == conversations or (not end and borders[i + 1] - borders[begin] > turns)
        if full or (end and last) or (not end and block[borders[i]] != block[borders[begin]]):
            part = table.slice(borders[begin], borders[i] - borders[begin])
            yield {name: part[name].to_numpy() for name in part.column_names}
            begin = i
    return table.slice(borders[begin] if len(borders) else 0).combine_chunks().to_batches()[0] if not last else None


def _nodes(shard: dict[str, np.ndarray]) -> pa.RecordBatch:
    """The nodes of a shard, depth first."""
    conv, pos, ends = shard["conv_id"], shard["pos"], shard["ends"]
    first = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))  # row where a conversation begins
    member = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(conv))))
    place = pos - pos[0]  # all pieces begin at the start of their block
    # The vertical index: a number per (position, turn), and the bitset of its conversations.
    order = np.lexsort((member, shard["hash2"], shard["hash1"], place))
    same = [np.diff(shard[name][order]) != 0 for name in ("pos", "hash1", "hash2")]
    starts = np.flatnonzero(np.append(True, same[0] | same[1] | same[2]))
    posting = np.empty(len(conv), np.int64)
    posting[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(conv))))
    bitsets = [_bits(x) for x in np.split(member[order], starts[1:])]
    depths = range(int(place.max()) + 1)
    alive = [_bits(member[place == d]) for d in depths] + [0]
    ending = [_bits(member[(place == d) & ends]) for d in depths]
    after = np.append(first[1:], len(conv)).tolist()
    first, posting = first.tolist(), posting.tolist()

    rows: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    lists: dict[int, list[int]] = {}  # by row
    many_rows, many_counts = [], []
    parents = np.stack([shard["parent1"], shard["parent2"]])[:, first]
    _, group = np.unique(parents, axis=1, return_inverse=True)
    group = group.ravel()
    waiting = [(_bits(np.flatnonzero(group == g)), 0) for g in range(int(group.max()) + 1)] if group.any() else [(alive[0], 0)]
    while waiting:
        parent, depth = waiting.pop()
        rest = parent & alive[depth]
        while rest:
            low = (rest & -rest).bit_length() - 1
            row = first[low] + depth
            child = parent & bitsets[posting[row]]
            rest &= ~child
            n = child.bit_count()
            if n == 1:  # a chain to the end of the piece
                chain = np.arange(row, after[low])
                rows.append(chain)
                counts.append(np.ones(len(chain), np.int64))
                if ends[chain[-1]]:
                    lists[int(chain[-1])] = [int(conv[chain[-1]])]
                continue
            many_rows.append(row)
            many_counts.append(n)
            stopped = child & ending[depth]
            if stopped:
                lists[row] = conv[np.take(first, _members(stopped))].tolist()
            waiting.append((child, depth + 1))
    rows.append(np.array(many_rows, np.int64))
    counts.append(np.array(many_counts, np.int64))
    row, count = np.concatenate(rows), np.concatenate(counts)
    listed = [lists.get(r) for r in row.tolist()]
    # Rows for what is left of long end lists.
    more = [(r, ids[i : i + LISTED]) for r, ids in zip(row.tolist(), listed, strict=True) if ids for i in range(LISTED, len(ids), LISTED)]
    listed = [ids and ids[:LISTED] for ids in listed] + [ids for _, ids in more]
    row = np.append(row, np.array([r for r, _ in more], np.int64))
    count = np.append(count, np.zeros(len(more), np.int64))
    out = {name: shard[name][row] for name in (*NODE, "pos", *PARENT, "conv_id")}
    out |= {"n_convs": count, "words": shard["words"][row], "before": shard["before"][row]}
    arrays = [pa.array(values, pa.int64()) for values in out.values()]
    names = ["depth" if name == "pos" else name for name in out]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(listed, pa.list_(pa.int64()))], [*names, "ends"])


def _bits(members: np.ndarray) -> int:
    """The bitset of some numbers."""
    if len(members) < 8:
        return sum(1 << m for m in members.tolist())
    flags = np.zeros(int(members.max()) + 1, np.uint8)
    flags[members] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _members(bits: int) -> np.ndarray:
    data = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(data, bitorder="little"))


# Trie


def trie(turns: DataFrame, block: int = BLOCK, conversations: int = SHARD_CONVERSATIONS) -> tuple[DataFrame, DataFrame]:
    """``(nodes, ends)`` of conversations given as ``(conv_id, pos, n, digest, words)``.

    Every conversation has a row of position 0, as ``with_roots`` adds it, and one for each
    position up to ``n``. A row of ``nodes`` is a prefix: ``key1, key2, depth``, the smallest
    member ``conv_id`` and that of the node above ``parent_conv_id`` (null for the root), whose
    turns up to ``depth`` spell it out, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``. ``ends(key1, key2, ids)`` lists the conversations that stop at a node, in
    ascending lists of up to ``LISTED`` ids that do not overlap.
    """
    placed = keep(prefixes(turns, block), "prefixes")
    found = keep(shard_nodes(placed, conversations), "shard-nodes")
    nodes = found.groupBy(*NODE, "depth").agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        *[F.min(c).alias(c) for c in (*PARENT, "before")],
    )
    nodes = keep(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy(*[F.col(p).alias(k) for p, k in zip(PARENT, NODE, strict=True)])
    nodes = nodes.join(children.agg(F.count("*").alias("n_children")), NODE, "left")
    nodes = keep(nodes.fillna(0, ["n_children"]), "nodes-with-children")

    smallest = nodes.groupBy("conv_id").agg(
        F.min("before").alias("shared"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    whole = placed.where("ends").select("conv_id", (F.col("before") + F.col("words")).alias("all"))
    share = whole.join(smallest, "conv_id", "left").select(
        "conv_id", F.coalesce("shared", "all").alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf")
    )
    share = keep(share, "shares")
    sums = (
        placed.select("conv_id", "before", *NODE)
        .join(share, "conv_id")
        .groupBy(*NODE)
        .agg(
            F.sum("leaf").alias("n_leaves"),
            F.sum(F.greatest(F.col("shared") - F.col("before"), F.lit(0))).alias("saved_tokens"),
        )
    )
    above = nodes.select(*[F.col(k).alias(p) for p, k in zip(PARENT, NODE, strict=True)], F.col("conv_id").alias("parent_conv_id"))
    below = nodes.where("depth > 0").join(above, PARENT)
    top = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    columns = [*NODE, "depth", "conv_id", "parent_conv_id", "n_convs", "n_children"]
    nodes = below.select(columns).unionByName(top.select(columns)).join(sums, NODE)
    ends = found.where("ends is not null").select(*NODE, F.col("ends").alias("ids"))
    return nodes, ends


def end_digests(ends: DataFrame) -> DataFrame:
    """``(key1, key2, ends_sha256)``: the SHA-256 of all ids of a node, ascending, comma-joined.

    A digest is taken in one go over the lists of its node, in order, so a node's ids, however
    many, pass through one task; that holds one list at a time.
    """
    dealt = ends.select(*NODE, "ids", F.col("ids")[0].alias("first")).repartition(*NODE)
    dealt = dealt.sortWithinPartitions(*NODE, "first").drop("first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, done = None, hashlib.sha256(), []
        for batch in batches:
            for key1, key2, ids in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                joined = ",".join(map(str, ids)).encode()
                if (key1, key2) == now:
                    digest.update(b"," + joined)
                    continue
                if now:
                    done.append((*now, digest.hexdigest()))
                now, digest = (key1, key2), hashlib.sha256(joined)
            yield _digests(done)
            done = []
        yield _digests([*done, (*now, digest.hexdigest())] if now else [])

    return dealt.mapInArrow(run, "key1 long, key2 long, ends_sha256 string")


def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    kinds = {"key1": pa.int64(), "key2": pa.int64(), "ends_sha256": pa.string()}
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds.values())], list(kinds)
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each begun with turns of the one that leads its score."""
    turns = numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    nodes, ends = trie(grafted(turns, every=20, most=3))
    nothing = hashlib.sha256().hexdigest()
    return nodes.join(end_digests(ends), NODE, "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
