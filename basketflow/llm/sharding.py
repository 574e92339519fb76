"""Sharding by balanced label propagation: linked documents end up together, shards stay even.

Documents with equal texts are linked. All documents are first dealt out evenly; then rounds of
joins move linked documents to the shard that holds most of their neighbours. A document's
neighbours are its group, so it is enough to count each group's members per shard: at most one
row per group and shard, however large the group, instead of a row per pair.

Quotas. A shard's capacity is its share of all rows. Into a shard with room (unlinked documents
give way) as many documents move as there is room for; between two shards without room, equal
numbers change places. Documents beyond a quota stay and try again in the next round. At the end
unlinked documents fill every shard up to its capacity, so counts differ by one at most.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.ranking import drawn, ranked
from basketflow.llm.tables import documents, keep

SHARDS = 24
ROUNDS = 24


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def shard_rows(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, group, shard, slot)`` for every row; shard counts at most one apart.

    ``group`` numbers the rows with equal texts and is null for a text of its own. A null text
    equals an empty one. ``slot`` numbers the rows of a shard from 0, in a pseudo-random order
    that depends on nothing but the keys. Rows with equal keys and texts are interchangeable. An
    empty table gives an empty result.
    """
    text_or_empty = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(text_or_empty) + 8).cast("long").alias("size"),
        F.crc32(text_or_empty.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text_or_empty, 256)).alias("digest"),
        drawn(key).alias("drawn"),
    )
    rows = keep(rows.withColumn("all", F.lit("")), "digests")
    rows = keep(ranked(rows, "all", "drawn", ["doc_id", "digest"], "row").drop("all"), "rows")
    total = rows.count()
    if not total:
        columns = "doc_id", "size", "text_crc32", F.lit(None).cast("long").alias("group"), F.lit(0).alias("shard")
        return rows.select(*columns, F.lit(0).cast("long").alias("slot"))
    group = rows.groupBy("digest").agg(F.min("row").alias("group"), F.count("*").alias("members")).where("members > 1")
    rows = keep(rows.join(keep(group.drop("members"), "groups"), "digest", "left").drop("digest"), "grouped")
    capacity = capacities(total, shards)
    members = rows.where("group IS NOT NULL").select("row", "group", "drawn", (F.col("row") % shards).cast("int").alias("shard"))
    members = propagate(members, capacity, rounds)

    # Unlinked documents fill what is left, in the order of their hash.
    load = _loads(members, shards)
    until, borders = 0, []
    for shard in range(shards):
        until += capacity[shard] - load[shard]
        borders.append(until)
    alone = ranked(rows.where("group IS NULL").withColumn("all", F.lit("")), "all", "drawn", ["row"], "place").drop("all")
    filled = F.size(F.filter(F.array(*map(F.lit, borders)), lambda border: border <= F.col("place"))).alias("shard")
    placed = alone.select("row", filled).unionByName(members.select("row", "shard"))
    placed = rows.join(keep(placed, "placed"), "row")
    return ranked(placed, "shard", "drawn", ["row"], "slot").select(
        "doc_id", "size", "text_crc32", "group", "shard", "slot"
    )


def propagate(members: DataFrame, capacity: list[int], rounds: int) -> DataFrame:
    """``members(row, group, drawn, shard)`` after the moves; no shard exceeds its capacity."""
    members = keep(members, "members")
    for _ in range(rounds):
        room = [c - n for c, n in zip(capacity, _loads(members, len(capacity)), strict=True)]
        moved, members = _round(members, room)
        if not moved:
            break
    return members


def _loads(members: DataFrame, shards: int) -> list[int]:
    """Linked documents per shard: one number for each."""
    load = [0] * shards
    for row in members.groupBy("shard").count().collect():
        load[row.shard] = row["count"]
    return load


def _round(members: DataFrame, room: list[int]) -> tuple[int, DataFrame]:
    """One round of moves: how many there were, and the members after it.

    A document wants the shard that holds more of its group than its own does: the fullest one
    with room, or else the fullest one. Of equally full shards the lower number counts as fuller,
    so two halves of a group do not trade places for ever.
    """
    parts = members.groupBy("group", "shard").agg(F.count("*").alias("n"))
    held = F.struct("n", (-F.col("shard")).alias("s"))
    roomy = F.col("shard").isin([s for s, free in enumerate(room) if free > 0] or [-1])
    best = parts.groupBy("group").agg(
        F.max(held).alias("fullest"), F.max(F.when(roomy, held)).alias("open"), F.count("*").alias("parts")
    )
    wishes = parts.join(best.where("parts > 1"), "group").withColumn("held", held)
    wishes = wishes.withColumn("want", F.when(F.col("open") > F.col("held"), F.col("open")).when(
        F.col("fullest") > F.col("held"), F.col("fullest")
    )).where("want IS NOT NULL")
    wishes = keep(wishes.select("group", "shard", (-F.col("want.s")).alias("to"), "n"), "wishes")
    quota = _quotas(wishes, room)
    if not quota:
        return 0, members
    # A row per ordered pair of shards.
    pairs = members.sparkSession.createDataFrame([(f"{a}>{b}", n) for (a, b), n in quota.items()], "way string, quota long")
    wanting = members.join(wishes.drop("n"), ["group", "shard"]).withColumn("way", F.concat_ws(">", "shard", "to"))
    # A new order each round would not help: a document that had to stay keeps its turn.
    turn = ranked(wanting, "way", "drawn", ["row"], "turn").join(F.broadcast(pairs), "way")
    moves = keep(turn.where(F.col("turn") < F.col("quota")).select("row", "to"), "moves")
    after = members.join(moves, "row", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to")
    return moves.count(), keep(after, "members")


def _quotas(wishes: DataFrame, room: list[int]) -> dict[tuple[int, int], int]:
    """Moves allowed from each shard to each other; a number per ordered pair of shards."""
    wished = {(r.shard, r.to): r.n for r in wishes.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}
    quota = {}
    free = list(room)
    for (a, b), n in sorted(wished.items(), key=lambda x: (-x[1], x[0])):
        back = min(n, wished.get((b, a), 0))  # these change places
        extra = min(n - back, free[b])
        free[b] -= extra
        if back + extra:
            quota[a, b] = back + extra
    return quota


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
