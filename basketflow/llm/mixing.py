"""Interleaving sources by target weights with a Pfair schedule. DataFrame functions only.

Weights are whole parts; a period has as many slots as there are parts, and a slot takes one
block of documents. Block ``k`` (from 0) of a source with ``w`` of ``h`` parts is released at slot
``floor(k h / w)`` and due before slot ``ceil((k + 1) h / w)``. Each slot goes to the released
block that is due first. One slot at a time is one processor, for which this order meets every
deadline; so after any number of slots a source has had its share up to less than one block.

Only the period is scheduled step by step; its length is the sum of the parts, whatever the table
holds. Documents find their slots through one join with that schedule.

A source that has run out leaves its slots empty: the rest moves up and keeps its proportions.
No document is dropped or repeated.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.ranking import drawn, ranked
from basketflow.llm.tables import documents, keep

OTHER = "(other)"
MOST_PARTS = 10_000

# Production weights: parts of a period. Sources without an entry share one.
TARGET_PARTS = {"src0": 6, "src1": 4, "src2": 4, "src3": 3, "src4": 3} | {f"src{i}": 2 for i in range(5, 20)} | {OTHER: 1}
BLOCK_ROWS = 32


def schedule(spark: SparkSession, parts: dict[str, int]) -> DataFrame:
    """One period: ``(class, k, slot, release, deadline, ahead)``, a row per slot.

    ``ahead`` holds, for every class in the order of ``parts``, its blocks in earlier slots.
    """
    period = sum(parts.values())
    if not parts or min(parts.values()) < 1 or period > MOST_PARTS:
        raise ValueError(f"parts are whole numbers from 1 and add up to at most {MOST_PARTS}")
    names, weights = (F.array(*map(F.lit, x)) for x in (parts.keys(), parts.values()))

    def due(weight, done):
        return F.ceil((done + 1) * period / weight).cast("int")

    def release(weight, done):
        return F.floor(done * period / weight).cast("int")

    def step(state, slot):
        ready = F.filter(
            F.transform(
                F.sequence(F.lit(0), F.lit(len(parts) - 1)),
                lambda i: F.struct(
                    due(F.get(weights, i), F.get(state.had, i)).alias("deadline"),
                    i.alias("number"),
                    F.get(state.had, i).alias("k"),
                    release(F.get(weights, i), F.get(state.had, i)).alias("release"),
                ),
            ),
            lambda block: block.release <= slot,
        )
        first = F.array_min(ready)
        return F.struct(
            F.transform(state.had, lambda n, i: n + (i == first.number).cast("int")).alias("had"),
            F.concat(state.slots, F.array(F.struct(first.alias("block"), state.had.alias("ahead")))).alias("slots"),
        )

    block = "struct<deadline: int, number: int, k: int, release: int>"
    start = F.struct(
        F.array_repeat(F.lit(0), len(parts)).alias("had"),
        F.array().cast(f"array<struct<block: {block}, ahead: array<int>>>").alias("slots"),
    )
    slots = F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, step, lambda state: state.slots)
    return spark.range(1).select(F.posexplode(slots).alias("slot", "s")).select(
        F.get(names, F.col("s.block.number")).alias("class"),
        F.col("s.block.k").alias("k"),
        "slot",
        F.col("s.block.release").alias("release"),
        F.col("s.block.deadline").alias("deadline"),
        F.col("s.ahead").alias("ahead"),
    )


def mix(docs: DataFrame, parts: dict[str, int], block_rows: int, key: str = "doc_id", source: str = "source") -> DataFrame:
    """``(doc_id, source, class, block, place, slot, release, deadline, position)`` for every row.

    ``class`` is the source, or ``(other)`` for a source without parts and for null. A class's
    documents are drawn in the order of a hash of the key; ``block`` numbers its blocks, ``place``
    the document in its block. ``slot``, ``release`` and ``deadline`` count slots over all
    periods, and ``position`` counts only the slots that hold a block: sorted by (position,
    place), the documents are mixed. Rows with equal keys are neighbours. An empty table gives an
    empty result.
    """
    parts = parts if OTHER in parts else parts | {OTHER: 1}
    period = sum(parts.values())
    known = F.col(source).isin([name for name in parts if name != OTHER])
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        F.when(known, F.col(source)).otherwise(F.lit(OTHER)).alias("class"),
        drawn(key).alias("drawn"),
    )
    rows = keep(rows, "drawn")
    counts = {r["class"]: r["n"] for r in rows.groupBy("class").agg(F.count("*").alias("n")).collect()}
    blocks = [-(-counts.get(name, 0) // block_rows) for name in parts]
    weight = F.create_map(*[x for name, w in parts.items() for x in (F.lit(name), F.lit(w))])

    rows = ranked(rows, "class", "drawn", ["doc_id", "source"]).withColumn("block", F.floor(F.col("rank") / block_rows))
    rows = rows.withColumn("place", F.col("rank") % block_rows).withColumn("weight", F.element_at(weight, F.col("class")))
    rows = rows.withColumn("period", F.floor(F.col("block") / F.col("weight")))
    rows = rows.withColumn("k", (F.col("block") % F.col("weight")).cast("int"))
    # A row per slot of one period, at most MOST_PARTS.
    rows = rows.join(F.broadcast(schedule(docs.sparkSession, parts)), ["class", "k"])
    had = [
        F.least(F.lit(n).cast("long"), F.col("period") * w + F.get("ahead", F.lit(i)))
        for i, (n, w) in enumerate(zip(blocks, parts.values(), strict=True))
    ]
    position = had[0]
    for h in had[1:]:
        position = position + h
    since = F.col("period") * period
    return rows.select(
        "doc_id",
        "source",
        "class",
        "block",
        "place",
        (since + F.col("slot")).alias("slot"),
        (since + F.col("release")).alias("release"),
        (since + F.col("deadline")).alias("deadline"),
        position.alias("position"),
    )


def in_mixed_order(docs: DataFrame, parts: dict[str, int], block_rows: int, key: str = "doc_id") -> DataFrame:
    """``docs`` with their columns and rows, sorted across partitions by the mix.

    Rows that share a key share the first place of any of them. Written to files, the rows keep
    their order: see ``written_order``.
    """
    placed = mix(docs, parts, block_rows, key)
    places = placed.groupBy(F.col("doc_id").alias("key")).agg(F.min(F.struct("position", "place")).alias("at"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), F.col(key).alias("id"))
    placed = whole.join(keep(places, "places"), F.col("id").eqNullSafe(F.col("key")))
    return placed.repartitionByRange("at").sortWithinPartitions("at", "id").select("document.*")


def written_order() -> list[Column]:
    """Columns that sort the rows of a Parquet table as the job that wrote it had them."""
    part = F.regexp_extract("_metadata.file_name", "^part-([0-9]+)", 1).cast("long")
    return [part, F.col("_metadata.file_name"), F.col("_metadata.row_index")]


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir), TARGET_PARTS, BLOCK_ROWS)


def oracle(parts: dict[str, int], block_rows: int) -> str:
    """The same mix in SQL: the schedule by recursion over slots."""
    period, n = sum(parts.values()), len(parts)
    listed = ", ".join(f"({i}, '{name}', {w})" for i, (name, w) in enumerate(parts.items(), 1))
    weights = "[" + ", ".join(str(w) for w in parts.values()) + "]"
    return f"""
WITH RECURSIVE parts(number, class, weight) AS (VALUES {listed}),
run(slot, had, pick) AS (
  SELECT -1, list_transform(range(0, {n}), lambda x: 0), NULL::STRUCT(deadline BIGINT, number BIGINT)
  UNION ALL
  SELECT slot + 1, list_transform(had, lambda x, i: x + (i = next.number)::INT), next
  FROM (
    SELECT slot, had, list_min(list_filter(list_transform(range(1, {n} + 1), lambda i:
      CASE WHEN (had[i] * {period}) // ({weights}[i]) <= slot + 1 THEN
        {{'deadline': ((had[i] + 1) * {period} + {weights}[i] - 1) // ({weights}[i]), 'number': i}} END),
      lambda b: b IS NOT NULL)) AS next
    FROM run WHERE slot + 1 < {period}
  )
),
slots AS (
  SELECT p.class, p.weight, run.slot, run.had[p.number] - 1 AS k, run.had, run.pick.number AS number
  FROM run JOIN parts p ON p.number = run.pick.number
),
rows AS (
  SELECT doc_id, source, coalesce(p.class, '{OTHER}') AS class,
    row_number() OVER (PARTITION BY coalesce(p.class, '{OTHER}')
      ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, source) - 1 AS rank
  FROM documents LEFT JOIN parts p ON p.class = source AND p.class <> '{OTHER}'
),
counts AS (SELECT class, (count(*) + {block_rows} - 1) // {block_rows} AS blocks FROM rows GROUP BY 1),
placed AS (
  SELECT r.doc_id, r.source, r.class, rank // {block_rows} AS block, rank % {block_rows} AS place,
    (rank // {block_rows}) // p.weight AS period, p.weight, (rank // {block_rows}) % p.weight AS k
  FROM rows r JOIN parts p USING (class)
),
used AS (
  SELECT period, s.slot, s.class, s.k, sum(least(coalesce(c.blocks, 0), period * p.weight + s.had[p.number]
    - (p.number = s.number)::INT)) AS position
  FROM (SELECT DISTINCT period, class, k FROM placed) b JOIN slots s USING (class, k), parts p LEFT JOIN counts c ON c.class = p.class
  GROUP BY ALL
)
SELECT doc_id, source, class, block, place, period * {period} + slot AS slot,
  period * {period} + (k * {period}) // weight AS release,
  period * {period} + ((k + 1) * {period} + weight - 1) // weight AS deadline, position::BIGINT AS position
FROM placed JOIN used USING (period, class, k)
"""


OP4_SQL = oracle(TARGET_PARTS, BLOCK_ROWS)
