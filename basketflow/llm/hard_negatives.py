"""Hard negatives from integer vectors, over Hilbert-ordered blocks with zone maps.

*Index.* Rows are sorted by label and by the place of their vector on a Hilbert curve through all
dimensions, and packed into blocks: one row of a Parquet table holds up to ``BLOCK`` vectors, with
their least and greatest value in every dimension and of the label (the zone map). Every row
is in the index.

*Search.* An anchor asks for the best ``k`` rows of its own label, or of other labels, with scores
between ``least`` and ``most``. For an anchor ``a`` and a block with values from ``lo`` to ``hi`` the
score lies between ``sum(a+ lo + a- hi)`` and ``sum(a+ hi + a- lo)``, ``a+`` and ``a-`` being the
positive and the negative part. A first pass reads one block per anchor, the one of the greatest upper
bound; the ``k``-th best score found there raises ``least``. The second pass reads every block whose
bounds meet a window of an anchor, so the result is exact, however loose the bounds are.

Anchors are packed into groups of ``GROUP`` and zone maps into pages of ``PAGE``. Every group meets
every page (a query set against all rows, in blocks), but only the blocks chosen, and of a group
only the anchors that chose them, are compared. Nothing is broadcast or collected but the extent of
each dimension, for the curve.

Defined results: rows without id, label or vector, or with a null or not finite component take no
part. A shorter vector goes on with zeros. Repeated rows, and different rows under one id, are rows
of their own: each is an anchor, and the others are among its positives or negatives. Ties go to the
smaller id. A table without anchors or without rows gives no rows. Other columns are not read, so
they cannot clash. Scores are exact 64-bit integers; vectors too large for that are an error.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketflow.llm.tables import keep

BLOCK = 2048  # vectors
GROUP = 512  # anchors
PAGE = 256  # zone maps
ANY = 1 << 62  # a score beyond all scores

ZONE = "label_lo long, label_hi long, lo binary, hi binary"


# Curve


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve through ``cells`` (a row per point, ``bits`` bits per dimension).

    Places are byte strings whose order is that of the curve. The transform goes from the
    highest bit down: where a dimension's bit is set, the lower bits of the first dimension are
    inverted, else they are exchanged with it; a Gray code over all dimensions follows.
    """
    x = cells.astype(np.uint32).T.copy()
    if not len(x):
        return [b""] * cells.shape[0]
    for bit in range(bits - 1, 0, -1):
        low = np.uint32((1 << bit) - 1)
        for axis in x:
            is_set = (axis >> np.uint32(bit)) & np.uint32(1) == 1
            swap = np.where(is_set, np.uint32(0), (x[0] ^ axis) & low)
            x[0] ^= np.where(is_set, low, swap)
            axis ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    flip = np.zeros(x.shape[1], np.uint32)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint32(bit)) & np.uint32(1) == 1, np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= flip
    planes = [(x >> np.uint32(bit)).astype(np.uint8) & 1 for bit in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes).T, axis=1)
    return [row.tobytes() for row in packed]


class Layout:
    """Dimensions, their extents, and the type that holds all values."""

    def __init__(self, extents: list[tuple[int, int]]):
        self.lo = np.array([lo for lo, _ in extents], np.float64)
        self.span = np.maximum(np.array([hi - lo for lo, hi in extents], np.float64), 1)
        self.dims = len(extents)
        self.bits = min(16, max(4, 64 // max(self.dims, 1)))
        most = max((max(abs(lo), abs(hi)) for lo, hi in extents), default=0)
        if most * most * self.dims >= 1 << 56:
            raise ValueError("vectors are too large for exact 64-bit scores")
        self.type = next(t for t in ("<i2", "<i4", "<i8") if most <= np.iinfo(t).max)
        # Products of float64 matrices are exact up to 2**53, and much faster.
        self.work = np.float64 if most * most * self.dims < 1 << 53 else np.int64

    def matrix(self, vectors: pa.ListArray) -> np.ndarray:
        """Vectors as rows, filled up with zeros."""
        length = vectors.value_lengths().to_numpy(zero_copy_only=False)
        full = np.zeros((len(vectors), self.dims), self.type)
        full[np.arange(self.dims) < length[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
        return full

    def keys(self, matrix: np.ndarray) -> list[bytes]:
        cells = np.clip((matrix - self.lo) / self.span, 0, 1) * ((1 << self.bits) - 1)
        return hilbert_keys(cells.astype(np.uint32), self.bits)

    def read(self, data: bytes) -> np.ndarray:
        size = self.dims * np.dtype(self.type).itemsize
        return np.frombuffer(data, self.type).reshape(len(data) // size if size else 1, self.dims).astype(self.work)


# Index


def blocks(rows: DataFrame, layout: Layout, size: int = BLOCK) -> DataFrame:
    """The index of ``rows(id, label, vector, anchor)``: a row per block."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = layout.matrix(batch.column(3))
            columns = [batch.column(i) for i in range(3)]
            columns += [pa.array(layout.keys(matrix), pa.binary()), pa.array([v.tobytes() for v in matrix], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "anchor", "key", "vector"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches, size):
            matrix = np.frombuffer(b"".join(rows["vector"].to_pylist()), layout.type).reshape(len(rows), layout.dims)
            label = rows["label"].to_numpy()
            yield _one_row(
                {
                    "label_lo": int(label.min()),
                    "label_hi": int(label.max()),
                    "lo": matrix.min(axis=0).tobytes(),
                    "hi": matrix.max(axis=0).tobytes(),
                    "ids": rows["id"].to_numpy().astype("<i8").tobytes(),
                    "labels": label.astype("<i8").tobytes(),
                    "anchors": rows["anchor"].to_numpy(zero_copy_only=False).astype("u1").tobytes(),
                    "vectors": matrix.tobytes(),
                }
            )

    order = ["label", "key", "id", "row"]
    curve = rows.select("id", "label", "anchor", "vector").mapInArrow(
        keyed, "id long, label long, anchor boolean, key binary, vector binary"
    )
    # A number tells equal rows apart, so that ranges can part them; finding ranges is a pass of its own.
    curve = keep(curve.withColumn("row", F.monotonically_increasing_id()), "curve")
    sorted_rows = curve.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"{ZONE}, ids binary, labels binary, anchors binary, vectors binary"
    found = sorted_rows.select("id", "label", "anchor", "vector").mapInArrow(packed, schema)
    return keep(found.withColumn("block", F.monotonically_increasing_id()), "blocks")


def pages(index: DataFrame, size: int = PAGE) -> DataFrame:
    """Zone maps, ``size`` in a row."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches, size):
            numbers = {c: rows[c].to_numpy().astype("<i8").tobytes() for c in ("block", "label_lo", "label_hi")}
            yield _one_row({**numbers, **{c: b"".join(rows[c].to_pylist()) for c in ("lo", "hi")}})

    zones = index.select("block", "label_lo", "label_hi", "lo", "hi")
    found = zones.mapInArrow(packed, "block binary, label_lo binary, label_hi binary, lo binary, hi binary")
    return keep(found, "pages")


def anchor_groups(index: DataFrame, layout: Layout, size: int = GROUP) -> DataFrame:
    """Anchors, neighbours on the curve together: block, place in it, id, label and vector."""

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, labels, flags, vectors in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = np.flatnonzero(np.frombuffer(flags, "u1"))
                matrix = np.frombuffer(vectors, layout.type).reshape(-1, layout.dims) if layout.dims else at[:0]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), block)),
                        pa.array(at),
                        pa.array(np.frombuffer(ids, "<i8")[at]),
                        pa.array(np.frombuffer(labels, "<i8")[at]),
                        pa.array([matrix[i].tobytes() if layout.dims else b"" for i in at], pa.binary()),
                    ],
                    ["home", "place", "id", "label", "vector"],
                )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(single(batches), size):
            numbers = {c: rows[c].to_numpy().astype("<i8").tobytes() for c in ("home", "place", "id", "label")}
            yield _one_row({**numbers, "n": len(rows), "vector": b"".join(rows["vector"].to_pylist())})

    schema = "home binary, place binary, id binary, label binary, n long, vector binary"
    found = index.select("block", "ids", "labels", "anchors", "vectors").mapInArrow(packed, schema)
    return keep(found.withColumn("group", F.monotonically_increasing_id()), "anchors")


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Runs of ``size`` rows; the last one of a task may be shorter."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
        whole = len(table) - len(table) % size
        for begin in range(0, whole, size):
            yield table.slice(begin, size).combine_chunks()
        rest = table.slice(whole)
    if rest is not None and len(rest):
        yield rest.combine_chunks()


def _one_row(values: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([values])


# Search


def best(groups: DataFrame, index: DataFrame, zones: DataFrame, limits: DataFrame, layout: Layout, same: bool, k: int) -> DataFrame:
    """The best ``k`` rows of every window: ``(group, anchor, window, anchor_id, place, score, id)``.

    ``limits(group, anchor, window, least, most)`` holds the windows; ``anchor`` is a number in the
    group, ``place`` counts from 1. ``same`` asks for rows of the anchor's label other than itself,
    else for rows of other labels.
    """
    first = _top(_read(_choose(_limited(groups, limits), zones, layout, same, first=True), index, layout, same, k), k)
    found = first.where(F.col("place") == k).select("group", "anchor", "window", F.col("score").alias("found"))
    raised = limits.join(found, ["group", "anchor", "window"], "left").withColumn(
        "least", F.greatest("least", F.coalesce("found", "least"))
    )
    raised = keep(raised.drop("found"), "limits")
    chosen = _choose(_limited(groups, raised), zones, layout, same, first=False)
    return keep(_top(_read(chosen, index, layout, same, k), k), "best")


def _limited(groups: DataFrame, limits: DataFrame) -> DataFrame:
    """Groups with the windows of their anchors, at most a few per anchor, as arrays."""
    listed = F.sort_array(F.collect_list(F.struct("anchor", "window", "least", "most")))
    lists = limits.groupBy("group").agg(listed.alias("limits"))
    lists = lists.select("group", *[F.col(f"limits.{c}").alias(c) for c in ("anchor", "window", "least", "most")])
    return keep(groups.join(lists, "group"), "limited")


class Anchors:
    """The anchors of a group that have windows, and these windows."""

    def __init__(self, row: dict, layout: Layout):
        self.vectors = layout.read(row["vector"])
        self.home, self.place, self.id, self.label = (np.frombuffer(row[c], "<i8") for c in ("home", "place", "id", "label"))
        self.of = np.array(row["anchor"], np.int64)  # by window
        self.window, self.least, self.most = (np.array(row[c], np.int64) for c in ("window", "least", "most"))
        self.vectors = self.vectors if layout.dims else np.zeros((len(self.id), 0), layout.work)


def _choose(groups: DataFrame, zones: DataFrame, layout: Layout, same: bool, first: bool) -> DataFrame:
    """Groups with the blocks to read: a row for each, with the anchors (``wanted``) that need it."""
    spark = groups.sparkSession
    slots = max(1, min(zones.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    every = F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot")
    columns = ["group", "n", "home", "place", "id", "label", "vector", "anchor", "window", "least", "most"]
    dealt = zones.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int"))
    met = groups.select(*columns, every).repartition(slots, "slot").join(dealt.repartition(slots, "slot"), "slot")

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                yield from _bounds(row, Anchors(row, layout), layout, same, first)

    chosen = met.mapInArrow(bounds, "group long, block long, wanted array<int>, upper array<long>")
    if first:
        single = chosen.select("group", "block", F.explode(F.arrays_zip("wanted", "upper")).alias("one"))
        single = single.groupBy("group", F.col("one.wanted").alias("anchor_number")).agg(
            F.max_by("block", F.struct("one.upper", "block")).alias("block")
        )
        chosen = single.groupBy("group", "block").agg(F.sort_array(F.collect_list("anchor_number")).alias("wanted"))
    return groups.join(keep(chosen.select("group", "block", "wanted"), "chosen"), "group")


def _bounds(row: dict, anchors: Anchors, layout: Layout, same: bool, first: bool) -> Iterator[pa.RecordBatch]:
    block, label_lo, label_hi = (np.frombuffer(row[c], "<i8") for c in ("block", "label_lo", "label_hi"))
    shape = (len(block), layout.dims)
    lo, hi = (np.frombuffer(row[c], layout.type).reshape(shape).astype(layout.work) for c in ("lo", "hi"))
    plus, minus = np.maximum(anchors.vectors, 0), np.minimum(anchors.vectors, 0)
    upper = (plus @ hi.T + minus @ lo.T).astype(np.int64)
    lower = (plus @ lo.T + minus @ hi.T).astype(np.int64)
    label = anchors.label[:, None]
    if same:
        usable = (label_lo <= label) & (label <= label_hi)
    else:
        usable = (label_lo != label) | (label_hi != label)
    meets = (upper[anchors.of] >= anchors.least[:, None]) & (lower[anchors.of] <= anchors.most[:, None])
    needed = np.zeros(upper.shape, bool)
    starts = np.flatnonzero(np.append(True, anchors.of[1:] != anchors.of[:-1]))
    needed[anchors.of[starts]] = np.logical_or.reduceat(meets, starts, axis=0)
    needed &= usable
    if first:
        greatest = np.where(needed, upper, -ANY - 1)
        top = np.zeros(upper.shape, bool)
        top[np.arange(len(top)), greatest.argmax(axis=1)] = True
        needed &= top
    found = np.flatnonzero(needed.any(axis=0))
    wanted = [np.flatnonzero(needed[:, b]) for b in found]
    columns = {
        "group": pa.array([row["group"]] * len(found), pa.int64()),
        "block": pa.array(block[found]),
        "wanted": pa.array(wanted, pa.list_(pa.int32())),
        "upper": pa.array([upper[w, b] if first else [] for w, b in zip(wanted, found, strict=True)], pa.list_(pa.int64())),
    }
    yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _read(chosen: DataFrame, index: DataFrame, layout: Layout, same: bool, k: int) -> DataFrame:
    """The best ``k`` rows of every window and chosen block."""
    parts = int(chosen.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    data = index.select("block", "ids", "labels", "vectors")
    met = chosen.repartition(parts, "block").join(data.repartition(parts, "block"), "block")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                yield _compare(row, Anchors(row, layout), layout, same, k)

    return met.mapInArrow(
        compare, "group long, anchor int, window int, anchor_id long, score long, id long"
    )


def _compare(row: dict, anchors: Anchors, layout: Layout, same: bool, k: int) -> pa.RecordBatch:
    ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
    wanted = np.array(row["wanted"], np.int64)
    vectors = layout.read(row["vectors"]) if layout.dims else np.zeros((len(ids), 0), layout.work)
    scores = (anchors.vectors[wanted] @ vectors.T).astype(np.int64)
    usable = (labels == anchors.label[wanted, None]) == same
    home = np.flatnonzero(anchors.home[wanted] == row["block"])
    usable[home, anchors.place[wanted[home]]] = False
    line = np.full(len(anchors.id), -1)
    line[wanted] = np.arange(len(wanted))
    window = np.flatnonzero(line[anchors.of] >= 0)  # of the anchors wanted
    at = line[anchors.of[window]]
    inside = usable[at] & (scores[at] >= anchors.least[window, None]) & (scores[at] <= anchors.most[window, None])
    w, column = np.nonzero(inside)
    score, found = scores[at[w], column], ids[column]
    order = np.lexsort((found, -score, w))
    w, score, found = w[order], score[order], found[order]
    begin = np.flatnonzero(np.append(True, w[1:] != w[:-1])) if len(w) else np.zeros(0, np.int64)
    rank = np.arange(len(w)) - np.repeat(begin, np.diff(np.append(begin, len(w))))
    top = rank < k
    w, score, found = window[w[top]], score[top], found[top]
    columns = {
        "group": pa.array(np.full(len(w), row["group"], np.int64)),
        "anchor": pa.array(anchors.of[w].astype(np.int32)),
        "window": pa.array(anchors.window[w].astype(np.int32)),
        "anchor_id": pa.array(anchors.id[anchors.of[w]]),
        "score": pa.array(score),
        "id": pa.array(found),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _top(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("group", "anchor", "window").orderBy(F.desc("score"), "id")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


# Hard negatives


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    share: tuple[int, int] = (50, 95),
    block: int = BLOCK,
    group: int = GROUP,
    page: int = PAGE,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vectors(id, label, vector)`` holds whole numbers; ``anchor`` is a condition on them. Positives
    are an anchor's best rows of its label, by inner product; for each, the negatives are the best
    rows of other labels whose score is between the two percentages of the positive's.
    """
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    rows = vectors.where(usable).select(
        F.col("id").cast("long"),
        F.col("label").cast("long"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col("vector").cast("array<long>"),
    )
    rows = keep(rows, "vectors")
    per_dim = rows.select(F.posexplode("vector").alias("dim", "x")).groupBy("dim").agg(F.min("x"), F.max("x"))
    layout = Layout([(lo, hi) for _, lo, hi in sorted(map(tuple, per_dim.collect()))])
    index = blocks(rows, layout, block)
    groups, zones = anchor_groups(index, layout, group), pages(index, page)
    whole = groups.select(
        "group",
        F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("anchor"),
        F.lit(0).alias("window"),
        F.lit(-ANY).alias("least"),
        F.lit(ANY).alias("most"),
    )
    positive = best(groups, index, zones, whole, layout, same=True, k=positives)
    low, high = share
    windows = positive.select(
        "group",
        "anchor",
        F.col("place").alias("window"),
        _hundredths(F.col("score") * low, up=True).alias("least"),
        _hundredths(F.col("score") * high, up=False).alias("most"),
    ).where("least <= most")
    negative = best(groups, index, zones, windows, layout, same=False, k=negatives)
    pairs = positive.select("group", "anchor", F.col("place").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negative.join(pairs, ["group", "anchor", "window"]).select(
        "anchor_id",
        "positive_id",
        F.col("place").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _hundredths(score: Column, up: bool) -> Column:
    """A hundredth of a whole number, rounded up or down."""
    left = F.pmod(score, F.lit(100))
    down = F.call_function("div", score - left, F.lit(100))
    return down + F.when(left > 0, 1).otherwise(0) if up else down


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector among all embeddings, in steps of 1/256."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    number = F.col("embedding").cast("array<double>")
    finite = F.forall(number, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    vectors = table.where(finite).select(
        F.col("vec_id").alias("id"),
        F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform(number, lambda x: F.floor(x * 256)).alias("vector"),
    )
    return hard_negatives(vectors, F.col("id") % 50 == 0)


OP11_SQL = """
WITH v AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label::bigint + 1) % 10 ELSE label END AS label,
        [floor(256 * x::double) FOR x IN embedding] AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.id AS anchor_id, r.id, a.label = r.label AS same,
        list_dot_product(a.vector, r.vector)::bigint AS score
    FROM v AS a JOIN v AS r ON r.id <> a.id WHERE a.id % 50 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::int AS "rank",
    id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY "rank" <= 3
"""
