"""SimHash near-duplicates through a Gray-order hierarchical index.

A document's fingerprint has 64 bits, each the majority of that bit over the hashes of its word
shingles. Fingerprints at most ``max_bits`` apart are linked, and linked documents form groups.

Search. Cut 64 bits into ``max_bits + 1`` blocks: two linked fingerprints agree in one block at
least. For each block, fingerprints are rotated so that the block leads, and those that share it
meet in one bucket, a contiguous run of the Gray order. In the bucket they are sorted by
Gray rank, so neighbours differ in few bits. Runs of neighbours get a parent that holds the bits
they all share; a node keeps only the bits its parent lacks. A search goes down the levels, adds
up differing bits, and drops a whole group once the sum exceeds ``max_bits``.

Nothing is cut off: a bucket with more than ``TILE`` fingerprints is cut by the same argument over
the bits left, and what is crowded even then is dealt to pairs of tiles, so that any two linked
members still meet in some task.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from basketflow.llm.components import components
from basketflow.llm.tables import documents, keep, text_bytes

BITS = 64
TILE = 4096  # fingerprints of a bucket in one tile
FAN = 8  # children of an index node
PAIRS = 1 << 20  # pairs of query and node looked at in one step


# Fingerprints


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """The fingerprint of a text given as UTF-8 bytes, as a signed 64-bit integer."""

    @pandas_udf("long")
    def of_batch(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(simhash(batch, shingle))

    return of_batch(text)


def simhash(texts: Iterable[bytes], shingle: int) -> np.ndarray:
    """Fingerprints of texts; ASCII letters in lower case, XXH64 with seed 42 per shingle.

    A text with fewer words than a shingle has one shingle, a text without words the
    fingerprint zero.
    """
    found, hashes, counts, waiting = [], [], [], 0
    for text in texts:
        hashed = shingle_hashes(text, shingle)
        hashes.append(hashed)
        counts.append(len(hashed))
        waiting += len(hashed)
        if waiting >= 1 << 17:
            found.append(_majority(np.concatenate(hashes), np.array(counts)))
            hashes, counts, waiting = [], [], 0
    if counts:
        found.append(_majority(np.concatenate(hashes), np.array(counts)))
    return np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    words = text.lower().split()  # of bytes: on blank, \t, \n, \v, \f, \r only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, n)


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bitwise majority over each run of ``counts`` hashes.

    Eight bits at a time are counted in the eight bytes of a word, over at most 255 hashes.
    """
    result = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return result
    n = counts[full]
    first = np.cumsum(n) - n
    blocks = -(-n // 255)
    block_first = np.cumsum(blocks) - blocks
    within = np.arange(blocks.sum()) - np.repeat(block_first, blocks)
    starts = np.repeat(first, blocks) + 255 * within
    ones = np.empty((len(starts), BITS), np.int64)
    for bit in range(8):
        lanes = (hashes >> np.uint64(bit)) & np.uint64(0x0101010101010101)
        ones[:, bit::8] = np.add.reduceat(lanes, starts).view(np.uint8).reshape(-1, 8)
    ones = np.add.reduceat(ones, block_first, axis=0)
    bits = (2 * ones > n[:, None]).astype(np.uint8)
    result[full] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return result


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# Groups


def groups(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """``(fingerprint, root)`` for the distinct values of ``fingerprints(fingerprint)``.

    Two fingerprints have the same root if links of at most ``max_bits`` bits connect them.
    """
    distinct = keep(fingerprints.select("fingerprint").distinct(), "fingerprints")
    roots = components(links(distinct, max_bits))
    joined = distinct.join(roots, distinct.fingerprint == roots.node, "left")
    return joined.select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Edges ``(a, b)`` that connect what links of at most ``max_bits`` bits connect.

    From each bucket comes one tree per connected set, not each linked pair, so the number of
    edges is bounded by the number of fingerprints.
    """
    tables = max_bits + 1
    cuts = [BITS * i // tables for i in range(tables + 1)]
    per_block = [
        F.struct(
            F.lit(i).alias("block"),
            F.shiftrightunsigned(_rotated(F.col("fingerprint"), cuts[i]), BITS - cuts[i + 1] + cuts[i]).alias("value"),
            _rotated(F.col("fingerprint"), cuts[i]).alias("code"),
        )
        for i in range(tables)
    ]
    coded = distinct.select(F.explode(F.array(*per_block)).alias("c")).select("c.*")
    met = buckets(keep(coded, "codes"), cuts, max_bits).withColumn("rank", gray_rank(F.col("code")))
    # Sign flipped, so that ranks sort as unsigned numbers.
    rank = F.col("rank").bitwiseXOR(F.lit(-(1 << 63)))
    dealt = met.repartition("bucket").sortWithinPartitions("bucket", "block", rank).drop("rank")

    def per_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, block in _runs(batches):
            member, root = forest(codes, max_bits)
            if len(member):
                a, b = (_rotate_right(codes[i], cuts[block]).view(np.int64) for i in (root, member))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt.mapInArrow(per_bucket, "a long, b long")


def buckets(coded: DataFrame, cuts: list[int], max_bits: int) -> DataFrame:
    """``(bucket, block, code)``: any two codes of a block and value with at most ``max_bits`` bits apart meet.

    A value with more than ``TILE`` codes is cut again by the same argument: the bits that its
    codes need not share make ``max_bits + 1`` parts, of which linked codes agree in one. So a
    code is sent a fixed number of times, however many there are. What is crowded even then, which
    takes codes that agree in two parts, is dealt to pairs of tiles.
    """
    sizes = keep(coded.groupBy("block", "value").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    sized = coded.join(sizes, ["block", "value"])
    small = sized.where(F.col("n") <= TILE).select(F.xxhash64("block", "value").alias("bucket"), "block", "code")

    tables = max_bits + 1
    widths = [b - a for a, b in zip(cuts, cuts[1:], strict=False)]

    def parts(width: int) -> Column:
        rest = BITS - width
        edges = [rest * i // tables for i in range(tables + 1)]
        return F.array(
            *[
                F.struct(
                    F.lit(i).alias("number"),
                    F.shiftrightunsigned("code", edges[i]).bitwiseAND(F.lit((1 << edges[i + 1] - edges[i]) - 1)).alias("bits"),
                )
                for i in range(tables)
            ]
        )

    cut = parts(widths[0])
    for block, width in enumerate(widths[1:], 1):
        cut = F.when(F.col("block") == block, parts(width)).otherwise(cut)
    crowded = sized.where(F.col("n") > TILE).select("block", "value", "code", F.explode(cut).alias("part"))
    key = ["block", "value", "number", "bits"]
    crowded = keep(crowded.select("block", "value", "code", "part.*"), "parts")
    tiles = crowded.groupBy(*key).agg(F.ceil(F.count("*") / TILE).alias("tiles"), F.count("*").alias("n")).where("n > 1")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    large = (
        crowded.join(tiles, key)
        .withColumn("tile", F.pmod(F.xxhash64("code"), "tiles"))
        .withColumn("other", other)
        .where("tiles = 1 or tile <> other")
        .select(F.xxhash64(*key, F.least("tile", "other"), F.greatest("tile", "other")).alias("bucket"), "block", "code")
    )
    return small.unionByName(large)


def _rotated(value: Column, by: int) -> Column:
    if by == 0:
        return value
    return F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, BITS - by))


def _rotate_right(codes: np.ndarray, by: int) -> np.ndarray:
    if by == 0:
        return codes
    return (codes >> np.uint64(by)) | (codes << np.uint64(BITS - by))


def gray_rank(code: Column) -> Column:
    """The place of a code in the Gray order: each bit is the parity of all bits above it."""
    for step in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, step))
    return code


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, int]]:
    """Codes of one bucket after the other, with the bucket's block; rows come sorted."""
    rest = None
    for batch in batches:
        keys, blocks, codes = (batch.column(i).to_numpy() for i in range(3))
        codes = codes.view(np.uint64)
        if rest is not None:
            keys, blocks, codes = (np.concatenate(x) for x in zip(rest, (keys, blocks, codes), strict=True))
        change = np.flatnonzero((keys[1:] != keys[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        starts = [0, *change.tolist()]
        for a, b in zip(starts, starts[1:], strict=False):
            if b - a > 1:
                yield codes[a:b], int(blocks[a])
        a = starts[-1]
        rest = keys[a:], blocks[a:], codes[a:]
    if rest is not None and len(rest[0]) > 1:
        yield rest[2], int(rest[1][0])


# The index of one bucket


def build_index(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the leaves up, each ``(pattern, own bits)``; codes come in Gray order.

    A node's mask holds the bits that all codes below it share; its own bits are those of its
    mask that its parent's mask lacks.
    """
    pattern, mask = codes, np.full(len(codes), np.uint64(0xFFFFFFFFFFFFFFFF))
    levels = []
    while True:
        starts = np.arange(0, len(pattern), FAN)
        if len(pattern) <= FAN:
            levels.append((pattern, mask))
            return levels
        first = np.repeat(pattern[starts], FAN)[: len(pattern)]
        shared = np.bitwise_and.reduceat(mask, starts) & ~np.bitwise_or.reduceat(pattern ^ first, starts)
        levels.append((pattern, mask & ~np.repeat(shared, FAN)[: len(pattern)]))
        pattern, mask = pattern[starts] & shared, shared


def search(levels: list, queries: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(query number, leaf number)`` at most ``max_bits`` apart."""
    pattern, own = levels[-1]
    query = np.repeat(np.arange(len(queries)), len(pattern))
    node = np.tile(np.arange(len(pattern)), len(queries))
    differ = np.zeros(len(query), np.uint8)
    for depth in range(len(levels) - 1, -1, -1):
        pattern, own = levels[depth]
        differ = differ + np.bitwise_count((queries[query] ^ pattern[node]) & own[node])
        near = np.flatnonzero(differ <= max_bits)
        query, node, differ = query[near], node[near], differ[near]
        if depth:
            width = len(levels[depth - 1][0])
            query, differ = np.repeat(query, FAN), np.repeat(differ, FAN)
            node = (node[:, None] * FAN + np.arange(FAN)).ravel()
            there = np.flatnonzero(node < width)
            query, node, differ = query[there], node[there], differ[there]
    return query, node


def forest(codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``(member, root)`` positions of codes that links connect to an earlier code."""
    levels = build_index(codes)
    label = np.arange(len(codes))
    step = max(1, PAIRS // (FAN * max(FAN, len(codes) // 16)))
    for at in range(0, len(codes), step):
        query, leaf = search(levels, codes[at : at + step], max_bits)
        query = query + at
        later = query < leaf
        label = _join(label, query[later], leaf[later])
    member = np.flatnonzero(label != np.arange(len(codes)))
    return member, label[member]


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the sets of each pair; a label is its set's first position."""
    while len(a):
        x, y = label[a], label[b]
        apart = np.flatnonzero(x != y)
        if not len(apart):
            break
        a, b = a[apart], b[apart]
        low, high = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
        parent = np.arange(len(label))
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
        label = parent[label]
    return label


# Documents


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, fingerprint (long) and component_id.

    ``component_id`` is the smallest key of the documents reachable over links. A null text
    counts as empty; texts without words share the fingerprint zero and are linked like any
    other. Equal texts share a fingerprint, so a group of copies is one point of the search. A
    null key is no candidate for component_id, which is null if no reachable key is known. An
    empty table gives an empty result.
    """
    prints = docs.select(F.col(key).alias("doc_id"), fingerprint(text_bytes(text), shingle).alias("fingerprint"))
    prints = keep(prints, "prints")
    roots = groups(prints, max_bits)
    smallest = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
    roots = keep(roots.join(smallest, "fingerprint"), "roots")
    first = keep(roots.groupBy("root").agg(F.min("doc_id").alias("component_id")), "firsts")
    ids = keep(roots.join(first, "root").select("fingerprint", "component_id"), "components")
    return prints.join(ids, "fingerprint").select("doc_id", "fingerprint", "component_id")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir), shingle=4, max_bits=4)
    return found.select("doc_id", as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs``, one per group of near-duplicates: the one with the smallest key.

    Rows that share that key and its fingerprint are told apart by a hash over all columns;
    of fully equal rows one stays. A group whose keys are all null keeps one row as well.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = F.xxhash64(*[c.cast("string") for c in columns]).alias("row")
    keyed = keep(docs.select("doc_id", fingerprint(text_bytes(), shingle).alias("fingerprint"), row), "keyed")
    roots = keep(groups(keyed, max_bits), "roots")
    least = keyed.groupBy("fingerprint").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("at"))
    best = roots.join(least, "fingerprint").groupBy("root").agg(F.min("at").alias("best"))
    best = keep(best.select(F.col("best.doc_id").alias("best_id"), F.col("best.row").alias("best_row")), "best")
    whole = docs.select(F.struct(*columns).alias("document"), F.col("doc_id").alias("id"), row)
    # By the hash alone, so that one shuffle serves the join and the removal of equal rows.
    same_id = F.coalesce(F.col("id") == F.col("best_id"), F.col("id").isNull() & F.col("best_id").isNull())
    chosen = whole.join(best, F.col("row") == F.col("best_row")).where(same_id)
    return chosen.dropDuplicates(["row"]).select("document.*")
