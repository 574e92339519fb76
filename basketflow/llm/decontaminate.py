"""Benchmark items in documents, verbatim or with a few edits, by the q-gram lemma.

An item of m characters that occurs in a text with at most e edits shares at least
``m - q + 1 - e q`` of its q-grams with the occurrence, and all of them lie on e + 1 neighbouring
diagonals (position in text minus position in item). Diagonals are cut into bands twice as wide
as that, each overlapping the next by half, so one band holds all of them. Bands with fewer
shared q-grams than the bound are dropped; what is left is verified by alignment in the band.

The alignment goes by edits, not by characters: for each diagonal of the band, how far into the item
one gets with 0, 1, 2, ... edits. A step takes time by the width of the band and by the characters that
match, and memory by the width alone, so a long item costs little unless it has many edits.

Letters are compared in lower case and any white space equals a blank; nothing is taken out, so
positions are those of the text.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from basketflow.llm.tables import documents

Q = 10  # characters of a gram
EDIT_SHARE = 0.08  # edits allowed per character of an item
BLOCK_CHARS = 2_000_000  # benchmark characters searched in one pass over the documents
SCAN_CHARS = 1 << 21  # document characters looked at in one step
FILTER_BITS = 22
NOTHING = 0xFFFFFFFF  # stands between texts and equals no character

COLUMNS = "doc_id long, item_id long, begin long, end long, edits int"
CELLS = 1 << 16  # diagonals looked at in one step, of as many candidates as have them
UNREACHED = -(1 << 40)


def edit_budget(length: int, share: float = EDIT_SHARE) -> int:
    """Edits allowed for an item: its share, or fewer where the lemma would give no bound."""
    return max(0, min(int(length * share), (length - Q) // Q))


def _plain_table() -> np.ndarray:
    table = np.arange(1 << 16, dtype=np.uint32)
    for code in range(1 << 16):
        if not 0xD800 <= code < 0xE000:
            lower = chr(code).lower()
            table[code] = ord(" ") if chr(code).isspace() else ord(lower) if len(lower) == 1 else code
    return table


def characters(text: str, table: np.ndarray) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if codes.size and codes.max() >= len(table):
        return np.where(codes < len(table), table[np.minimum(codes, len(table) - 1)], codes)
    return table[codes]


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of each q-gram, put together from those of 2, 4 and 8 characters."""
    one = codes.astype(np.uint64)
    factor = 0x9E3779B97F4A7C15
    parts, size = {1: one}, 1
    while size * 2 <= Q:
        shift = np.uint64(pow(factor, size, 1 << 64))
        parts[size * 2] = parts[size][: -size or None] * shift + parts[size][size:]
        size *= 2
    result, done = parts[size], size
    while done < Q:
        more = max(s for s in parts if s <= Q - done)
        n = len(codes) - done - more + 1
        result = result[:n] * np.uint64(pow(factor, more, 1 << 64)) + parts[more][done : done + n]
        done += more
    return result


def _slot(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


@dataclass
class Items:
    """The q-grams of one block of benchmark items, by hash, with where they are."""

    ids: np.ndarray
    codes: list[np.ndarray]
    budgets: np.ndarray
    bounds: np.ndarray
    table: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str]], share: float) -> "Items":
        table = _plain_table()
        codes = [characters(text, table) for _, text in rows]
        length = np.array([len(c) for c in codes])
        budgets = np.array([edit_budget(n, share) for n in length.tolist()])
        self = cls(np.array([i for i, _ in rows]), codes, budgets, length - Q + 1 - budgets * Q, table)
        self.length, self.joined = length, np.concatenate(codes)
        self.first_code = np.cumsum(length) - length
        grams = np.concatenate([gram_hashes(c) for c in codes])
        item = np.repeat(np.arange(len(codes)), length - Q + 1)
        place = np.concatenate([np.arange(n - Q + 1) for n in length.tolist()])
        order = np.argsort(grams, kind="stable")
        self.hashes, self.first, self.count = np.unique(grams[order], return_index=True, return_counts=True)
        self.item, self.place = item[order], place[order]
        self.seen = np.zeros(1 << FILTER_BITS, bool)
        self.seen[_slot(self.hashes)] = True
        return self

    def search_all(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        """``search`` over any number of texts, about ``SCAN_CHARS`` characters at a time."""
        numbers, some, waiting = [], [], 0
        for number, text in enumerate(texts):
            if text and len(text) >= Q:
                numbers.append(number)
                some.append(characters(text, self.table))
                waiting += len(text)
                if waiting >= SCAN_CHARS:
                    yield from ((numbers[hit[0]], *hit[1:]) for hit in self.search(some))
                    numbers, some, waiting = [], [], 0
        if some:
            yield from ((numbers[hit[0]], *hit[1:]) for hit in self.search(some))

    def search(self, texts: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
        """``(text number, item number, begin, end, edits)``, the best region of each pair."""
        gap = np.array([NOTHING], np.uint32)
        joined = np.concatenate([x for text in texts for x in (text, gap)])
        ends = np.cumsum([len(t) + 1 for t in texts])
        starts = ends - np.array([len(t) + 1 for t in texts])
        if len(joined) < Q:
            return []
        grams = gram_hashes(joined)
        at = np.flatnonzero(self.seen[_slot(grams)])
        number = np.minimum(np.searchsorted(self.hashes, grams[at]), len(self.hashes) - 1)
        same = self.hashes[number] == grams[at]
        at, number = at[same], number[same]
        # One row per shared gram: where in the text, in which item, where in it.
        n = self.count[number]
        entry = np.repeat(self.first[number] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at, item, place = np.repeat(at, n), self.item[entry], self.place[entry]
        text = np.searchsorted(ends, at, side="right")
        stride = self.budgets[item] + 1
        band = (at - place) // stride
        bands = len(joined) + int(self.place.max(initial=0)) + 4
        key = (text * len(self.ids) + item) * bands + (band + bands - len(joined))
        key, shared = np.unique(np.concatenate((key, key - 1)), return_counts=True)
        pair, band = key // bands, key % bands - (bands - len(joined))
        text, item = pair // len(self.ids), pair % len(self.ids)
        enough = shared >= self.bounds[item]
        text, item, band = text[enough], item[enough], band[enough]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        # Candidates of like width together, as many as fit; a wide one on its own.
        order = np.argsort(self.budgets[item], kind="stable")
        width = band_width(self.budgets[item[order]])
        begin = 0
        while begin < len(order):
            end = begin + max(1, int(np.searchsorted(width[begin:] * np.arange(1, len(order) - begin + 1), CELLS, side="right")))
            part = order[begin:end]
            begin = end
            found = self._align(joined, item[part], band[part], starts[text[part]], ends[text[part]] - 1)
            for c, edits, first, last in zip(*(x.tolist() for x in found), strict=True):
                t, k = int(text[part[c]]), int(item[part[c]])
                own = (edits, first, last)
                best[t, k] = min(own, best.get((t, k), own))
        return [(t, k, begin, end, edits) for (t, k), (edits, begin, end) in best.items()]

    def _align(self, joined, item, band, low, high) -> tuple[np.ndarray, ...]:
        """``(candidate, edits, begin, end)`` of the best alignments of items within their band of a text.

        Only of candidates within their item's budget. Best is the one with the fewest edits, then the
        leftmost begin, then the leftmost end: from all begins forward for the edits, from all ends
        backward for the begin, and from that begin forward for the end.
        """
        budget, length = self.budgets[item], self.length[item]
        left, width = band * (budget + 1) - budget, band_width(budget)
        d = np.arange(int(width.max()))
        in_band = d < width[:, None]
        candidates = Candidates(joined, self.joined, self.first_code[item], length, left, width, low, high)
        edits, _ = candidates.reach(in_band, budget, forward=True)
        some = np.flatnonzero(edits >= 0)
        if not len(some):
            return some, some, some, some
        candidates, edits, in_band = candidates.of(some), edits[some], in_band[some]
        left, length, low, high, width = left[some], length[some], low[some], high[some], width[some]
        _, reached = candidates.reach(in_band, edits, forward=False)
        # Diagonals are mirrored on the way back: the last one reached is the first one.
        lowest = width - 1 - (reached.shape[1] - 1 - np.argmax(reached[:, ::-1], axis=1))
        begin = np.clip(left + lowest, low, high)
        same_begin = in_band & (np.clip(left[:, None] + d, low[:, None], high[:, None]) == begin[:, None])
        _, reached = candidates.reach(same_begin, edits, forward=True)
        end = np.maximum(np.clip(left + length + np.argmax(reached, axis=1), low, high), begin)
        return some, edits, begin - low, end - low


def band_width(budget: np.ndarray) -> np.ndarray:
    """Diagonals of a band and of the edits on either side of it."""
    return 2 * (budget + 1) + 2 * budget + 1


@dataclass
class Candidates:
    """Items and the parts of texts that they may occur in, one of each per candidate.

    Diagonal d pairs character i of the item with character ``left + i + d`` of ``text``; what lies
    outside ``low`` to ``high`` equals nothing.
    """

    text: np.ndarray
    items: np.ndarray
    first: np.ndarray
    length: np.ndarray
    left: np.ndarray
    width: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def of(self, some: np.ndarray) -> "Candidates":
        own = (self.first, self.length, self.left, self.width, self.low, self.high)
        return Candidates(self.text, self.items, *(x[some] for x in own))

    def reach(self, begins: np.ndarray, limit: np.ndarray, forward: bool) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits to get through each item, -1 beyond ``limit``, and the diagonals where that ends.

        ``begins`` are the diagonals to begin at. Backward, items are read from their end and diagonals
        are mirrored, after which the same moves are allowed.
        """
        edits = np.full(len(self.length), -1)
        ends = np.zeros(begins.shape, bool)
        in_band = np.arange(begins.shape[1]) < self.width[:, None]
        at = np.where(begins, 0, UNREACHED)
        active, own = np.arange(len(self.length)), self
        for edit in range(int(limit.max(initial=-1)) + 1):
            if edit:
                # A character changed; one that the text lacks; one that the item lacks.
                further = at + 1
                further[:, :-1] = np.maximum(further[:, :-1], at[:, 1:] + 1)
                further[:, 1:] = np.maximum(further[:, 1:], at[:, :-1])
                at = np.where(in_band, further, UNREACHED)
            own._extend(at, forward)
            through = at >= own.length[:, None]
            done = through.any(axis=1)
            edits[active[done]], ends[active[done]] = edit, through[done]
            left = ~done & (limit[active] > edit)
            if not left.all():
                active, at, in_band, own = active[left], at[left], in_band[left], own.of(left)
            if not len(active):
                break
        return edits, ends

    def _extend(self, at: np.ndarray, forward: bool) -> None:
        """Moves on along each diagonal while characters match."""
        c, d = np.nonzero((at >= 0) & (at < self.length[:, None]))
        size = 4
        while len(c):
            more = at[c, d][:, None] + np.arange(size)
            if forward:
                place, code = (self.left[c] + d)[:, None] + more, self.first[c][:, None] + more
            else:
                last = self.left + self.length + self.width - 2
                place, code = (last[c] - d)[:, None] - more, (self.first + self.length - 1)[c][:, None] - more
            inside = (more < self.length[c][:, None]) & (place >= self.low[c][:, None]) & (place < self.high[c][:, None])
            same = self.text[np.where(inside, place, 0)] == self.items[np.where(inside, code, 0)]
            same &= inside
            all_same = same.all(axis=1)
            at[c, d] += np.where(all_same, size, np.argmin(same, axis=1))
            c, d = c[all_same], d[all_same]
            size = max(4, min(size * 2, CELLS // max(1, len(c))))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    share: float = EDIT_SHARE,
) -> DataFrame:
    """``(doc_id, item_id, begin, end, edits)``: the best occurrence of each item in each document.

    Best is the one with the fewest edits, then the leftmost. Every row of ``docs`` is searched
    for every item, whole; null texts hold nothing. Items are searched for in blocks of about
    ``BLOCK_CHARS`` characters, each sent to all tasks, with one pass over the documents per
    block, so the memory of a task depends on the benchmark only by its longest item. Items that are null or
    shorter than ``Q`` characters are not searched for; equal items are one under each id. Rows
    with equal keys are searched on their own and can repeat a result.
    """
    keyed = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = docs.sparkSession.createDataFrame([], COLUMNS)
    for rows in blocks_of(benchmark):
        found = found.unionByName(_scan(keyed, rows, share))
    return found


def blocks_of(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items to search for, in lists of about ``BLOCK_CHARS`` characters."""
    items = benchmark.where(F.length("text") >= Q)
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_CHARS)
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = sorted(((r.item_id, r.text) for r in own.collect()), key=lambda r: (r[0] is None, r))
        if rows:
            yield rows


def _scan(docs: DataFrame, rows: list[tuple[int, str]], share: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(rows)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items.of(sent.value, share)
        ids = [i for i, _ in sent.value]
        for batch in batches:
            keys = batch.column(0).to_pylist()
            hits = items.search_all(batch.column(1).to_pylist())
            found = [(keys[t], ids[k], begin, end, edits) for t, k, begin, end, edits in hits]
            if found:
                types = [*[pa.int64()] * 4, pa.int32()]
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "begin", "end", "edits"])

    return docs.mapInArrow(search, COLUMNS)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE) -> DataFrame:
    """The rows of ``docs`` in whose text no benchmark item occurs; one pass per block of items."""
    for rows in blocks_of(benchmark):
        docs = docs.where(~_holds_any(docs.sparkSession, rows, share)(F.col("text")))
    return docs


def _holds_any(spark: SparkSession, rows: list[tuple[int, str]], share: float):
    sent = spark.sparkContext.broadcast(rows)

    @pandas_udf("boolean")
    def holds(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = Items.of(sent.value, share)
        for batch in texts:
            flags = np.zeros(len(batch), bool)
            flags[[hit[0] for hit in items.search_all(batch.tolist())]] = True
            yield pd.Series(flags)

    return holds
