"""Quality by base rules and by the log-likelihood ratio of hashed n-grams.

Two multinomials over ``BUCKETS`` hash buckets of unigrams and bigrams: one of the trusted target
(documents labelled as good), one of the whole corpus. A document's score is the mean of
log(p_target / p_corpus) over its n-grams. Every document meets the same threshold; nothing is
drawn at random.

Tokens of the n-grams are runs of word characters and runs of punctuation, so ``same|`` and
``same`` share a token.
"""

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.tables import documents, keep, text_bytes
from basketflow.llm.words import WordHashes

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
TRUSTED_ROWS = 50_000  # labelled documents the target is counted on, at most
LEAST_SCORE = -0.3  # mean log-likelihood ratio, in nats, from which a document is kept
UNIT = 1_000_000  # ratios are whole millionths, so that sums do not depend on their order
MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of words in repeated windows

TOKENS = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^0-9A-Za-z_\x80-\xff\s]+")
_SPACE = b"\t\n\x0b\x0c\r "
_SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))


# Base rules


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated 3-word windows."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, _SPACE + _CONTINUATION)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words])
    base = len(number)
    pairs = codes[:-1] * base + codes[1:]
    if base > 2_000_000:  # windows as numbers would not fit 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * base + codes[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(len(windows) + 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = twice.copy()
    covered[1:] |= twice[:-1]
    covered[2:] |= twice[:-2]
    return int(covered.sum())


# n-grams


def grams(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Buckets of the unigrams and bigrams of a text."""
    own = hashes.of(TOKENS.findall(text))
    pairs = own[:-1] * np.uint64(0x9E3779B97F4A7C15) + (own[1:] ^ np.uint64(0xC2B2AE3D27D4EB4F))
    both = np.concatenate((own, pairs)) * np.uint64(0xD6E8FEB86659FD93)
    return (both >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def gathered(arrays: Iterable[np.ndarray], most: int = 1 << 20) -> Iterator[np.ndarray]:
    """Arrays put together to about ``most`` entries."""
    some, size = [], 0
    for array in arrays:
        some.append(array)
        size += len(array)
        if size >= most:
            yield np.concatenate(some)
            some, size = [], 0
    if some:
        yield np.concatenate(some)


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """At most ``rows`` ids labelled as good, drawn by a hash of the id; any bad label excludes."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    good = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality > 0")
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").alias("_id"))


def gram_counts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``(bucket, corpus, target)`` counted over all documents and over the trusted ones."""
    flagged = docs.select("doc_id", "text").join(F.broadcast(trusted.withColumn("_good", F.lit(True))), F.col("doc_id") == F.col("_id"), "left")
    flagged = flagged.select(text_bytes().alias("text"), F.coalesce("_good", F.lit(False)).alias("good"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        corpus, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for texts, total in (
                (batch.column(0), corpus),
                (batch.column(0).filter(batch.column(1)), target),
            ):
                for own in gathered(grams(text, hashes) for text in texts.to_pylist()):
                    total += np.bincount(own, minlength=BUCKETS)
        seen = np.flatnonzero(corpus)
        columns = [pa.array(x) for x in (seen, corpus[seen], target[seen])]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "corpus", "target"])

    counted = flagged.mapInArrow(count, "bucket long, corpus long, target long")
    return counted.groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("target").alias("target"))


def ratios(counts: DataFrame) -> np.ndarray | None:
    """log(p_target / p_corpus) by bucket in millionths, with one added to each count.

    None if no document is trusted. The table has at most ``BUCKETS`` rows.
    """
    corpus, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for row in counts.collect():
        corpus[row.bucket] += row.corpus
        target[row.bucket] += row.target
    if target.sum() == BUCKETS:
        return None
    ratio = np.log(target / target.sum()) - np.log(corpus / corpus.sum())
    return np.round(ratio * UNIT).astype(np.int64)


def judge(docs: DataFrame, ratio: np.ndarray | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, score and verdict for every row of ``docs``.

    A null or empty text has no words, score 0 and fails the base rules. Without a trusted target
    (``ratio`` is None) every score is 0 and the base rules alone decide.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ratio)
    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ratio = WordHashes(), sent.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = np.array([base_counts(t) for t in texts], np.int64).reshape(-1, 5)
            scores = np.zeros(len(texts))
            if ratio is not None:
                for i, t in enumerate(texts):
                    own = grams(t, hashes)
                    scores[i] = int(ratio[own].sum()) / len(own) / UNIT if len(own) else 0.0
            columns = [batch.column(0), *[pa.array(counts[:, i]) for i in range(5)], pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    judged = rows.mapInArrow(measure, schema).withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= LEAST_SCORE))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``judge`` with the multinomials of all ``docs`` and of the trusted ones among them."""
    counts = keep(gram_counts(docs, trusted_ids(labels)), "gram-counts")
    return judge(docs, ratios(counts))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
