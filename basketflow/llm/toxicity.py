"""Severity of toxic language by cumulative-link ordinal regression.

For ordered grades 0..K-1 the model is P(grade > j) = logistic(w.x - t[j]) with one weight vector
for all thresholds t[0] < t[1] < ...; its expected severity is the sum of these probabilities.
Features are sparse: log(1 + count) for each character gram of a vocabulary. Grams of 4, 6 and 8
bytes within words, word borders included, also catch words never seen that share a stem with
seen ones. The vocabulary holds grams whose presence goes together with a toxic label, by a
likelihood-ratio test over the labelled sample, in whatever language.

Labels are binary, grades are not: a clean document has grade 0, a toxic one grade 1, 2 or 3 by
the number of its grams that lean to the toxic side, cut at the thirds of that number's
distribution over the toxic documents of the sample.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from basketflow.llm.tables import documents, keep, text_bytes
from basketflow.llm.words import plain_words

SAMPLE_ROWS = 20_000  # labelled documents the model is fitted on, at most
VOCABULARY = 4096  # grams with a weight, at most
SIZES = (4, 6, 8)  # bytes of a gram; 8 at most
MIN_DOCS = 3  # sample documents a gram must be in
MIN_EVIDENCE = 20.0  # likelihood ratio (G2) a gram must reach
GRADES = 4
RIDGE = 0.1
SEVERE = 0.4  # expected severity from which a document is rejected
SCAN_BYTES = 1 << 20
FILTER_BITS = 20


def grams(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and grams (as numbers) that have blanks at their ends only, for each size."""
    one = np.frombuffer(text, np.uint8).astype(np.uint64)
    blanks = np.concatenate(([0], np.cumsum(one == 32)))
    for size in SIZES:
        n = len(one) - size + 1
        if n > 0:
            whole, done = one, 1
            for step in (2, 4, 8):
                if step <= size:
                    whole = (whole[: -step // 2] << np.uint64(4 * step)) | whole[step // 2 :]
                    done = step
            whole = whole[: n + size - done] if done == size else whole
            for at in range(done, size):
                whole = (whole[:n] << np.uint64(8)) | one[at : at + n]
            inside = np.flatnonzero(blanks[size - 1 : size - 1 + n] == blanks[1 : n + 1])
            yield inside, whole[inside]


def padded(text: bytes) -> bytes:
    return b" " + b" ".join(plain_words(text)) + b" "


@dataclass(frozen=True)
class Severity:
    """``weights`` of the ascending ``vocabulary``, and thresholds; without them, no evidence."""

    vocabulary: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def expected(self, texts: Iterable[bytes]) -> np.ndarray:
        texts = list(texts)
        if not len(self.thresholds):
            return np.zeros(len(texts))
        return _logistic(self.scores(texts)[:, None] - self.thresholds).sum(axis=1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        text, number, count = counts(self.vocabulary, texts)
        return np.bincount(text, self.weights[number] * np.log1p(count), len(texts))


def counts(vocabulary: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text number, vocabulary number, count)`` of the known grams, ordered by the first two."""
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[_slot(vocabulary)] = True
    found, some, first, waiting = [np.zeros(0, np.int64)], [], 0, 0
    for number, text in enumerate(texts):
        some.append(padded(text))
        waiting += len(some[-1])
        if waiting >= SCAN_BYTES or number + 1 == len(texts):
            joined = b"\0".join(some)  # no gram holds a zero byte
            ends = np.cumsum([len(t) + 1 for t in some])
            for at, gram in grams(joined):
                likely = seen[_slot(gram)]
                at, gram = at[likely], gram[likely]
                place = np.minimum(np.searchsorted(vocabulary, gram), len(vocabulary) - 1)
                known = vocabulary[place] == gram
                text_number = first + np.searchsorted(ends, at[known], side="right")
                found.append(text_number * len(vocabulary) + place[known])
            some, first, waiting = [], number + 1, 0
    cell, count = np.unique(np.concatenate(found), return_counts=True)
    return cell // max(1, len(vocabulary)), cell % max(1, len(vocabulary)), count


def _slot(gram: np.ndarray) -> np.ndarray:
    return ((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


# Fitting


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, text, toxic)`` of at most ``rows`` labelled documents, drawn by a hash of the id.

    Labels without id or value are no labels; an id labelled twice counts as toxic if any says
    so. The ids are at most ``rows``, so they are sent to the documents.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(
        F.col("doc_id").alias("_id"), (F.col("toxic") > 0).alias("_toxic")
    )
    joined = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("_id"))
    return joined.select("doc_id", text_bytes().alias("text"), F.col("_toxic").alias("toxic"))


def fit(sample: DataFrame) -> Severity:
    """The model of a labelled sample; without both kinds of labels, one that says 0 for all.

    Equal texts count once, and as toxic if any copy is labelled so.
    """
    sample = keep(sample.groupBy("text").agg(F.max("toxic").alias("toxic")), "sample")
    n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    vocabulary, leaning = _vocabulary(sample, n[True], n[False]) if len(n) == 2 else (np.zeros(0, np.uint64), None)
    if not len(vocabulary):
        return Severity(vocabulary, np.zeros(0), np.zeros(0))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, number, count = counts(vocabulary, batch.column(0).to_pylist())
            starts = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            number, count = (
                pa.ListArray.from_arrays(pa.array(starts), pa.array(x.astype(np.int32))) for x in (number, count)
            )
            yield pa.RecordBatch.from_arrays([batch.column(1), number, count], ["toxic", "number", "times"])

    rows = sample.mapInArrow(features, "toxic boolean, number array<int>, times array<int>").collect()
    rows.sort(key=lambda r: (r.number, r.times, r.toxic))
    row = np.repeat(np.arange(len(rows)), [len(r.number) for r in rows])
    number = np.array([x for r in rows for x in r.number], np.int64)
    count = np.array([x for r in rows for x in r.times], np.int64)
    toxic = np.array([r.toxic for r in rows])
    leans = np.bincount(row, count * leaning[number], len(rows))
    grades = np.where(toxic, 1 + np.searchsorted(_thirds(leans[toxic]), leans, side="left"), 0)
    weights, thresholds = _ordinal(row, number, np.log1p(count), grades, len(vocabulary))
    return Severity(vocabulary, weights, thresholds)


def _thirds(values: np.ndarray) -> np.ndarray:
    ordered = np.sort(values)
    return ordered[[len(ordered) * i // (GRADES - 1) for i in range(1, GRADES - 1)]]


def _vocabulary(sample: DataFrame, n_toxic: int, n_clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams that tell toxic from clean documents, and whether they lean to the toxic side."""

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {True: [np.zeros(0, np.uint64)], False: [np.zeros(0, np.uint64)]}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own[toxic] += [np.unique(gram) for _, gram in grams(padded(text))]
            for toxic, found in own.items():
                gram, n = np.unique(np.concatenate(found), return_counts=True)
                none = np.zeros(len(gram), np.int64)
                columns = [gram.view(np.int64), *((n, none) if toxic else (none, n))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "t", "c"])

    seen = sample.mapInArrow(present, "gram long, t long, c long").groupBy("gram").agg(
        F.sum("t").alias("t"), F.sum("c").alias("c")
    )
    both = F.lit(float(n_toxic + n_clean))
    with_gram = F.col("t") + F.col("c")

    def part(observed, group, total):
        expected = F.lit(float(group)) * total / both
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    evidence = 2 * (
        part(F.col("t"), n_toxic, with_gram)
        + part(F.col("c"), n_clean, with_gram)
        + part(n_toxic - F.col("t"), n_toxic, both - with_gram)
        + part(n_clean - F.col("c"), n_clean, both - with_gram)
    )
    told = seen.where(with_gram >= MIN_DOCS).withColumn("evidence", evidence).where(F.col("evidence") >= MIN_EVIDENCE)
    told = told.withColumn("leans", F.col("t") * n_clean > F.col("c") * n_toxic)
    best = told.orderBy(F.desc("evidence"), "gram").limit(VOCABULARY).collect()
    gram = np.array([r.gram for r in best], np.int64).view(np.uint64)
    order = np.argsort(gram)
    return gram[order], np.array([r.leans for r in best], bool)[order]


def _ordinal(row, number, value, grades: np.ndarray, width: int, steps: int = 400):
    """Weights and thresholds of greatest likelihood under a ridge penalty.

    Cell i of the sparse table says that ``row[i]`` has ``value[i]`` of feature ``number[i]``.
    Gradient steps with momentum, scaled per parameter.
    """
    n, top = len(grades), int(grades.max())
    at = np.arange(n)
    shares = np.clip([(grades > j).mean() for j in range(top)], 1e-6, 1 - 1e-6)
    # The first threshold and the logarithms of the gaps, so that their order holds by itself.
    start = np.log1p(-shares) - np.log(shares)
    state = np.concatenate((np.zeros(width), start[:1], np.log(np.maximum(np.diff(start), 1e-3))))
    mean, square = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, steps + 1):
        weights, first, gaps = state[:width], state[width : width + 1], np.exp(state[width + 1 :])
        thresholds = np.concatenate((first, first + np.cumsum(gaps)))
        score = np.bincount(row, weights[number] * value, n)
        above = np.column_stack([np.ones(n), _logistic(score[:, None] - thresholds), np.zeros(n)])
        upper, lower = above[at, grades], above[at, grades + 1]
        chance = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / chance / n, lower * (1 - lower) / chance / n
        slope = low - up  # of the mean negative log likelihood, by score
        by_threshold = np.bincount(grades, up, top + 1)[1:] - np.bincount(grades, low, top + 1)[:-1]
        gradient = np.concatenate((
            np.bincount(number, slope[row] * value, width) + RIDGE * weights / n,
            [by_threshold.sum()],
            [by_threshold[j:].sum() * gaps[j - 1] for j in range(1, top)],
        ))
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        rate = 0.1 * min(1.0, 2 * (1 - step / (steps + 1)))
        state = state - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    first, gaps = state[width : width + 1], np.exp(state[width + 1 :])
    return state[:width], np.concatenate((first, first + np.cumsum(gaps)))


# Scoring


def severity(model: Severity, text: str = "text") -> Column:
    """The expected severity of a text, 0 to 3. Null and empty texts have no grams."""

    @pandas_udf("double")
    def expected(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(model.expected(batch))

    return F.round(expected(text_bytes(text)), 6)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(labelled_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    scored = docs.select("doc_id", severity(model).alias("severity"))
    return scored.withColumn("toxic", F.col("severity") >= SEVERE)


def keep_civil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose expected severity stays below ``SEVERE``."""
    return docs.where(severity(fit(labelled_sample(docs, labels))) < SEVERE)
