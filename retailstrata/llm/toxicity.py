"""Severity grades of toxic text by cumulative-link ordinal regression.

One weight vector over sparse text features is shared by all thresholds: the chance that a text's grade is at
least k is logistic(weights * features - threshold k). The score is the expected grade, the sum of these chances.

Features are lower-cased words without surrounding punctuation, and their first 4, 5 and 6 bytes, so that words
built on one stem support each other; the value is log(1 + occurrences). Features are known by 64-bit hash.

Labels only tell toxic from clean texts; no grades are given. The grade of a toxic training text is made from how many of
its words have features that hardly occur in clean ones: up to 2 words give grade 1, up to 5 grade 2, more grade 3. So
a severity says how many such words a text has, as far as the model has learnt that, and nothing about how grave they are.

The model is fitted on a bounded sample of labelled rows (``Training.rows_per_class``), those with the smallest
hash of their key; everything else covers all rows, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import remove, shared_folder
from .words import Words, slices, span_hashes, words_of

SCHEMA = "struct<severity:double,grade:int,toxic:boolean>"
PREFIXES = (4, 5, 6)
GRADES = 3
HITS = (2, 5)

_STRIP = np.zeros(256, bool)
_STRIP[list(b".,;:!?\"'()[]{}<>*-_/|#%&$")] = True


@dataclass(frozen=True)
class Training:
    """``features``: at most so many features enter the fit, those that tell most about toxicity."""

    rows_per_class: int = 2000
    features: int = 4000
    l1: float = 0.0005
    steps: int = 400


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes, their weights, and rising thresholds of grade 1, 2, ..."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def chances(self, scores: np.ndarray) -> np.ndarray:
        """Per text the chances of grade 1, 2, ... or higher."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -500, 500)))


NOTHING = Model(np.zeros(1, np.uint64), np.zeros(1), np.arange(1.0, GRADES + 1) * 10)


def _trimmed(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the words that are left without punctuation around them."""
    start, end = w.start.copy(), w.end.copy()
    for _ in range(3):
        last = w.data[np.maximum(end - 1, 0)] if len(end) else w.data[:0]
        end -= (end > start) & _STRIP[last]
        first = w.data[np.minimum(start, max(0, len(w.data) - 1))] if len(start) else w.data[:0]
        start += (end > start) & _STRIP[first]
    some = end > start
    return w.row[some], start[some], end[some]


def word_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Row, word number and hash of each feature occurrence, and the number of rows."""
    w = words_of(texts, lower=True)
    row, start, end = _trimmed(w)
    rows, words, hashes = [row], [np.arange(len(row))], [span_hashes(w.data, start, end)]
    for n in PREFIXES:
        long = np.flatnonzero(end - start > n)
        rows.append(row[long])
        words.append(long)
        # Another tag for each length keeps a short word apart from an equal beginning of a longer one.
        hashes.append(span_hashes(w.data, start[long], start[long] + n) ^ np.uint64(n))
    return np.concatenate(rows), np.concatenate(words), np.concatenate(hashes), w.rows


def _scores(texts: pa.Array, model: Model) -> np.ndarray:
    row, _, value, n = word_features(texts)
    at = np.minimum(np.searchsorted(model.features, value), len(model.features) - 1)
    known = model.features[at] == value
    pair, count = np.unique(row[known] * len(model.features) + at[known], return_counts=True)
    row, at = np.divmod(pair, len(model.features))
    return np.bincount(row, weights=model.weights[at] * np.log1p(count), minlength=n)


def severity(text: Column, model: Model, at_least: float = 0.6) -> Column:
    """Struct of the expected grade ``severity``, the likeliest ``grade`` (0 is clean), and ``toxic``.

    ``toxic`` is true when the chance of grade 1 or higher is ``at_least`` so much. Null and empty texts have no
    features; they get what the thresholds alone say, which is clean.
    """

    @F.arrow_udf(SCHEMA)
    def judge(texts: pa.Array) -> pa.Array:
        scores = [_scores(part, model) for part in slices(texts)]
        chances = model.chances(np.concatenate(scores) if scores else np.zeros(0))
        edges = np.concatenate([np.ones((len(chances), 1)), chances, np.zeros((len(chances), 1))], axis=1)
        return pa.StructArray.from_arrays(
            [
                pa.array(chances.sum(axis=1)),
                pa.array((edges[:, :-1] - edges[:, 1:]).argmax(axis=1).astype(np.int32)),
                pa.array(chances[:, 0] >= at_least),
            ],
            ["severity", "grade", "toxic"],
        )

    return judge(text)


# --- training -------------------------------------------------------------------------------------


def training_sample(documents: DataFrame, labels: DataFrame, training: Training, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Key, label and text of the sample: per class the rows with the smallest hash of their key.

    Labels that are null or whose key is null are not used; a key labelled twice is toxic if one label says so.
    """
    known = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{key}`").isNotNull())
    known = known.groupBy(F.col(f"`{key}`").alias("key")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("label"))

    def chosen(value: int) -> DataFrame:
        return known.where(F.col("label") == value).orderBy(F.xxhash64("key"), "key").limit(training.rows_per_class)

    # Twice rows_per_class rows at most, by the limits above.
    few = F.broadcast(chosen(0).unionAll(chosen(1)))
    texts = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return texts.join(few, "key")


_OCCURRENCES = "row bigint, label int, word int, feature bigint"


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every occurrence of a feature with its word; a row without any has one of nothing."""
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        labels, done = batch.column("label").to_numpy(), 0
        for part in slices(batch.column("text")):
            at, word, value, n = word_features(part)
            none = np.setdiff1d(np.arange(n), at)
            missing = np.concatenate([np.zeros(len(at), bool), np.ones(len(none), bool)])
            at = np.concatenate([at, none])
            columns = [pa.array(row + at), pa.array(labels[done + at].astype(np.int32))]
            for values, kind in ((word, np.int32), (value.view(np.int64), np.int64)):
                columns.append(pa.array(np.concatenate([values, np.zeros(len(none), values.dtype)]).astype(kind), mask=missing))
            yield pa.RecordBatch.from_arrays(columns, ["row", "label", "word", "feature"])
            row, done = row + n, done + n


def _told(occurrences: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """Each ``feature`` with how much it tells (``gap``) and whether it marks toxic words (``marks``)."""
    per_row = occurrences.where("feature is not null").select("row", "label", "feature").distinct()
    counts = per_row.groupBy("feature").agg(F.sum("label").alias("in_toxic"), F.sum(1 - F.col("label")).alias("in_clean"))
    shares = counts.select(
        "feature", "in_toxic", ((F.col("in_toxic") + 0.5) / (n_toxic + 1)).alias("toxic"), ((F.col("in_clean") + 0.5) / (n_clean + 1)).alias("clean")
    )
    # The gap of the shares in standard deviations.
    gap = F.abs(F.col("toxic") - F.col("clean")) / F.sqrt(F.col("toxic") / n_toxic + F.col("clean") / n_clean)
    return shares.select("feature", gap.alias("gap"), ((F.col("toxic") > 20 * F.col("clean")) & (F.col("in_toxic") >= 3)).alias("marks"))


def fit(documents: DataFrame, labels: DataFrame, training: Training = Training(), **columns: str) -> Model:
    """Fit on the sample. Without labels of both classes, a model that calls everything clean.

    Features are counted and chosen by Spark. To the driver come the chosen ones, ``Training.features`` at most, and
    for each row of the sample its counts of those and a number of words: what the bounds of ``Training`` allow,
    however long the texts are.
    """
    spark = documents.sparkSession
    path = f"{shared_folder(spark)}/toxicity-{uuid4().hex}"
    sample = training_sample(documents, labels, training, **columns)
    try:
        sample.select("label", "text").mapInArrow(_occurrences, _OCCURRENCES).write.parquet(path)
        occurrences = spark.read.parquet(path)
        sizes = dict(map(tuple, occurrences.select("row", "label").distinct().groupBy("label").count().collect()))
        if len(sizes) < 2:
            return NOTHING
        told = _told(occurrences, sizes[1], sizes[0])
        by_hash = F.col("feature").bitwiseXOR(F.lit(-(1 << 63)))  # in order as unsigned numbers
        best = told.orderBy(F.col("gap").desc(), by_hash).limit(training.features).select("feature").collect()
        chosen = np.sort(np.array([r["feature"] for r in best], np.int64).view(np.uint64))
        marked = occurrences.join(told.where("marks").select("feature"), "feature").groupBy("row").agg(F.count_distinct("word").alias("hits"))
        known = spark.createDataFrame(pa.table({"feature": chosen.view(np.int64), "place": np.arange(len(chosen))}))
        counts = occurrences.join(F.broadcast(known), "feature").groupBy("row", "place").agg(F.count(F.lit(1)).alias("n"))  # Training.features rows
        listed = counts.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "n"))).alias("counts"))
        rows = occurrences.select("row", "label").distinct().join(marked, "row", "left").join(listed, "row", "left")
        found = sorted(rows.select("label", F.coalesce("hits", F.lit(0)).alias("hits"), "counts").collect(), key=lambda r: (r["label"], r["hits"], r["counts"] or []))
    finally:
        remove(spark, path)
    pairs = [(i, place, n) for i, r in enumerate(found) for place, n in r["counts"] or []]
    doc, place, n = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 3
    grade = _grades(np.array([r["label"] for r in found]), np.array([r["hits"] for r in found]))
    weights, thresholds = _descend(doc, place, np.log1p(n), grade, len(chosen), training)
    kept = np.flatnonzero(weights)
    return Model(chosen[kept], weights[kept], thresholds) if len(kept) else NOTHING


def _grades(toxic: np.ndarray, hits: np.ndarray) -> np.ndarray:
    return np.where(toxic == 0, 0, 1 + np.searchsorted(HITS, hits, side="left"))


def loss(weights, first, gaps, doc, feature, value, grade, share) -> tuple[float, np.ndarray, np.ndarray]:
    """The weighted log loss, its gradient by the weights, and that by the first threshold and the logarithms of the gaps."""
    n = len(grade)
    score = np.bincount(doc, weights=weights[feature] * value, minlength=n)
    thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
    chance = 1 / (1 + np.exp(np.clip(thresholds[None, :] - score[:, None], -50, 50)))
    above = np.concatenate([np.ones((n, 1)), chance, np.zeros((n, 1))], axis=1)
    likely = np.maximum(above[np.arange(n), grade] - above[np.arange(n), grade + 1], 1e-12)
    slope = np.concatenate([np.zeros((n, 1)), chance * (1 - chance), np.zeros((n, 1))], axis=1)
    upper, lower = slope[np.arange(n), grade], slope[np.arange(n), grade + 1]
    by_score = -(upper - lower) / likely * share
    by_threshold = np.zeros(GRADES + 2)
    np.add.at(by_threshold, grade, upper / likely * share)
    np.add.at(by_threshold, grade + 1, -lower / likely * share)
    by_threshold = by_threshold[1:-1]
    pull = np.bincount(feature, weights=by_score[doc] * value, minlength=len(weights))
    bias = np.concatenate([[by_threshold.sum()], np.cumsum(by_threshold[::-1])[::-1][1:] * np.exp(gaps)])
    return float(-(np.log(likely) * share).sum()), pull, bias


def _descend(doc: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, size: int, training: Training) -> tuple[np.ndarray, np.ndarray]:
    """Proximal gradient steps with per-weight step sizes on the mean log loss of both classes plus an L1 penalty.

    Thresholds are a first one and positive gaps, so they stay in order.
    """
    # Toxic and clean rows count alike as classes, however many there are of each.
    toxic = grade > 0
    share = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, len(grade) - toxic.sum()))
    weights, first, gaps = np.zeros(size), 1.0, np.zeros(GRADES - 1)
    square, square_bias = np.full(size, 1e-8), np.full(GRADES, 1e-8)
    rate = 0.5
    for _ in range(training.steps):
        _, pull, bias = loss(weights, first, gaps, doc, feature, value, grade, share)
        square += pull * pull
        step = rate / np.sqrt(square)
        moved = weights - step * pull
        weights = np.sign(moved) * np.maximum(np.abs(moved) - step * training.l1, 0)
        square_bias += bias * bias
        first, gaps = first - rate * bias[0] / np.sqrt(square_bias[0]), gaps - rate * bias[1:] / np.sqrt(square_bias[1:])
    return weights, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
