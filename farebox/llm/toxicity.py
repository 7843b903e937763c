"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import column, mixed

# Lengths of the character n-grams, and the number of hashed features.
SIZES = (4, 5)
FEATURES = 1 << 20
# The model is fitted on at most so many labelled texts of class 0 and of class 1, those
# whose ids hash lowest. The table of labels may be of any size: all labels are counted, and
# the offset is moved by the shares of the classes that were left out.
SAMPLE = (3000, 1500)
# Characters of a text whose n-grams are held at a time.
PIECE = 1 << 18
# A feature counts if it occurs in so many texts of the sample, and is at least e**1.5
# times as frequent in one class as in the other: long texts have thousands of features
# that say little, and their small weights would add up.
MIN_TEXTS = 3
MIN_RATIO = 1.5
SMOOTHING = 1.0
# Steps of gradient descent with adaptive step sizes, and weight decay.
ROUNDS = 60
STEP = 0.03
DECAY = 1e-3


def _hashed(text: str | None) -> Iterator[np.ndarray]:
    """The hashed n-grams of a whole text, lower-cased, with repeats, from overlapping pieces."""
    low = f" {(text or '').lower()} "
    for start in range(0, len(low), PIECE):
        piece = low[start : start + PIECE + max(SIZES) - 1]
        units = np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32)
        for size in SIZES:
            count = len(units) - size + 1
            if count > 0:
                total = np.full(count, size, np.uint64)
                for place in range(size):
                    total = total * np.uint64(0x100000001B3) + units[place : place + count]
                yield (mixed(total) % np.uint64(FEATURES)).astype(np.int64)


def features(text: str | None) -> np.ndarray:
    """The different hashed n-grams of a whole text, ascending."""
    seen = np.zeros(FEATURES, bool)
    for found in _hashed(text):
        seen[found] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    """A weight for each feature, log-count ratio included, and an offset."""

    weights: np.ndarray
    offset: float

    def score(self, text: str | None) -> float:
        """The chance that a text is of class 1; of one without n-grams, that of the offset."""
        found = [np.unique(part[self.weights[part] != 0]) for part in _hashed(text)]
        used = np.unique(np.concatenate([np.zeros(0, np.int64), *found]))
        total = self.offset + float(self.weights[used].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def _chance(linear: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(linear, -30, 30)))


def fit(rows: list[np.ndarray], labels: list[int]) -> Model:
    """Logistic regression on the presence of features times their log-count ratios.

    ``rows`` has the distinct features of each text. With texts of one class, or
    none, the score is the smoothed share of class 1 whatever the text.
    """
    truth = np.array(labels, np.float64)
    ones, zeros = truth.sum(), (1 - truth).sum()
    offset = float(np.log((ones + 0.5) / (zeros + 0.5)))
    weights = np.zeros(FEATURES, np.float32)
    if not ones or not zeros:
        return Model(weights, offset)
    toxic, every = np.zeros(FEATURES), np.zeros(FEATURES)
    for row, label in zip(rows, labels, strict=True):
        every[row] += 1
        toxic[row] += label
    p, q = toxic + SMOOTHING, every - toxic + SMOOTHING
    ratio = np.log(p / (ones + 2 * SMOOTHING) / (q / (zeros + 2 * SMOOTHING)))
    kept = np.flatnonzero((every >= MIN_TEXTS) & (np.abs(ratio) >= MIN_RATIO))
    number = np.full(FEATURES, -1)
    number[kept] = np.arange(len(kept))
    short = [number[row][number[row] >= 0] for row in rows]
    places = np.repeat(np.arange(len(rows)), [len(row) for row in short])
    names = np.concatenate(short)
    values = ratio[kept][names]
    theta = np.zeros(len(kept))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        linear = np.bincount(places, values * theta[names], len(rows)) + offset
        error = (_chance(linear) - truth) / len(truth)
        slope = np.bincount(names, values * error[places], len(theta)) + DECAY * theta
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta -= STEP * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        offset -= error.sum()
    weights[kept] = theta * ratio[kept]
    return Model(weights, float(offset))


def known_labels(labels: DataFrame, id_column: str, label_column: str) -> DataFrame:
    """(id, label) of every id that has a label.

    An id labelled more than once counts as 1 if any of its labels is 1; rows without an
    id or label do not count.
    """
    known = labels.select(
        column(labels, id_column).alias("id"),
        column(labels, label_column).cast("int").alias("label"),
    ).filter("id IS NOT NULL AND label IN (0, 1)")
    return known.groupBy("id").agg(F.max("label").alias("label"))


def sample(known: DataFrame, rows=SAMPLE) -> DataFrame:
    """At most ``rows[c]`` of the labels of each class c, of the ids that hash lowest."""
    parts = [
        known.filter(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(rows[c])
        for c in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def prior_shift(counts: dict[int, int], rows=SAMPLE) -> float:
    """What the log odds of class 1 gain by taking the classes as often as they are labelled.

    A sample that takes one class at another rate than the other moves the offset of a
    logistic regression, and only that, by the log of the rates' quotient.
    """
    zero, one = (min(1.0, rows[c] / counts[c]) if counts.get(c) else 1.0 for c in (0, 1))
    return float(np.log(zero / one))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    rows=SAMPLE,
) -> Model:
    """Fit a model on the labelled texts, in one task that gets their features only.

    Returns with no more than FEATURES weights. Of different texts with one id, that
    with the largest hash is used. Without labels the offset is 0.
    """
    known = known_labels(labels, id_column, label_column)
    counts = dict(known.groupBy("label").count().collect())
    chosen = sample(known, rows)
    texts = docs.select(
        column(docs, id_column).alias("id"), column(docs, text_column).cast("string").alias("text")
    )
    # At most sum(rows) ids.
    marked = texts.join(F.broadcast(chosen), "id").select(
        F.col("id").cast("string").alias("id"),
        "label",
        F.xxhash64("text").alias("mark"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                row = batch.slice(place, 1)
                found = features(row.column("text")[0].as_py()).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*row.columns[:3], pa.array([found.tobytes()], pa.binary())],
                    ["id", "label", "mark", "found"],
                )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        for batch in batches:
            for place in range(batch.num_rows):
                found = np.frombuffer(batch.column("found")[place].as_py(), np.int32)
                seen.append((batch.column("id")[place].as_py(), found, batch.column("label")[place].as_py()))
        seen.sort(key=lambda row: row[0])
        model = fit([row[1] for row in seen], [row[2] for row in seen])
        used = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([-1, *used.tolist()], pa.int32()),
                pa.array([model.offset, *model.weights[used].tolist()], pa.float64()),
            ],
            ["feature", "weight"],
        )

    found = marked.mapInArrow(extract, "id string, label int, mark long, found binary")
    once = found.groupBy("id", "label").agg(F.max_by("found", "mark").alias("found"))
    pairs = once.repartition(1).mapInArrow(learn, "feature int, weight double").collect()
    weights = np.zeros(FEATURES, np.float32)
    offset = 0.0
    for feature, weight in pairs:
        if feature < 0:
            offset = weight
        else:
            weights[feature] = weight
    return Model(weights, offset + prior_shift(counts, rows))


def scored(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, score) of every document; null and empty texts get the score of the offset.

    Scores depend on the text alone. Repeated rows and rows without an id are scored
    like any other; an empty table gives no rows. Of a long text a task holds its
    characters, and the n-grams of PIECE of them.
    """
    rows = docs.select(
        column(docs, id_column).alias("id"), column(docs, text_column).cast("string").alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()
    used = np.flatnonzero(model.weights)
    values, offset = model.weights[used], model.offset

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(FEATURES, np.float32)
        weights[used] = values
        own = Model(weights, offset)
        for batch in batches:
            scores = [own.score(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(scores, pa.float64())], ["id", "score"]
            )

    return rows.mapInArrow(work, f"id {kind}, score double").withColumnRenamed("id", id_column)
