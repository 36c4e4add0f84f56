"""Quality classifier: naive Bayes support vectors (operator 6).

A text is the set of its n-grams (hashed characters).  Naive Bayes gives each
n-gram the log ratio of its smoothed shares in the two classes; the indicators
scaled by these ratios, at unit length, go to a linear model with hinge loss,
fitted by dual coordinate descent.  A sigmoid fitted to the margins turns them
into scores.

The class counts come from all training rows, aggregated in the tasks before
they are added up (``PLACES`` of them, whatever the input).  The linear model is
fitted on at most ``SAMPLE`` training rows: of each class the distinct texts with
the smallest hashes, as many as the class's share of all distinct (text, label)
rows; the bound holds on the driver, which fits it.

Texts move once, and only those that may have a label (a filter of the labels'
keys stands where texts are read).  What is to be in the sample follows from two
hashes of each text; the chosen texts are then fetched by their hashes.

Cases: a null text counts as empty; an empty text has no n-grams and gets the
score of the bias alone; texts of any length are taken whole; equal texts get
equal scores; a score of exactly 0.5 counts as high; several labels of one document count as the largest of them, null
labels as none; with no training rows, or one class only, scores follow the
share of the classes (0.5 for none); an empty table gives no rows; extra
columns do not clash, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.ngrams import codes, count_grams
from strata.operators.keyset import split
from strata.session import checkpoint_dir

SIZES = (1, 2, 3)
BITS = 16
SMOOTH = 1.0
SAMPLE = 4_000
COST = 1.0
PASSES = 30
TOLERANCE = 1e-3


# Indicators of the share of words whose 3-word window came before; they have
# places of their own after the hashed ones.
SHARES = (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
PLACES = (1 << BITS) + len(SHARES)


def repeated_share(text: str) -> float:
    """Share of the 3-word windows of a text that occurred before in it."""
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in text.split()), np.uint64)
    if len(ids) < 3:
        return 0.0
    windows = (ids[:-2] << np.uint64(42)) ^ (ids[1:-1] << np.uint64(21)) ^ ids[2:]
    return 1 - len(np.unique(windows)) / len(windows)


def places_of(text: str | None) -> np.ndarray:
    """Hashed places of the n-grams of a text, each once.

    One-step memory of an n-gram can't see that a text repeats itself, so the
    share of repeated word windows is added as indicators of its own.
    """
    found = np.flatnonzero(count_grams(codes(text or ""), SIZES, BITS))
    share = repeated_share(text or "")
    reached = [(1 << BITS) + i for i, s in enumerate(SHARES) if share >= s]
    return np.concatenate([found, reached]).astype(np.int32)


def class_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each class that hold a place; (rows, places) over all rows of
    ``labelled`` (label, text): shape (2, PLACES), and the rows per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = np.zeros((2, PLACES), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for label, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                held[label, places_of(body.as_py())] += 1
                rows[label] += 1
        places = np.flatnonzero(held.any(axis=0))
        out = [np.append(places, -1), *[np.append(held[c, places], rows[c]) for c in (0, 1)]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["place", "low", "high"])

    found = labelled.mapInArrow(run, "place long, low long, high long")
    found = found.groupBy("place").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).collect()
    counts, rows = np.zeros((2, PLACES)), np.zeros(2)
    for r in found:  # at most PLACES + 1 rows
        if r["place"] < 0:
            rows[:] = r["low"], r["high"]
        else:
            counts[:, r["place"]] = r["low"], r["high"]
    return counts, rows


def log_ratios(counts: np.ndarray) -> np.ndarray:
    shares = counts + SMOOTH
    shares /= shares.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def scaled(places: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Values of a text at its places: the log ratios, at unit length."""
    own = ratios[places]
    length = np.sqrt((own * own).sum())
    return own / length if length else own


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + sum of costs * hinge loss.

    One dual variable per row, between 0 and its cost, is set to its best value
    in turn; the bias is the weight of a feature that every row has.
    """
    w, bias = np.zeros(PLACES), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([float((v * v).sum()) + 1.0 for v in values])
    order, turn = np.arange(len(rows)), np.random.default_rng(0)
    for _ in range(PASSES):
        turn.shuffle(order)
        worst = 0.0
        for i in order:
            p, v = rows[i], values[i]
            slope = y[i] * (w[p] @ v + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), costs[i])
            step = (new - alpha[i]) * y[i]
            if step:
                worst = max(worst, abs(step))
                w[p] += step * v
                bias += step
                alpha[i] = new
        if worst < TOLERANCE:
            break
    return w, bias


def sigmoid_fit(margins: np.ndarray, high: np.ndarray) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a m + b))) by Newton steps on smoothed targets."""
    n1, n0 = high.sum(), (~high).sum()
    target = np.where(high, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        g = np.array([((p - target) * margins).sum(), (p - target).sum()])
        d = p * (1 - p) + 1e-9
        h = np.array([[(d * margins * margins).sum(), (d * margins).sum()], [(d * margins).sum(), d.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


@dataclass
class Model:
    """score = sigmoid(slope * (sum of w * scaled indicators + bias) + shift)."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, text: str | None) -> float:
        places = places_of(text)
        margin = float(self.weights[places] @ scaled(places, self.ratios)) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -35, 35))))


HASHES = ["hash_1", "hash_2"]


def hashed(texts: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and two hashes of the text."""
    return texts.select(*keep, F.xxhash64(F.lit("sample"), "text").alias("hash_1"), F.xxhash64("text").alias("hash_2"))


def sampled(keys: DataFrame, texts: DataFrame) -> DataFrame:
    """label, text of the sample: ``keys`` holds each (label, hash_1, hash_2) once,
    ``texts`` their texts, among others."""
    sizes = {r["label"]: r["count"] for r in keys.groupBy("label").count().collect()}  # two classes
    wanted = {label: max(1, int(SAMPLE * n / sum(sizes.values()))) for label, n in sizes.items()}
    chosen = None
    for label, n in sorted(wanted.items()):
        own = keys.filter(F.col("label") == label).orderBy(*HASHES).limit(n)
        chosen = own if chosen is None else chosen.unionByName(own)
    # At most SAMPLE keys; copies of a text become one row before they move.
    near = hashed(texts, "text").join(F.broadcast(chosen), HASHES)
    return near.groupBy("label", *HASHES).agg(F.min("text").alias("text")).select("label", "text")


def fit(labelled: DataFrame, keys: DataFrame | None = None, texts: DataFrame | None = None) -> Model:
    """Learn from rows (label 0 or 1, text).

    ``keys`` (label, hash_1, hash_2 of each row) and ``texts`` (where the sample's
    texts are fetched) may be given if they are cheaper to read than ``labelled``.
    """
    counts, rows = class_counts(labelled)
    none = np.zeros(PLACES)
    if not rows.all():
        share = (rows[1] + 1) / (rows.sum() + 2)
        return Model(none, none, 0.0, 0.0, float(np.log(share / (1 - share))))
    ratios = log_ratios(counts)
    checkpoint_dir(labelled.sparkSession)
    keys = (hashed(labelled, "label") if keys is None else keys).distinct().checkpoint()
    part = sampled(keys, labelled if texts is None else texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [places_of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(places, pa.list_(pa.int32()))], ["label", "places"])

    chosen = part.mapInArrow(run, "label int, places array<int>").toArrow()
    # An order of its own, so that the fit does not depend on that of the tasks.
    own = sorted(zip(chosen["label"].to_pylist(), (np.asarray(p.values) for p in chosen["places"])), key=lambda x: (x[0], x[1].tobytes()))
    labels = np.array([label for label, _ in own], bool)
    if labels.all() or not labels.any():
        return Model(ratios, ratios, 0.0, 1.0, float(np.log(rows[1] / rows[0])))
    places = [p for _, p in own]
    values = [scaled(p, ratios) for p in places]
    y = np.where(labels, 1.0, -1.0)
    # Both classes weigh the same.
    costs = COST * np.where(labels, len(labels) / (2 * labels.sum()), len(labels) / (2 * (~labels).sum()))
    weights, bias = dual_descent(places, values, y, costs)
    margins = np.array([weights[p] @ v + bias for p, v in zip(places, values)])
    slope, shift = sigmoid_fit(margins, labels)
    return Model(ratios, weights, bias, slope, shift)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality") -> Model:
    """Learn from all rows of ``docs`` that have a label (0 or 1)."""
    own = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(key).cast(docs.schema[key].dataType).alias("labelled")).agg(F.max(label).cast("int").alias("label"))
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Sort-merge at every size: labels grow with the documents.
    own = own.hint("merge")
    keys = hashed(rows, "id").join(own, F.col("id") == F.col("labelled")).select("label", *HASHES)
    near, _ = split(rows, own.select(F.col("labelled").alias("id")), ["id"])
    return fit(near.join(own, F.col("id") == F.col("labelled")).select("label", "text"), keys, rows.select("text"))


def score(docs: DataFrame, model: Model, name: str = "score", text: str = "text") -> DataFrame:
    """Replace ``text`` by its score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # PLACES numbers, twice
    at = docs.columns.index(text)
    others = [f for f in docs.schema if f.name != text]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in others], f"`{name}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            scores = pa.array([own.score(t.as_py()) for t in batch.column(at)], pa.float64())
            kept = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], scores], [*[batch.schema.names[i] for i in kept], name])

    return docs.mapInArrow(run, schema)
