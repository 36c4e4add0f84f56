"""Language ID by nearest centroid (operator 7).

A text is the TF-IDF vector of its letter n-grams (hashed, log counts, unit
length).  Each language has several centroids, found by spherical k-means; a
text gets the language of the centroid with the largest cosine.  A text whose
distance from it is far beyond what the language's own texts show is rejected.

Document frequencies come from all training texts, and so do the distances
behind the rejection.  The clusters of a language are fitted on at most
``SAMPLE`` of its distinct training texts, those with the smallest hashes, so
that copies of one text count once there.

The model is a few numbers per hashed place, so its size does not follow the
documents: 2 ** BITS document frequencies, and CLUSTERS vectors per language.

Cases: a null text, an empty one and one without a letter are ``und`` with score
0 and rejected; texts of any length are taken whole; equal texts get equal
results; equal cosines go to the first language in order; with no training text
every text is ``und`` with score 0, rejected; an empty table gives no rows;
extra columns do not clash, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, distinct_texts, fresh, small_batches, smallest_hashes
from strata.llm.ngrams import count_grams, only_letters

SIZES = (1, 2, 3)
BITS = 15
CLUSTERS = 3
SAMPLE = 400
ROUNDS = 8

UNKNOWN = "und"

# Rejected: a text whose cosine is below this share of the median cosine of its
# language's training texts.  Below FULL letters the limit falls in proportion,
# since few n-grams can match by chance only.
REJECT_SHARE = 0.4
FULL = 100


def letters(text: str | None) -> np.ndarray:
    """The characters that count; empty when there is no letter."""
    chars = only_letters(text or "")
    return chars if len(chars) > 1 else chars[:0]


def vector(chars: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights (unit length) of a text's n-grams."""
    counts = count_grams(chars, SIZES, BITS)
    places = np.flatnonzero(counts)
    weights = (1 + np.log(counts[places])) * idf[places]
    length = np.sqrt((weights * weights).sum())
    return places, weights / length if length else weights


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """idf of each hashed place over all rows of ``texts`` (one text column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                chars = letters(t.as_py())
                if len(chars):
                    held += count_grams(chars, SIZES, BITS) > 0
                    n += 1
        places = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(places, -1)), pa.array(np.append(held[places], n))], ["place", "n"])

    found = small_batches(texts).mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    counts = {r["place"]: r["n"] for r in found.collect()}  # at most 2 ** BITS + 1 rows
    total = counts.pop(-1, 0) or 0
    idf = np.full(1 << BITS, np.log(1.0 + total) + 1)
    for place, n in counts.items():
        idf[place] = np.log((1 + total) / (1 + n)) + 1
    return idf


def k_means(rows: np.ndarray, k: int) -> np.ndarray:
    """Unit centroids of unit rows; starts are far from each other."""
    centres = [rows.mean(axis=0)]
    nearest = np.full(len(rows), -np.inf)
    starts = []
    for _ in range(min(k, len(rows))):
        seed = centres[0] if not starts else rows[starts[-1]]
        nearest = np.maximum(nearest, rows @ seed) if starts else rows @ seed
        starts.append(int(np.argmin(nearest)))
    own = rows[starts]
    for _ in range(ROUNDS):
        part = np.argmax(rows @ own.T, axis=1)
        new = [rows[part == c].sum(axis=0) if (part == c).any() else own[c] for c in range(len(own))]
        new = np.stack([v / (np.linalg.norm(v) or 1) for v in new])
        if np.allclose(new, own):
            break
        own = new
    return own


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]  # of each centroid, sorted
    centroids: np.ndarray  # one row per centroid

    def nearest(self, text: str | None) -> tuple[str, float, int]:
        """(language, cosine, letters) of a text."""
        chars = letters(text)
        if not len(chars) or not self.languages:
            return UNKNOWN, 0.0, 0
        places, weights = vector(chars, self.idf)
        cosines = self.centroids[:, places] @ weights
        best = int(np.argmax(cosines))
        return self.languages[best], float(min(1.0, max(0.0, cosines[best]))), len(chars)


def fit(training: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from the rows of ``training`` whose language is not null."""
    rows = training.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    idf = document_frequencies(rows.select("text"))
    # Texts without a letter have no vector and take no place in the sample.
    lettered = rows.filter(F.col("text").rlike(r"\p{L}"))
    sizes = distinct_texts(lettered, "lang")
    if not sizes:
        return Model(idf, [], np.zeros((0, 1 << BITS), np.float32))
    chosen = smallest_hashes(lettered, "lang", sizes, dict.fromkeys(sizes, SAMPLE)).withColumnRenamed("hash_1", "hash")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, lang, h in zip(*(c.to_pylist() for c in batch.columns)):
                chars = letters(body)
                if len(chars):
                    places, weights = vector(chars, idf)
                    out.append((lang, h, places.astype(np.int32), weights.astype(np.float32)))
            columns = list(zip(*out)) or [[]] * 4
            kinds = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.float32())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], ["lang", "hash", "places", "weights"])

    def clustered(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("hash", kind="stable")
        rows = np.zeros((len(df), 1 << BITS), np.float32)
        for i, (p, w) in enumerate(zip(df["places"], df["weights"])):
            rows[i, p] = w
        own = k_means(rows, CLUSTERS)
        return pd.DataFrame({"lang": df["lang"].iloc[0], "no": range(len(own)), "centroid": [c.astype("<f4").tobytes() for c in own]})

    vectors = chosen.select("text", "lang", "hash").mapInArrow(featured, "lang string, hash long, places array<int>, weights array<float>")
    found = vectors.groupBy("lang").applyInPandas(clustered, "lang string, no int, centroid binary").collect()
    found.sort(key=lambda r: (r["lang"], r["no"]))
    return Model(idf, [r["lang"] for r in found], np.stack([np.frombuffer(r["centroid"], "<f4") for r in found]) if found else np.zeros((0, 1 << BITS), np.float32))


FOUND = ("lang_pred", "score", "n_letters")


def predict(docs: DataFrame, model: Model, text: str, names: tuple[str, str, str] = FOUND, drop: bool = False) -> DataFrame:
    """Add language, cosine and letters of ``text``; ``drop`` takes the text away."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # size set by BITS, CLUSTERS and languages
    at = docs.columns.index(text)
    kept = [i for i in range(len(docs.columns)) if not (drop and i == at)]
    fields = [f"`{docs.columns[i]}` {docs.schema[i].dataType.simpleString()}" for i in kept]
    schema = ", ".join([*fields, f"`{names[0]}` string, `{names[1]}` double, `{names[2]}` long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.nearest(t.as_py()) for t in batch.column(at)]
            lang, cosine, n = zip(*found) if found else ((), (), ())
            new = [pa.array(lang, pa.string()), pa.array(cosine, pa.float64()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], *new], [*[batch.schema.names[i] for i in kept], *names])

    return small_batches(docs).mapInArrow(run, schema)


def usual_distances(scored: DataFrame, pred: str, score: str) -> dict[str, float]:
    """Median distance of each language's texts in ``scored``, over all of them."""
    known = scored.filter(F.col(pred) != UNKNOWN).groupBy(F.col(pred).alias("language"))
    found = known.agg(F.percentile_approx(1 - F.col(score), 0.5, 1000).alias("usual"))
    return {r["language"]: r["usual"] for r in found.collect()}  # one row per language


def rejection(usual: dict[str, float], pred: str, score: str, n: str) -> Column:
    """True where no language was found, or its distance 1 - score is too large."""
    limit = F.lit(1.0)
    for language, distance in usual.items():
        limit = F.when(F.col(pred) == language, F.lit(1 - REJECT_SHARE * (1 - distance))).otherwise(limit)
    # The limit grows to 1 for short texts.
    limit = 1 - (1 - limit) * F.least(F.lit(1.0), F.col(n) / FULL)
    return (F.col(pred) == UNKNOWN) | (1 - F.col(score) > limit)


def identify(docs: DataFrame, training: Column, text: str = "text", lang: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with lang_pred, score, rejected and n_letters of each row.

    ``training`` says which rows may be learned from.
    """
    keep = keep or []
    model = fit(docs.filter(training), text, lang)
    body, known, *found = fresh(docs.select(*keep), "body", "in_training", *FOUND)
    rows = docs.select(*keep, F.col(text).alias(body), (training & F.col(lang).isNotNull()).alias(known))
    scored = cut(predict(rows, model, body, tuple(found), drop=True), by=[*keep, found[1]])
    usual = usual_distances(scored.filter(known), found[0], found[1])
    return scored.select(
        *keep, *[F.col(f).alias(n) for f, n in zip(found, FOUND)], rejection(usual, *found).alias("rejected")
    )


def keep_known(docs: DataFrame, training: Column, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns.

    Texts are scored twice (distances of the training texts, then every row), so
    that no text has to be stored or shuffled.
    """
    own = docs.filter(training)
    model = fit(own, text, lang)
    told = predict(own.filter(F.col(lang).isNotNull()).select(F.col(text).alias("text")), model, "text", drop=True)
    usual = usual_distances(told, FOUND[0], FOUND[1])
    found = tuple(fresh(docs, *FOUND))
    return predict(docs, model, text, found).filter(~rejection(usual, *found)).select(*docs.columns)
