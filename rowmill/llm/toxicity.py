"""Toxicity by a chain of linear classifiers.

Categories are predicted in order. The model of a category sees the text's hashed words and the
probabilities of all earlier categories; words count by themselves and by their beginnings, if they are more
frequent in the category than chance explains. While learning, those probabilities are out-of-fold: they come from
models that did not see the row, so a later model meets earlier predictions as good or bad as they will be
on new texts. Models are logistic regressions with a quadratic penalty; rows of the rarer class of a category
weigh more.

The labelled rows to learn from are a sample of `MAX_ROWS` (in expectation, by a hash of the id), whose word
buckets the executors extract; features of that many rows are what the driver holds. Prediction is a
projection over whole texts.

Defined cases: NULL or wordless texts have no word feature and get the models' base rates; a category with
one class only, or no labelled row, has that class's share (0 without rows) as every probability; NULL labels
are not learned from; several labels of one id each count, unless they contradict (then the larger holds);
equal rows give equal rows; an empty table gives an empty result. Input columns are carried; those named as
a result are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ROWS = 6000
BUCKETS = 1 << 18
FOLDS = 4
PENALTY = 1e-4
STEPS = 150
ROWS_OF_BUCKET = 3  # rows that a bucket needs to be used
SURPRISE = 4.0  # standard errors by which it must be more frequent in the category than by chance
BEGINNINGS = (4, 5)  # characters, for words built on one stem
KNOWN_WORDS = 1 << 20

WORD = re.compile(r"[^\W_]+")


class WordBuckets(dict):
    """The buckets of a word and of its beginnings, remembered for up to KNOWN_WORDS words."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        names = [word, *[f"{word[:k]}*" for k in BEGINNINGS if len(word) >= k]]
        self[word] = value = tuple(zlib.crc32(n.encode(errors="replace")) % BUCKETS for n in names)
        return value


def buckets(text: str | None, known: WordBuckets) -> np.ndarray:
    """The distinct buckets of a text's words."""
    found = chain.from_iterable(map(known.__getitem__, set(WORD.findall((text or "").lower()))))
    return np.array(sorted(set(found)), dtype=np.int32)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


@dataclass
class Linear:
    """Weights of word buckets, of earlier probabilities, and a constant."""

    words: np.ndarray
    earlier: np.ndarray
    constant: float

    def margin(self, rows: np.ndarray, columns: np.ndarray, n: int, earlier: np.ndarray) -> np.ndarray:
        sums = np.bincount(rows, weights=self.words[columns], minlength=n)
        return sums + earlier @ self.earlier + self.constant


def fit_linear(rows: np.ndarray, columns: np.ndarray, earlier: np.ndarray, y: np.ndarray) -> Linear:
    """Penalised logistic regression by gradient steps, over the buckets that tell the category."""
    n = len(y)
    share = y.mean() if n else 0.0
    model = Linear(np.zeros(BUCKETS, dtype=np.float64), np.zeros(earlier.shape[1]), 0.0)
    if share in (0.0, 1.0):
        model.constant = 30.0 if share else -30.0
        return model
    seen = np.bincount(columns, minlength=BUCKETS)
    hits = np.bincount(columns, weights=y[rows], minlength=BUCKETS)
    surprise = (hits - seen * share - 0.5) / np.sqrt(seen * share * (1 - share) + 1e-9)
    used = ((seen >= ROWS_OF_BUCKET) & (surprise >= SURPRISE))[columns]
    rows, columns = rows[used], columns[used]
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) ** 0.5
    weight /= weight.sum()
    model.constant = float(np.log(share / (1 - share)))
    speed = [np.zeros(BUCKETS), np.zeros(earlier.shape[1]), 0.0]
    for _ in range(STEPS):
        wrong = weight * (sigmoid(model.margin(rows, columns, n, earlier)) - y)
        speed[0] = 0.9 * speed[0] + np.bincount(columns, weights=wrong[rows], minlength=BUCKETS) + PENALTY * model.words
        speed[1] = 0.9 * speed[1] + earlier.T @ wrong + PENALTY * model.earlier
        speed[2] = 0.9 * speed[2] + 0.5 * wrong.sum()
        model.words -= speed[0]
        model.earlier -= speed[1]
        model.constant -= speed[2]
    return model


@dataclass
class Chain:
    categories: list[str]
    models: list[Linear] = field(default_factory=list)

    def probabilities(self, features: list[np.ndarray]) -> np.ndarray:
        n = len(features)
        rows = np.repeat(np.arange(n), [len(f) for f in features])
        columns = np.concatenate(features) if n else np.empty(0, dtype=np.int32)
        out = np.zeros((n, len(self.models)))
        for k, m in enumerate(self.models):
            out[:, k] = sigmoid(m.margin(rows, columns, n, out[:, :k]))
        return out


def learned(features: list[np.ndarray], folds: np.ndarray, labels: dict[str, np.ndarray]) -> Chain:
    """Fit the chain; labels hold 0, 1 or NaN per row and category, in order."""
    n = len(features)
    rows = np.repeat(np.arange(n), [len(f) for f in features])
    columns = np.concatenate(features) if n else np.empty(0, dtype=np.int32)
    models, earlier = Chain(list(labels)), np.zeros((n, 0))

    def fitted(use: np.ndarray, y: np.ndarray) -> Linear:
        place = np.cumsum(use) - 1
        inside = use[rows]
        return fit_linear(place[rows[inside]], columns[inside], earlier[use], y[use])

    for y in labels.values():
        known = ~np.isnan(y)
        models.models.append(fitted(known, y))
        out = np.zeros(n)
        for fold in range(FOLDS):
            away = folds == fold
            if away.any():
                model = fitted(known & ~away, y)
                out[away] = sigmoid(model.margin(rows, columns, n, earlier))[away]
        earlier = np.column_stack([earlier, out])
    return models


def fit(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str], doc_id: str = "doc_id",
    text: str = "text", max_rows: int = MAX_ROWS,
) -> Chain:
    """Learn categories (name: SQL condition over labels) from labelled documents."""
    marked = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg(
        *[F.max(F.expr(c).cast("double")).alias(f"y{k}") for k, c in enumerate(categories.values())]
    )
    n = marked.count()
    share = min(1.0, max_rows / max(n, 1))
    drawn = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(drawn, "doc_id")
    names = [f"y{k}" for k in range(len(categories))]
    rows = rows.select("text", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold"), *names)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordBuckets()
        for batch in batches:
            own = [buckets(v.as_py(), known) for v in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.list_(pa.int32())), *batch.columns[1:]], names=["words", "fold", *names]
            )

    kinds = ", ".join(f"{c} double" for c in names)
    held = rows.mapInArrow(extract, f"words array<int>, fold int, {kinds}").toArrow()
    # The order of rows is that of their content, so the same rows always give the same model.
    listed = sorted(zip(*[held.column(c).to_pylist() for c in ("words", "fold", *names)]), key=repr)
    features = [np.array(r[0], dtype=np.int32) for r in listed]
    values = {
        name: np.array([np.nan if r[2 + k] is None else r[2 + k] for r in listed], dtype=float)
        for k, name in enumerate(categories)
    }
    return learned(features, np.array([r[1] for r in listed], dtype=int), values)


def predict(docs: DataFrame, models: Chain, text: str = "text") -> DataFrame:
    """docs with p_<category> for each category."""
    added = [f"p_{c}" for c in models.categories]
    kept = [f for f in docs.schema.fields if f.name.lower() not in {a.lower() for a in added}]
    schema = T.StructType([*kept, *[T.StructField(a, T.DoubleType()) for a in added]])
    at = [f.name for f in kept].index(text)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordBuckets()
        for batch in batches:
            for first in range(0, len(batch), 512):
                part = batch.slice(first, 512)
                p = shared.value.probabilities([buckets(v.as_py(), known) for v in part.column(at)])
                new = [pa.array(p[:, k]) for k in range(len(added))]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.names)

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(score, schema)
