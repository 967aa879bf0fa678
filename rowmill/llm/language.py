"""Language identification with error-correcting output codes.

Every language has a codeword of +1 and -1; one binary classifier per position predicts its bit from
hashed byte n-grams of the text. A classifier's weights are the log-odds of an n-gram between the two
groups of languages that its bit divides, each language weighing the same. Decoding is loss-weighted: a
language costs the logistic loss of its bits under the predicted margins, each position weighing as much as
the log-odds of its accuracy on rows kept from the counts. The cheapest codeword wins; the lead over the
second says how sure the choice is, and a small lead flags the text as ambiguous.

Weights are learned from a sample of `per_language` labelled rows for each language (in expectation, by a
hash of the id), whose n-grams executors count. Prediction is a projection over whole texts.

Defined cases: NULL text, or one without a letter, is `und` with score 0 and not ambiguous; without labelled
rows every text is `und`; one language alone is always chosen; equal rows give equal rows; an empty table
gives an empty one. Input columns are carried; those named as a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
PER_LANGUAGE = 2000
BUCKETS = 1 << 16
BLOCK = 1 << 20  # bytes of text whose n-grams are in memory at once
SHARPNESS = 6.0  # margins are mean log-odds of one n-gram; the loss sees this many times as much
LEAD = 0.02  # a smaller lead of the winning codeword is ambiguous

LETTERS_ONLY = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
RESULTS = "lang_pred string, score double, ambiguous boolean"


def codewords(k: int) -> np.ndarray:
    """A row of +1 and -1 for each of k languages: all divisions of a few, Hadamard rows of many."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= 6:
        bits = [[1 if i == 0 or not d >> (i - 1) & 1 else -1 for i in range(k)] for d in range(1, 1 << (k - 1))]
        return np.array(bits, dtype=float).T
    h = np.ones((1, 1))
    while h.shape[0] < k:
        h = np.block([[h, h], [h, -h]])
    return h[:k, 1:]


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of all byte trigrams of the lower-cased text, in blocks; runs without letters are one blank."""
    for at in range(0, max(len(text), 1), BLOCK):
        # A block also sees the two characters before it, so no trigram is lost between blocks.
        part = text[max(at - 2, 0) : at + BLOCK].lower().encode(errors="replace").translate(LETTERS_ONLY)
        a = np.frombuffer(b" " + part + b" ", dtype=np.uint8)
        blank = a == 32
        a = a[~(blank & np.concatenate(([False], blank[:-1])))].astype(np.uint32)
        if len(a) >= 3:
            mixed = (a[:-2] << 16 | a[1:-1] << 8 | a[2:]) * np.uint32(2654435761)
            yield (mixed >> np.uint32(16)).astype(np.intp)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    bit_weights: np.ndarray

    def margins(self, text: str) -> np.ndarray:
        total, n = np.zeros(self.codes.shape[1]), 0
        for g in grams(text):
            seen, times = np.unique(g, return_counts=True)
            total += times @ self.weights[seen]
            n += len(g)
        return total / max(n, 1)

    def decide(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, False
        losses = self.losses(self.margins(text)[None, :])[0]
        order = np.argsort(losses, kind="stable")
        lead = losses[order[1]] - losses[order[0]] if len(order) > 1 else np.inf
        shares = np.exp(-4 * losses)
        return self.languages[order[0]], float(shares[order[0]] / shares.sum()), bool(lead < LEAD)

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Rows x languages: weighted mean loss of each codeword."""
        z = SHARPNESS * margins[:, None, :] * self.codes[None, :, :]
        return (np.logaddexp(0, -z) * self.bit_weights).sum(axis=2) / self.bit_weights.sum()


def held_out(doc_id: str) -> Column:
    """Whether a row is kept from learning; NULL ids are not held out, nor learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, doc_id: str, text: str, lang: str, per_language: int) -> DataFrame:
    """lang, text and use (0: counts, 1: accuracy of the bits) of the rows to learn from."""
    known = docs.where(
        F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id)
    )
    sizes = known.groupBy(lang).count().collect()
    if not sizes:
        return known.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.lit(0).alias("use")).limit(0)
    share = F.lit(0.0)
    for r in sizes:
        share = F.when(F.col(lang) == r[lang], min(1.0, per_language / r["count"])).otherwise(share)
    draw = F.pmod(F.xxhash64(doc_id), F.lit(1 << 30)) / float(1 << 30)
    rows = known.where(draw < share)
    return rows.select(
        F.col(lang).alias("lang"),
        F.col(text).alias("text"),
        (F.pmod(F.xxhash64(F.lit(7), doc_id), F.lit(4)) == 0).cast("int").alias("use"),
    )


def fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> Model:
    """Learn from the rows that are not held out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(*(batch.column(c).to_pylist() for c in ("lang", "text"))):
                own = totals.setdefault(name, np.zeros(BUCKETS))
                for g in grams(value):
                    own += np.bincount(g, minlength=BUCKETS)
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array(list(totals), pa.string()), "counts": pa.array([v.tobytes() for v in totals.values()], pa.binary())}
        )

    rows = sample(docs, doc_id, text, lang, per_language).repartition(8)
    counted = rows.where("use = 0").mapInArrow(count, "lang string, counts binary")
    totals: dict[str, np.ndarray] = {}
    for r in counted.toLocalIterator():
        totals[r["lang"]] = totals.get(r["lang"], 0) + np.frombuffer(r["counts"])
    languages = sorted(k for k, v in totals.items() if v.sum())
    codes = codewords(len(languages))
    if not languages:
        return Model([], codes, np.zeros((BUCKETS, 1)), np.ones(1))
    shares = np.array([totals[k] / totals[k].sum() for k in languages])
    smooth = 1e-6
    weights = np.zeros((BUCKETS, codes.shape[1]))
    for b in range(codes.shape[1]):
        plus, minus = codes[:, b] > 0, codes[:, b] < 0
        if plus.any() and minus.any():
            weights[:, b] = np.log(shares[plus].mean(0) + smooth) - np.log(shares[minus].mean(0) + smooth)
    model = Model(languages, codes, weights, np.ones(codes.shape[1]))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, n = np.zeros(codes.shape[1]), 0
        for batch in batches:
            for name, value in zip(*(batch.column(c).to_pylist() for c in ("lang", "text"))):
                if name in languages:
                    right += (model.margins(value) * codes[languages.index(name)]) > 0
                    n += 1
        yield pa.RecordBatch.from_pydict(
            {"right": pa.array([right.tolist()], pa.list_(pa.float64())), "n": pa.array([n], pa.int64())}
        )

    checked = rows.where("use = 1").mapInArrow(check, "right array<double>, n bigint").collect()
    right, n = sum((np.array(r["right"]) for r in checked), np.zeros(codes.shape[1])), sum(r["n"] for r in checked)
    accuracy = (right + 1) / (n + 2)
    return Model(languages, codes, weights, np.log(np.maximum(accuracy, 0.52) / (1 - np.minimum(accuracy, 0.999))))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred, score and ambiguous."""
    added = T._parse_datatype_string(RESULTS).fields
    names = {f.name for f in added}
    kept = [f for f in docs.schema.fields if f.name.lower() not in names]
    schema = T.StructType([*kept, *added])
    at = [f.name for f in kept].index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decide = shared.value.decide
        for batch in batches:
            found = [decide(v.as_py()) for v in batch.column(at)]
            lang, score, ambiguous = zip(*found) if found else ((), (), ())
            new = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(ambiguous, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(predict, schema)
