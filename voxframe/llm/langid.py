"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are character 1- to 3-grams of the lower-cased text, hashed to 2**16; a feature's value is its share of the text's
n-grams times its inverse document frequency over all texts that may be learned from. Tasks add up the document
frequencies of their own rows, 2**16 numbers each, and these sums are merged as a tree. Weights are trained by follow the
regularised leader with L1 and L2 penalties, which leaves most of them at zero, on a sample of at most about
`per_label` texts of each language (whole texts); a fifth of the sample is held back to set the temperature
that makes the probabilities match. As a value is linear in the n-grams' counts, a text is scored by adding one row of
weights for each of its n-grams: texts of any length take bounded memory.

Only text and lang of rows with an id that isn't held out are learned from. Null texts and texts without a
letter are `und` with score 0; so are all texts if there is nothing to learn from. Repeated rows get equal
results; an empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import crc_of_id, draw, mapped

BITS = 16
ORDERS = (1, 2, 3)
CHUNK = 1 << 18
LETTER = regex.compile("\\p{L}")
# Odd multipliers of the hash, one for each place in an n-gram and order.
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


@dataclass
class LanguageModel:
    labels: list[str]
    weights: np.ndarray  # features x labels, with the inverse document frequency in it
    bias: np.ndarray
    temperature: float

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.labels)), 0
        for hashed in grams(text):
            if len(hashed) > 1 << 13:
                total += np.bincount(hashed, minlength=1 << BITS).astype(np.float32) @ self.weights
            else:
                total += np.ones(len(hashed), np.float32) @ self.weights.take(hashed, axis=0)
            n += len(hashed)
        return total / max(n, 1) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.labels or not LETTER.search(text):
            return "und", 0.0
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(np.argmax(p))
        return self.labels[k], float(p[k])


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashed n-grams of a text with a space at each end, a chunk at a time; each n-gram comes once."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32)
    longest = ORDERS[-1]
    for at in range(0, len(points), CHUNK):
        part = points[at : at + CHUNK + longest - 1]
        for order in ORDERS:
            n = min(len(part) - order + 1, CHUNK)
            if n <= 0:
                continue
            h = part[:n] * _FACTORS[0]
            h += np.uint32(order * 0x27D4EB2F & 0xFFFFFFFF)
            for k in range(1, order):
                h += part[k : k + n] * _FACTORS[k]
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            yield h >> np.uint32(32 - BITS)


def _sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    all_grams = np.concatenate(list(grams(text)))
    counts = np.bincount(all_grams, minlength=1 << BITS)
    at = np.flatnonzero(counts)
    return at, counts[at] / len(all_grams)


#: Sums of document frequencies that one task merges.
FAN = 16


def document_frequencies(docs: DataFrame, column: str) -> tuple[np.ndarray, int]:
    """How many texts with a letter have each hashed n-gram, and how many there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, here = np.zeros(1 << BITS, np.int64), 0, np.zeros(1 << BITS, bool)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text and LETTER.search(text):
                    here[:] = False
                    for hashed in grams(text):
                        here[hashed] = True
                    df += here
                    n += 1
        yield _frequency_row(df, n)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            n += sum(batch.column(0).to_pylist())
            df += batch.column(1).flatten().to_numpy().reshape(-1, 1 << BITS).sum(axis=0)
        yield _frequency_row(df, n)

    form = "n long, df array<long>"
    each, parts = mapped(docs.select(column), count, form), docs.rdd.getNumPartitions()
    while parts > 1:
        parts = -(-parts // FAN)
        each = mapped(each.repartition(parts), merge, form)
    row = each.first()
    return (np.array(row.df, float), row.n) if row else (np.zeros(1 << BITS), 0)


def _frequency_row(df: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(df)], pa.int32()), pa.array(df))], ["n", "df"])


def train(rows: list[tuple[str, str]], frequencies: tuple[np.ndarray, int] | None = None, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 2e-4, l2: float = 1e-3) -> LanguageModel:
    """Fit on (text, label) pairs; frequencies: of n-grams in all texts and their number, else in the texts to fit on."""
    rows = sorted((t, y) for t, y in rows if t and LETTER.search(t))
    labels = sorted({y for _, y in rows})
    if not labels:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0), 1.0)
    rng = np.random.default_rng(3)
    order = rng.permutation(len(rows))
    held = set(order[: len(rows) // 5].tolist())
    data = [(*_sparse(t), labels.index(y)) for t, y in rows]
    fit = [k for k in range(len(rows)) if k not in held]
    if frequencies is None:
        frequencies = np.zeros(1 << BITS), len(fit)
        for k in fit:
            frequencies[0][data[k][0]] += 1
    idf = np.log((1 + frequencies[1]) / (1 + frequencies[0])) + 1
    n_labels = len(labels)
    z, s = np.zeros((1 << BITS, n_labels)), np.zeros((1 << BITS, n_labels))
    z0, s0 = np.zeros(n_labels), np.zeros(n_labels)

    def solved(z: np.ndarray, s: np.ndarray, l1: float = l1) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(s)) / alpha + l2))

    scale = 30.0  # shares of n-grams are small; this brings typical values near one
    for _ in range(epochs):
        for k in rng.permutation(fit):
            at, share, y = data[k]
            x = share * idf[at] * scale
            w, b = solved(z[at], s[at]), solved(z0, s0, 0.0)
            logit = x @ w + b
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[y] -= 1
            for zz, ss, own, g in ((z, s, w, np.outer(x, p)), (z0, s0, b, p)):
                i = at if zz is z else slice(None)
                sigma = (np.sqrt(ss[i] + g * g) - np.sqrt(ss[i])) / alpha
                zz[i] += g - sigma * own
                ss[i] += g * g
    model = LanguageModel(labels, (solved(z, s) * idf[:, None] * scale).astype(np.float32), solved(z0, s0, 0.0), 1.0)
    pairs = [(model.logits(rows[k][0]), data[k][2]) for k in sorted(held)]
    if pairs:

        def loss(t: float) -> float:
            return sum(np.log(np.exp((q - q.max()) / t).sum()) - (q[y] - q.max()) / t for q, y in pairs)

        model.temperature = float(min(np.geomspace(0.1, 10, 61), key=loss))
    return model


def fit(docs: DataFrame, per_label: int = 500, key: str = "doc_id", column: str = "text", label: str = "lang") -> LanguageModel:
    known = docs.where(F.col(label).isNotNull() & F.col(column).isNotNull() & (crc_of_id(F.col(key), 4) != 2)).select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(column).alias("text"))
    sample = [(r.text, r.label) for r in draw(known, "label", "id", per_label, "langid").select("text", "label").collect()]
    return train(sample, document_frequencies(known, "text") if sample else None)


def identify(docs: DataFrame, per_label: int = 500, key: str = "doc_id", column: str = "text", label: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row."""
    return apply(docs, fit(docs, per_label, key, column, label), key, column)


def apply(docs: DataFrame, model: LanguageModel, key: str = "doc_id", column: str = "text") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            out = [own.predict(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x for x, _ in out], pa.string()), pa.array([p for _, p in out], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), (crc_of_id(F.col(key), 4) == 2).alias("held_out"), F.col(column).alias("text"))
    return mapped(rows, predict, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, least: float = 0.5, per_label: int = 500) -> DataFrame:
    """The rows of docs whose language is told with at least that score; all columns stay."""
    model = fit(docs, per_label)
    shared, schema = docs.sparkSession.sparkContext.broadcast(model), docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            told = (own.predict(text) for text in batch.column("text").to_pylist())
            yield batch.filter(pa.array([x != "und" and p >= least for x, p in told], pa.bool_()))

    return mapped(docs, keep, schema)
