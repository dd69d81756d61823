"""Quality classifier by compression: zstandard dictionaries of good and of bad labelled text.

Each text is cut into blocks (all of it is read), each block compressed with either dictionary; the difference of
the two sums of sizes per byte is the evidence, drawn towards none in short texts. A logistic curve turns it, and how
short the text is, into a score. Dictionaries come from two
thirds of a sample of about `per_label` labelled texts of each quality (whole texts), the curve from the rest,
weighted by how often each label occurs. Blocks are short, so that a text's own repeats don't hide which
dictionary suits it, and memory is bounded however long a text is.

Only labels of rows with an id that isn't held out are learned from. Null and empty texts have no evidence and get
a score like any other. With one label value the score is that value, with none 0.5. A doc_id that is labelled
twice counts with its greater label. Repeated rows get equal scores; an empty table gives no rows; extra columns
are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import crc_of_id, draw, mapped

BLOCK, LEVEL, DICTIONARY = 1024, 3, 112_640
#: Bytes at which a text's evidence counts half.
SHORT = 100


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    beta: tuple[float, float, float]  # of the evidence, of shortness, and the shift

    def compressors(self) -> tuple[zstandard.ZstdCompressor, ...]:
        return tuple(zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False, write_checksum=False) for d in (self.good, self.bad))

    def score(self, text: str | None, compressors: tuple | None) -> float:
        z = float(np.dot(self.beta, features(text, *compressors))) if compressors else self.beta[2]
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def blocks(text: str) -> Iterator[bytes]:
    data = text.encode("utf-8")
    for at in range(0, len(data), BLOCK):
        yield data[at : at + BLOCK]


def features(text: str | None, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> tuple[float, float, float]:
    """Bytes that the good dictionary saves against the bad one, per byte of text and SHORT; shortness; 1."""
    more = n = 0
    for block in blocks(text or ""):
        more += len(bad.compress(block)) - len(good.compress(block))
        n += len(block)
    return more / (n + SHORT), SHORT / (n + SHORT), 1.0


def _dictionary(texts: list[str]) -> bytes:
    samples = [b for t in texts for b in blocks(t) if len(b) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: the texts themselves serve as one
        return b"".join(samples)[-DICTIONARY:] or b" " * 8


def train(rows: list[tuple[str, int]], weights: dict[int, float]) -> QualityModel:
    """Fit on (text, label) pairs; weights: of a row of each label."""
    rows = sorted((t or "", int(y)) for t, y in rows)
    seen = {y for _, y in rows}
    if len(seen) < 2:
        return QualityModel(b"", b"", (0.0, 0.0, 0.0 if not seen else 40.0 if seen == {1} else -40.0))
    order = np.random.default_rng(5).permutation(len(rows)).tolist()
    sides: dict[int, list[str]] = {0: [], 1: []}
    for k in order:
        sides[rows[k][1]].append(rows[k][0])
    cut = {y: max(1, 2 * len(x) // 3) for y, x in sides.items()}
    model = QualityModel(_dictionary(sides[1][: cut[1]]), _dictionary(sides[0][: cut[0]]), (0.0, 0.0, 0.0))
    pair = model.compressors()
    data = [(features(t, *pair), y) for y in (0, 1) for t in sides[y][cut[y] :] or sides[y]]
    f, y = np.array([x for x, _ in data]), np.array([v for _, v in data], float)
    w = np.array([weights.get(int(v), 1.0) for v in y])
    w /= w.mean()
    middle, scale = np.append(f[:, :2].mean(axis=0), 0.0), np.append(np.where(f[:, :2].std(axis=0) > 0, f[:, :2].std(axis=0), 1.0), 1.0)
    g, ridge, beta = (f - middle) / scale, np.diag([1.0, 1.0, 1e-3]), np.zeros(3)
    for _ in range(50):  # Newton's method; the ridge keeps a curve from few texts flat
        p = 1 / (1 + np.exp(-np.clip(g @ beta, -40, 40)))
        step = np.linalg.solve((g * (w * p * (1 - p))[:, None]).T @ g + ridge, g.T @ (w * (y - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    own = beta / scale
    model.beta = (float(own[0]), float(own[1]), float(beta[2] - own[:2] @ middle[:2]))
    return model


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 1000, key: str = "doc_id", column: str = "text", label: str = "quality") -> QualityModel:
    usable = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & (crc_of_id(F.col(key), 3) != 1)).groupBy(F.col(key).alias("_id")).agg(F.max(label).alias("label"))
    counts = {r.label: r["count"] for r in usable.groupBy("label").count().collect()}
    drawn = draw(usable, "label", "_id", per_label, "quality")
    texts = docs.select(F.col(key).alias("_key"), F.col(column).alias("text")).join(F.broadcast(drawn), F.col("_key") == F.col("_id"))
    rows = [(r.text, r.label) for r in texts.select("text", "label").collect()]
    sizes = {y: sum(1 for _, v in rows if v == y) for y in counts}
    return train(rows, {y: n / max(1, sizes[y]) for y, n in counts.items()})


def score(docs: DataFrame, labels: DataFrame, per_label: int = 1000, key: str = "doc_id", column: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_label, key, column))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        pair = model.compressors() if model.good else None
        for batch in batches:
            scores = [model.score(text, pair) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), (crc_of_id(F.col(key), 3) == 1).alias("held_out"), F.col(column).alias("text"))
    return mapped(rows, judge, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, per_label: int = 1000) -> DataFrame:
    """The rows of docs that are predicted good; all columns stay."""
    shared, schema = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_label)), docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        pair = model.compressors() if model.good else None
        for batch in batches:
            yield batch.filter(pa.array([model.score(text, pair) >= 0.5 for text in batch.column("text").to_pylist()], pa.bool_()))

    return mapped(docs, keep, schema)
