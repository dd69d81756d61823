"""Hard negatives by a vector-approximation file.

Components are whole numbers (256 times the stored ones, rounded down). Each dimension is cut into 16 cells at quantiles of a
bounded draw of the rows, with the least and greatest value of all rows at the ends, and a vector's approximation is its
cells' numbers, two in a byte. For an anchor, a table of 256 numbers a byte holds the least and the most that its two
dimensions can add to the score; their sums over a row's bytes bound the row's score. Only rows whose bounds let them into
an anchor's best positives, or into one of its windows before the rows found so far, are scored exactly. So results are
exact; the draw decides only how tight the bounds are.

Anchors are a stated set of rows and are compared with all rows in blocks: they go to the tasks in chunks of
`numbers` components (8 MB), each a scan of the approximations. A scan reads some 300 bytes a row and looks up numbers for
thousands of anchors with them, so reading isn't what a chunk costs. Tasks keep a few rows an anchor; only those are
shuffled.

Rows with a null id, label or vector, or with a component that is null or no finite number, take no part. Components count
as 2^17 at most and -2^17 at least, so that scores of 4,096 dimensions fit a long; a vector that is shorter than others is filled with zeros, an
empty one too. Copies of a row count once; rows that share an id but differ are different rows, but never each other's
positives or negatives. Ties go to the smaller id. An anchor without positives, or a window without rows, gives no rows; so
does an empty table. Extra columns don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import new_path
from ._common import materialise, unit_hash

CELLS = 16
TILE_ROWS, TILE_ANCHORS = 2048, 64
MOST = 1 << 25


@dataclass(frozen=True)
class Plan:
    """How many positives, how many negatives each, and the window as hundredths of the positive's score."""

    positives: int = 5
    negatives: int = 10
    least: int = 30
    most: int = 90


def taking_part(df: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """vec_id, label and v (double components) of the rows that take part."""
    whole = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    named = df.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.when(whole, F.col(vector).cast("array<double>")).alias("v"))
    return named.where("vec_id is not null and label is not null and v is not null")


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of whole components as they count, filled with zeros to the width."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.clip(np.floor(256.0 * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)), -MOST, MOST).astype(np.int64)
    width = int(lengths.max(initial=0)) if width is None else width
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _extremes(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, and each dimension's least and greatest component of all rows (0 counts where some rows are shorter)."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high, reached = 0, np.zeros(0, np.int64), np.zeros(0, np.int64), []
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch.column("v"))
                n += len(m)
                reached.append((m.shape[1], len(m)))
                width = max(len(low), m.shape[1])
                grown = [np.full(width, x) for x in (1 << 62, -(1 << 62))]
                for whole, part, best in ((grown[0], low, np.minimum), (grown[1], high, np.maximum)):
                    whole[: len(part)] = part
                    whole[: m.shape[1]] = best(whole[: m.shape[1]], (m.min(0) if best is np.minimum else m.max(0)))
                low, high = grown
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(low))], pa.int32()), pa.array([n, *[0] * len(low)], pa.int64()), pa.array([0, *low], pa.int64()), pa.array([0, *high], pa.int64())], ["dim", "n", "low", "high"])

    found = rows.select("v").mapInArrow(of_task, "dim int, n long, low long, high long").groupBy("dim").agg(F.sum("n"), F.min("low"), F.max("high")).collect()
    by = {r[0]: r for r in found}
    width = max(by, default=-1) + 1
    # zeros stand where a shorter row has nothing
    return int(by[-1][1]) if -1 in by else 0, np.array([min(0, by[d][2]) for d in range(width)], np.int64), np.array([max(0, by[d][3]) for d in range(width)], np.int64)


def cells(rows: DataFrame, draw: int) -> tuple[int, np.ndarray]:
    """Number of rows and the cells' edges, one row of CELLS + 1 whole numbers a dimension: cell c holds edge c to below edge c + 1."""
    n, low, high = _extremes(rows)
    if not n or not len(low):
        return n, np.zeros((len(low), CELLS + 1), np.int64)
    drawn = rows.where(unit_hash(F.col("vec_id"), "cells") < min(1.0, draw / n)).select("v").limit(2 * draw).toArrow()
    sample = _matrix(drawn.column("v").combine_chunks(), len(low)) if drawn.num_rows else np.stack([low, high])
    inner = np.ceil(np.quantile(sample, np.arange(1, CELLS) / CELLS, axis=0)).astype(np.int64).T
    edges = np.concatenate([low[:, None], np.clip(inner, low[:, None], high[:, None] + 1), high[:, None] + 1], axis=1)
    return n, np.maximum.accumulate(edges, axis=1)


def approximated(rows: DataFrame, edges: np.ndarray) -> DataFrame:
    """vec_id, label, cells (two cells in a byte) and components (32-bit little-endian whole numbers)."""
    width = len(edges)

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column("v"), width)
            code = np.zeros((len(m), width + width % 2), np.uint8)
            for d in range(width):
                code[:, d] = np.searchsorted(edges[d, 1:-1], m[:, d], side="right")
            packed = code[:, ::2] * np.uint8(CELLS) + code[:, 1::2]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _binary(packed), _binary(m.astype("<i4"))], ["vec_id", "label", "cells", "components"])

    return materialise(rows.mapInArrow(of_batch, "vec_id long, label long, cells binary, components binary"), "approximations")


def _binary(m: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in m], pa.binary())


def _rows(column: pa.Array, kind: str, width: int) -> np.ndarray:
    n = len(column)
    if not n or not width:
        return np.zeros((n, width), kind)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(n, width)


class Best:
    """The best few exact scores of each of some queries, so far."""

    def __init__(self, queries: int, most: int):
        self.most = most
        self.score = np.full((queries, most), -(1 << 62), np.int64)
        self.id = np.full((queries, most), -1, np.int64)
        self.full = np.zeros((queries, most), bool)

    def bar(self, queries: np.ndarray) -> np.ndarray:
        """What a row's score must reach, by query: the last place's, once all are taken."""
        return self.score[queries, -1]

    def add(self, query: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        """Copies (same query, score and id) count once."""
        if not len(query):
            return
        of = np.unique(query)
        old = self.full[of]
        q = np.concatenate([query, np.repeat(of, self.most)[old.ravel()]])
        s, i = np.concatenate([score, self.score[of][old]]), np.concatenate([vec, self.id[of][old]])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (s[1:] != s[:-1]) | (i[1:] != i[:-1])
        q, s, i = q[new], s[new], i[new]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.most
        q, place = q[keep], place[keep]
        self.score[q, place], self.id[q, place], self.full[q, place] = s[keep], i[keep], True

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, place = np.nonzero(self.full)
        return q, self.score[q, place], self.id[q, place]


def _bounds(anchors: np.ndarray, edges: np.ndarray, upper: bool) -> np.ndarray:
    """For each byte of an approximation, 256 rows of what it adds to the bound, a column for each anchor."""
    least, most = edges[:, :-1], np.maximum(edges[:, 1:] - 1, edges[:, :-1])
    a, b = anchors.T[:, None, :] * least[:, :, None], anchors.T[:, None, :] * most[:, :, None]
    each = np.maximum(a, b) if upper else np.minimum(a, b)  # dimension, cell, anchor
    if len(each) % 2:
        each = np.concatenate([each, np.zeros((1, *each.shape[1:]), np.int64)])
    table = (each[::2, :, None, :] + each[1::2, None, :, :]).reshape(-1, CELLS * CELLS, anchors.shape[0])
    return table.astype(np.int32) if np.abs(table).max(axis=(1, 2), initial=0).sum() < 1 << 31 else table


def _summed(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The bounds of each row (down) with each anchor (across)."""
    out = np.zeros((len(codes), table.shape[2]), table.dtype)
    one = np.empty_like(out)
    for k in range(len(table)):
        out += np.take(table[k], codes[:, k], axis=0, out=one)
    return out


#: Pairs whose components are held at once.
PAIRS = 1 << 14


def _exact(vectors: np.ndarray, anchors: np.ndarray, row: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    out = np.zeros(len(row), np.int64)
    for k in range(0, len(row), PAIRS):
        some = slice(k, k + PAIRS)
        out[some] = np.einsum("ij,ij->i", vectors[row[some]].astype(np.int64), anchors[anchor[some]])
    return out


@dataclass
class Chunk:
    """Some anchors: ids, labels and components; and of each, scores that bound its windows (none: least above most)."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    least: np.ndarray | None = None
    most: np.ndarray | None = None


def _scan(approximations: DataFrame, edges: np.ndarray, chunk: Chunk, keep: int) -> DataFrame:
    """Each task's best rows of each anchor (of its label) or of each of an anchor's windows (of other labels): query, score, vec_id."""
    sent, width = approximations.sparkSession.sparkContext.broadcast((chunk, edges)), len(edges)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, edges = sent.value
        windows = 1 if chunk.least is None else chunk.least.shape[1]
        best = Best(len(chunk.ids) * windows, keep)
        for batch in batches:
            ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
            codes, vectors = _rows(batch.column("cells"), "u1", (width + 1) // 2), _rows(batch.column("components"), "<i4", width)
            for first in range(0, len(chunk.ids), TILE_ANCHORS):
                some = np.arange(first, min(first + TILE_ANCHORS, len(chunk.ids)))
                anchors = chunk.vectors[some]
                tables = [_bounds(anchors, edges, upper) for upper in ((True,) if chunk.least is None else (True, False))]
                for at in range(0, len(ids), TILE_ROWS):
                    rows = slice(at, at + TILE_ROWS)
                    same, other = labels[rows, None] == chunk.labels[None, some], ids[rows, None] != chunk.ids[None, some]
                    upper = _summed(tables[0], codes[rows])
                    if chunk.least is None:
                        row, anchor = np.nonzero(same & other & (upper >= best.bar(some)[None, :]))
                        score = _exact(vectors[rows], anchors, row, anchor)
                        best.add(some[anchor], score, ids[rows][row])
                        continue
                    lower, open_to = _summed(tables[1], codes[rows]), other & ~same
                    bars = np.stack([np.maximum(best.bar(some * windows + w), chunk.least[some, w]) for w in range(windows)])
                    may = np.zeros_like(same)
                    for w in range(windows):
                        may |= (upper >= bars[w][None, :]) & (lower <= chunk.most[some, w][None, :])
                    row, anchor = np.nonzero(may & open_to)
                    score = _exact(vectors[rows], anchors, row, anchor)
                    for w in range(windows):
                        inside = (score >= bars[w][anchor]) & (score <= chunk.most[some, w][anchor])
                        best.add(some[anchor[inside]] * windows + w, score[inside], ids[rows][row[inside]])
        found = best.rows()
        for k in range(0, len(found[0]), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[k : k + (1 << 16)], pa.int64()) for x in found], ["query", "score", "vec_id"])

    return approximations.mapInArrow(of_task, "query long, score long, vec_id long")


def _first(found: DataFrame, most: int) -> DataFrame:
    """The first `most` of each query, with place from 1; copies that tasks found apart count once."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.select("*", F.dense_rank().over(order).alias("place"), F.row_number().over(order).alias("_n"))
    again = Window.partitionBy("query").orderBy("_n")
    return ranked.where(F.col("place") <= most).withColumn("_before", F.lag("place").over(again)).where("_before is null or _before <> place").drop("_n", "_before")


def mined(df: DataFrame, anchor: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding", plan: Plan = Plan(), draw: int = 20_000, numbers: int = 1_000_000) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    anchor: which of the rows (vec_id, label, v) are anchors. An anchor's positives are the `positives` rows of its label
    with the highest scores, its negatives for each of them the first `negatives` rows of other labels whose score lies
    between `least` and `most` hundredths of the positive's.
    """
    spark, rows = df.sparkSession, taking_part(df, key, label, vector)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    n, edges = cells(rows, draw)
    if not n:
        return spark.createDataFrame([], schema)
    width = len(edges)
    table = approximated(rows, edges)
    asked = table.where(anchor).select("vec_id", "label", "components").distinct()
    chunks = -(-asked.count() * max(width, 1) // numbers)
    if chunks > 1:
        asked = materialise(asked.withColumn("_chunk", F.pmod(F.xxhash64("vec_id", "components"), F.lit(chunks)).cast("int")), "anchors", by=["_chunk"])
    path = new_path(spark, "negatives")
    for c in range(chunks):
        some = (asked.where(F.col("_chunk") == c) if chunks > 1 else asked).toArrow().combine_chunks()
        if not some.num_rows:
            continue
        chunk = Chunk(some.column("vec_id").to_numpy(), some.column("label").to_numpy(), _rows(some.column("components"), "<i4", width).astype(np.int64))
        best = _first(_scan(table, edges, chunk, plan.positives), plan.positives).toArrow()
        query, score, vec, place = (best.column(x).to_numpy() for x in ("query", "score", "vec_id", "place"))
        size = (len(chunk.ids), plan.positives)
        positive, reached = np.zeros(size, np.int64), np.zeros(size, np.int64)
        chunk.least, chunk.most = np.full(size, 1, np.int64), np.full(size, 0, np.int64)
        positive[query, place - 1], reached[query, place - 1] = vec, score
        exact = score.astype(object)  # a hundredfold score may not fit
        chunk.least[query, place - 1], chunk.most[query, place - 1] = -(-plan.least * exact // 100), plan.most * exact // 100
        # a window that none can enter asks for more than any score
        chunk.least[chunk.least > chunk.most] = 1 << 62
        names = spark.createDataFrame(
            pa.table({"query": np.arange(positive.size), "anchor_id": np.repeat(chunk.ids, plan.positives), "positive_id": positive.ravel(), "positive_score": reached.ravel()}),
        )
        found = _first(_scan(table, edges, chunk, plan.negatives), plan.negatives)
        out = found.join(F.broadcast(names), "query").select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path) if chunks else spark.createDataFrame([], schema)
