"""Token counts by a two-tier lookup, without any shuffle of pre-tokens.

First tier: a broadcast table of the lengths of frequent pre-tokens, of at most `table_size` entries. Each
task counts the pre-tokens of its rows in a bounded summary (counters; when full, the rarer half goes) and
hands on one row; these rows, one a task, are merged as a tree under the same bound. Second tier: a miss is
encoded and kept in a bounded cache of the worker. The table only saves time: a piece that it lacks is encoded,
so every count is exact whatever the table holds.

Nulls and empty texts have 0 tokens; rows are independent, so repeated rows and extra columns don't matter.

An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import mapped
from .pretokens import encoder, split

TABLE_SIZE = 32_768
#: Summaries that one task merges.
FAN = 16
SUMMARY = "pieces array<string>, seen array<long>"


def _prune(counts: Counter, most: int) -> Counter:
    return Counter(dict(heapq.nlargest(most, counts.items(), key=lambda x: (x[1], x[0]))))


def _rows(counts: Counter, most: int) -> pa.RecordBatch:
    top = _prune(counts, most)
    return pa.RecordBatch.from_pydict({"pieces": pa.array([list(top)], pa.list_(pa.string())), "seen": pa.array([list(top.values())], pa.list_(pa.int64()))})


def frequent_pieces(docs: DataFrame, column: str = "text", table_size: int = TABLE_SIZE) -> list[str]:
    """Pre-tokens that are frequent over all rows, most frequent first; at most table_size."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    counts.update(split(text))
                if len(counts) > 8 * table_size:
                    counts = _prune(counts, 4 * table_size)
        yield _rows(Counter({k: n for k, n in counts.items() if n > 1 and len(k) <= 64}), table_size)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for pieces, seen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for piece, n in zip(pieces, seen, strict=True):
                    counts[piece] += n
                counts = _prune(counts, 4 * table_size) if len(counts) > 8 * table_size else counts
        yield _rows(counts, table_size)

    each = mapped(docs.select(F.col(column)), summarise, SUMMARY)
    parts = docs.rdd.getNumPartitions()  # known from the plan, without a job
    while parts > 1:
        parts = -(-parts // FAN)
        each = mapped(each.repartition(parts), merge, SUMMARY)
    row = each.first()
    return list(row.pieces) if row else []


def token_counts(docs: DataFrame, path: str, limit: int = 1024, key: str = "doc_id", column: str = "text", table_size: int = TABLE_SIZE) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row."""
    coder = encoder(path)
    table = {piece: len(coder.ids[piece]) // 4 for piece in frequent_pieces(docs, column, table_size)}
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, first = encoder(path), shared.value
        ids = coder.ids

        class Lengths(dict):
            def __missing__(self, piece: str) -> int:
                if len(self) > len(first) + ids.most:
                    self.clear()
                    self.update(first)
                n = len(ids.encode(piece.encode("utf-8")))
                if len(piece) <= 64:
                    self[piece] = n
                return n

        lengths = _CACHES.get(path)
        if lengths is None:
            lengths = _CACHES[path] = Lengths(first)
        get = lengths.__getitem__
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                n_bytes.append(len(text.encode("utf-8")))
                n_tokens.append(sum(1 if k % 2 else sum(map(get, split(part))) for k, part in enumerate(coder.parts(text))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    out = mapped(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(column).alias("text")), count, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


_CACHES: dict[str, dict] = {}
