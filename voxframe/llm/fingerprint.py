"""SimHash fingerprints and the search for all within a Hamming radius.

Terms are pairs of neighbouring words (a text of one word has that word); each adds its weight, which grows with
its length, to the bits that its hash has set and takes it from the others, so the weight of a term in a text is its count
times that. Bits with a positive sum are set. Fingerprints have 256 bits, kept as 64 hex digits.

Search: bits are cut into blocks; two fingerprints within the radius differ in `radius` blocks at most, so with
`blocks` blocks they agree in `blocks - radius` whole ones. For each choice of that many blocks there is a table
keyed by them: the permuted block tables. A pair that agrees in more blocks counts in the table of the first of
them alone. Equal fingerprints are one class beforehand. Blocks should be so long that those a table is keyed by
have more bits than the number of fingerprints.

That form is for small radii (`within_radius`). Texts whose sets of five words have a similarity of 0.8 are about 23 bits
apart, so `near_lists` has a radius of RADIUS, and second-level tables: in one of 16 blocks at least, a pair within the
radius differs in a few bits (two, or one) at most; a table for each block holds the queries, and each fingerprint looks
up its own block and those as near to it. Nothing is lost within the radius. Of 694 texts of 60 to 400 words with words
replaced down to 0.8, 38 bits have 99.7 %, 40 bits 99.9 %, and RADIUS all.

Null and empty texts, and texts without words, have a fingerprint of zeros. Repeated rows have equal fingerprints.
An empty table gives no rows.

Extra columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import discard, in_ranges
from ._common import mapped
from ._textnp import buffers, mix, words

BITS = 256
LONGEST = 24
SEEDS = tuple(range(31, 31 + BITS // 64))
RADIUS = 44
BLOCKS = BITS // 16
#: Queries that are sent to all tasks at once (32 bytes each, and 4 more a block in the tables).
CHUNK = 200_000
#: Stands for a null id where numbers must not become fractions.
NO_ID = -(1 << 63)


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """One row of BITS / 8 bytes for each text."""
    data, offsets = buffers(pa.array(texts, pa.large_string()))
    hashes, lengths, at = words(data, offsets)
    out = np.zeros((len(texts), BITS // 8), dtype=np.uint8)
    if not len(hashes):
        return out
    n = np.diff(at)
    single = at[:-1][n == 1]
    two = hashes[:-1] * np.uint64(0xD6E8FEB86659FD93) + mix(hashes[1:], 11)
    weight = np.minimum(lengths[:-1] + lengths[1:], LONGEST).astype(np.float32)
    inside = np.ones(len(hashes), dtype=bool)
    inside[at[1:][n > 0] - 1] = False  # a row's last word begins no pair
    terms = np.concatenate([two, np.zeros(1, np.uint64)])
    weights = np.concatenate([weight, np.zeros(1, np.float32)])
    terms[single], weights[single] = hashes[single], 1
    inside[single] = True
    row = np.repeat(np.arange(len(texts)), n)
    for a in range(0, len(texts), 64):
        b = min(len(texts), a + 64)
        span = slice(at[a], at[b])
        keep = inside[span]
        own, own_weights, own_row = terms[span][keep], weights[span][keep], row[span][keep]
        if not len(own):
            continue
        votes = np.zeros((b - a, BITS), dtype=np.float64)
        starts = np.searchsorted(own_row, np.arange(a, b + 1))
        both = np.stack([mix(own, seed) for seed in SEEDS], axis=1).view(np.uint8)
        for k in range(b - a):
            for i in range(starts[k], starts[k + 1], 1 << 14):
                j = min(starts[k + 1], i + (1 << 14))
                w = own_weights[i:j]
                votes[k] += 2.0 * (w @ np.unpackbits(both[i:j], axis=1).astype(np.float32)) - w.sum(dtype=np.float64)
        out[a:b] = np.packbits(votes > 0, axis=1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 less the share of bits that differ."""
    return 1 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def fingerprint_column(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """doc_id and fingerprint of every row."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array([bytes(x).hex() for x in fingerprints(some.column(1).to_pylist())], pa.string())], ["doc_id", "fingerprint"])

    return mapped(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(column).alias("text")), take, "doc_id long, fingerprint string")


def _bits_apart(a: Column, b: Column) -> Column:
    half = lambda x, k: F.conv(F.substring(x, 1 + 8 * k, 8), 16, 10).cast("long")
    return sum((F.bit_count(half(a, k).bitwiseXOR(half(b, k))) for k in range(BITS // 32)), F.lit(0))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = 7, blocks: int = 8) -> DataFrame:
    """All pairs of distinct fingerprints (query, fingerprint, bits_apart) within the radius, query from `queries`.

    Both frames have a column fingerprint. Tables: all choices of blocks - radius blocks.
    """
    if radius >= blocks or BITS // 4 % blocks:
        raise ValueError("there must be more blocks than the radius, of whole hex digits each")
    digits, agreeing = BITS // 4 // blocks, blocks - radius
    block = lambda c, i: F.substring(c, 1 + digits * i, digits)
    name = lambda chosen: ",".join(map(str, chosen))
    choices = [F.struct(F.lit(name(chosen)).alias("chosen"), F.concat(*(block("fingerprint", i) for i in chosen)).alias("bits")) for chosen in combinations(range(blocks), agreeing)]
    tables = lambda df, own: df.select("fingerprint").distinct().select(F.col("fingerprint").alias(own), F.explode(F.array(*choices)).alias("t")).select(own, "t.*")
    one, two = tables(queries, "query"), tables(prints, "found")
    same = F.array_compact(F.array(*(F.when(block("query", i) == block("found", i), F.lit(str(i))) for i in range(blocks))))
    first = F.array_join(F.slice(same, 1, agreeing), ",") == one["chosen"]
    apart = _bits_apart(F.col("query"), F.col("found"))
    on = (one["chosen"] == two["chosen"]) & (one["bits"] == two["bits"]) & (F.col("query") != F.col("found")) & first & (apart <= radius)
    return one.join(two, on).select("query", F.col("found").alias("fingerprint"), apart.cast("int").alias("bits_apart"))


def with_next(docs: DataFrame, buckets: int, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Rows (bucket, lead, doc_id, text) for a pass in falling order of doc_id within each bucket.

    The ids alone are range-partitioned first and written; the greatest of each range begins a bucket. The first row of each
    bucket is also sent, as a lead, to the bucket before it (of the first one, to the last), so each row's next stands in
    its own bucket, which is a partition. Besides these few copies every text is moved once. What all tasks get is one number a bucket.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(column).alias("text"))
    ranged = in_ranges(rows.where("doc_id is not null").select("doc_id"), [F.col("doc_id")], buckets)
    tops = [r.top for r in ranged.groupBy("_p").agg(F.max("doc_id").alias("top")).collect()]
    discard(ranged)
    shared = docs.sparkSession.sparkContext.broadcast(np.array(sorted(tops), np.int64))

    @F.pandas_udf("bucket int, head boolean")
    def placed(ids: pd.Series) -> pd.DataFrame:
        """Buckets are numbered from the greatest id down; rows without an id come last of all."""
        above, own = shared.value, ids.to_numpy()
        if not len(above):
            return pd.DataFrame({"bucket": np.zeros(len(own), np.int32), "head": np.zeros(len(own), bool)})
        k, known = np.searchsorted(above, own), own != NO_ID
        head = known & (above[np.minimum(k, len(above) - 1)] == own)
        return pd.DataFrame({"bucket": np.where(known, len(above) - 1 - k, len(above) - 1).astype("int32"), "head": head})

    last = max(len(tops) - 1, 0)
    before = F.when(F.col("at.head") | (F.lit(not tops) & F.col("doc_id").isNull()), F.pmod(F.col("at.bucket") - 1, F.lit(last + 1)))
    copies = F.array(F.struct(F.col("at.bucket").alias("bucket"), F.lit(False).alias("lead")), F.struct(before.alias("bucket"), F.lit(True).alias("lead")))
    spread = rows.withColumn("at", placed(F.coalesce("doc_id", F.lit(NO_ID)))).withColumn("to", F.explode(F.filter(copies, lambda x: x["bucket"].isNotNull())))
    return spread.select("to.bucket", "to.lead", "doc_id", "text").repartitionById(last + 1, "bucket").sortWithinPartitions("bucket", "lead", F.desc_nulls_last("doc_id"), F.xxhash64("text"))


def edited_likeness(docs: DataFrame, key: str = "doc_id", column: str = "text", buckets: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next document's are.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document by falling doc_id; the first follows the last; null ids come last, equal ones in the order of a hash of
    the text. A lone row is its own next.
    """
    # two for each part of the input that Spark reads at once, so a bucket's bytes don't grow with the table
    buckets = buckets or max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * docs.rdd.getNumPartitions())
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def finish(rows: list[tuple]) -> pa.RecordBatch:
        """rows: (doc_id, text, next text)."""
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for _, t, n in rows]
        own = fingerprints([t for _, t, _ in rows])
        following = np.concatenate([own[1:], fingerprints([rows[-1][2]])])
        after = fingerprints(edited)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _, _ in rows], pa.int64()),
                pa.array([len(t) for _, t, _ in rows], pa.int64()),
                pa.array([hashlib.sha256(e.encode("utf-8")).hexdigest() for e in edited]),
                pa.array([bytes(x).hex() for x in own]),
                pa.array([bytes(x).hex() for x in after]),
                pa.array(likeness(own, after)),
                pa.array(likeness(own, following)),
            ],
            names,
        )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # rows in order, each but the last with its next
        size, bucket, led = 0, None, False
        for batch in batches:
            for own, lead, doc, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                text = text or ""
                if own != bucket:
                    bucket, led = own, False
                if led:
                    continue  # of several equal heads the first counts
                if waiting:
                    waiting[-1] = (*waiting[-1][:2], text)
                if lead:
                    led = True
                    if waiting:
                        yield finish(waiting)
                    waiting, size = [], 0
                    continue
                if size > 1 << 20 or len(waiting) >= 512:
                    yield finish(waiting)
                    waiting, size = [], 0
                waiting.append((doc, text, ""))
                size += len(text)
        if waiting:
            yield finish(waiting)

    return mapped(with_next(docs, buckets, key, column), walk, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def with_near_counts(prints: DataFrame, query: Column, radius: int = 7, blocks: int = 8) -> DataFrame:
    """prints with n_near: of rows that are queries, how many other distinct fingerprints are within the radius; else null."""
    asked = prints.where(query)
    near = within_radius(prints, asked, radius, blocks).groupBy("query").agg(F.count(F.lit(1)).alias("n_near"))
    counted = asked.join(near, F.col("fingerprint") == F.col("query"), "left").select(*prints.columns, F.coalesce("n_near", F.lit(0)).alias("n_near"))
    return counted.unionByName(prints.where(~F.coalesce(query, F.lit(False))).withColumn("n_near", F.lit(None).cast("long")))


class BlockTables:
    """Fingerprints (n, BITS / 8) in a table for each block of 16 bits."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = np.ascontiguousarray(prints), radius
        few, more = divmod(radius, BLOCKS)
        #: If the first more + 1 blocks all differed in over `few` bits and the others in `few` or more, it would be over the radius.
        self.most = np.array([few] * (more + 1) + [few - 1] * (BLOCKS - more - 1))
        keys = self.prints.view(np.uint16)
        self.order = [np.argsort(keys[:, b], kind="stable").astype(np.int32) for b in range(BLOCKS)]
        self.start = [np.concatenate([[0], np.cumsum(np.bincount(keys[:, b], minlength=1 << 16))]) for b in range(BLOCKS)]

    def find(self, others: np.ndarray, at_once: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places in others, in the tables, and bits apart of all pairs within the radius, once each."""
        others = np.ascontiguousarray(others)
        keys, ones = others.view(np.uint16), np.bitwise_count(np.arange(1 << 16, dtype=np.uint16))
        for b in np.flatnonzero(self.most >= 0):
            probes = (keys[:, b, None] ^ np.flatnonzero(ones <= self.most[b]).astype(np.uint16)).astype(np.int64)
            n = self.start[b][probes + 1] - self.start[b][probes]
            row, column = np.nonzero(n)
            n, first = n[row, column], self.start[b][probes[row, column]]
            ends = np.cumsum(n)
            i = 0
            while i < len(n):
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + at_once, "right")))
                size = n[i:j]
                own = np.repeat(row[i:j], size)
                found = self.order[b][np.arange(size.sum()) + np.repeat(first[i:j] - (np.cumsum(size) - size), size)]
                apart = np.bitwise_count(others.view(np.uint64)[own] ^ self.prints.view(np.uint64)[found]).sum(axis=1, dtype=np.int32)
                near = np.flatnonzero(apart <= self.radius)
                own, found, apart = own[near], found[near], apart[near]
                # a pair counts in the first block that has it
                in_block = np.bitwise_count(keys[own] ^ self.prints.view(np.uint16)[found]) <= self.most
                once = np.argmax(in_block, axis=1) == b
                yield own[once], found[once], apart[once]
                i = j


NEAR = "array<struct<bits_apart: int, fingerprint: string, doc_id: bigint, n_docs: bigint>>"


def _packed(hexed: list[str]) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(hexed)), np.uint8).reshape(-1, BITS // 8)


def near_classes(prints: DataFrame, asked: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """query, near: of each distinct fingerprint of `asked`, all classes of equal fingerprints of `prints` within the radius.

    A class has its fingerprint, its smallest doc_id and its number of rows; the query's own is there with 0 bits.
    The queries go to the tasks in chunks; the classes stay where they are, so no group of near ones meets in one task,
    and what a task has found for a query is one list.
    """
    spark = prints.sparkSession
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_docs"))
    wanted = asked.select("fingerprint").distinct()
    chunks = math.ceil(wanted.count() / chunk)
    parts = [spark.createDataFrame([], f"query string, found {NEAR}")]
    for k in range(chunks):
        own = [r[0] for r in wanted.where(F.pmod(F.xxhash64("fingerprint"), F.lit(chunks)) == k).collect()]
        if not own:
            continue
        shared = spark.sparkContext.broadcast(_packed(own))

        def lists(batch: pa.RecordBatch, rows: np.ndarray, at: np.ndarray, apart: np.ndarray, shared=shared) -> pa.RecordBatch:
            order = np.argsort(at, kind="stable")
            query, first = np.unique(at[order], return_index=True)
            taken = batch.take(pa.array(rows[order]))
            found = pa.StructArray.from_arrays([pa.array(apart[order], pa.int32()), *(taken.column(i) for i in range(3))], ["bits_apart", "fingerprint", "doc_id", "n_docs"])
            near = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), found)
            return pa.RecordBatch.from_arrays([pa.array([bytes(shared.value[q]).hex() for q in query], pa.string()), near], ["query", "found"])

        def search(batches: Iterator[pa.RecordBatch], shared=shared, lists=lists) -> Iterator[pa.RecordBatch]:
            tables, waiting, size = BlockTables(shared.value, radius), [], 0

            def flush() -> pa.RecordBatch:
                rows = np.concatenate([np.asarray(x[1]) + before for x, before in zip(waiting, np.cumsum([0, *(x[0].num_rows for x in waiting[:-1])]), strict=True)])
                whole = pa.Table.from_batches([x[0] for x in waiting]).combine_chunks().to_batches()[0]
                return lists(whole, rows, *(np.concatenate([x[i] for x in waiting]) for i in (2, 3)))

            for batch in batches:
                if not batch.num_rows:
                    continue
                for rows, at, apart in tables.find(_packed(batch.column(0).to_pylist())):
                    if not len(rows):
                        continue
                    used, place = np.unique(rows, return_inverse=True)
                    waiting.append((batch.take(pa.array(used)), place, at, apart))
                    size += len(rows)
                    if size >= 1 << 17:
                        yield flush()
                        waiting, size = [], 0
            if waiting:
                yield flush()

        parts.append(mapped(classes, search, f"query string, found {NEAR}"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.groupBy("query").agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("near"))


def near_lists(prints: DataFrame, query: Column, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """prints with near, n_near and n_near_docs of rows that are queries; null for the others.

    near has all classes of equal fingerprints within the radius, nearest first, the row's own among them; the members of
    a class are the rows with its fingerprint. n_near counts the other classes, n_near_docs all other rows in them and
    in the row's own.
    """
    asked = prints.where(query)
    near = near_classes(prints, asked, radius, chunk)
    counts = [(F.size("near") - 1).cast("long").alias("n_near"), (F.aggregate("near", F.lit(0).cast("long"), lambda n, x: n + x["n_docs"]) - 1).alias("n_near_docs")]
    counted = asked.join(near, F.col("fingerprint") == F.col("query"), "left").select(*prints.columns, "near", *counts)
    others = prints.where(~F.coalesce(query, F.lit(False)))
    return counted.unionByName(others.select("*", F.lit(None).cast(NEAR).alias("near"), *(F.lit(None).cast("long").alias(c) for c in ("n_near", "n_near_docs"))))
