"""Line dedup by levelled sorted runs of line hashes, with DataFrame functions only.

A store keeps runs: tables (hash_a, hash_b, n_docs, last_doc) in buckets of the hash and sorted by it within, each
made from one batch of documents. Level 0 holds the newest; two runs of a level are merged into one of the next. All
runs have the same buckets, so a batch that has been dealt out by hash once is merged against all of them, and runs
with each other, without moving or sorting a run again. What no run holds (the anti-join's side of the merge) is new
with this batch; then the batch adds its own run. Every stored line is rewritten once a level, and a batch reads one run a
level at most. Batches come by falling doc_id, so the batch
to which a line is new has the largest doc_id that holds it; later runs only add to the count.

Runs are written to the shared folder; a run is listed only once it is whole, so a lost executor costs a
rerun of its tasks.

Null and empty texts have one empty line. Rows with the same doc_id are one document; a null doc_id is a document
of its own kind, before all others. An empty table gives no rows. `dedup_lines` keeps extra columns as they are, but for
those that it puts anew, whose names can be chosen.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import discard, new_path, remove, settings
from ._common import materialise

# The white space that is stripped, and the letters that are lower-cased.
STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["hash_a", "hash_b"]
NO_ID = -(1 << 63)


def stripped(line: Column) -> Column:
    return F.trim(line, F.lit(STRIPPED))


def line_hash(line: Column, salt: int | None = None) -> Column:
    """64-bit hash of a line's key."""
    key = F.translate(stripped(line), UPPER, LOWER)
    return F.xxhash64(key) if salt is None else F.xxhash64(F.lit(salt), key)


def lines_of(docs: DataFrame, least: int, key: str = "doc_id", column: str = "text", carry: list[str] | None = None) -> DataFrame:
    """doc, hash_a, hash_b and carried columns of the lines whose key has at least `least` code points."""
    carry = carry or []
    line = F.explode(F.split(F.coalesce(column, F.lit("")), "\n", -1)).alias("line")
    long = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc"), *carry, line).where(F.length(stripped(F.col("line"))) >= least)
    return long.select("doc", line_hash(F.col("line")).alias("hash_a"), line_hash(F.col("line"), 1).alias("hash_b"), *carry)


#: A bucketed table's own order counts in plans. Each bucket is one file, as rows are written where their hash has been dealt to.
SORTED = {"spark__sql__legacy__bucketedTableScan__outputOrdering": "true", "spark__sql__adaptive__localShuffleReader__enabled": "false"}


class LineRuns:
    """Levelled runs of line hashes with the number of documents and the largest doc that hold each."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The lines (with hash_a, hash_b) that no run holds."""
        return reduce(lambda rest, run: rest.join(run.select(*HASH), HASH, "left_anti"), self.runs(), lines)

    def add(self, lines: DataFrame) -> None:
        """Store a batch's lines (doc, hash_a, hash_b), all of lower doc than those before; last_doc goes to new ones."""
        own = lines.select("doc", *HASH).distinct().groupBy(*HASH).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("last_doc"))
        # one merge with each run tells both what it holds and what it doesn't
        seen = [f"_in{k}" for k in range(len(self.runs()))]
        for mark, run in zip(seen, self.runs(), strict=True):
            own = own.join(run.select(*HASH, F.lit(True).alias(mark)), HASH, "left")
        fresh = F.coalesce(*map(F.col, seen)).isNull() if seen else F.lit(True)
        self._put(0, own.select(*HASH, "n_docs", F.when(fresh, F.col("last_doc")).alias("last_doc")))

    def _put(self, level: int, run: DataFrame) -> None:
        """One run at this level; two of them become one of the next."""
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"run{level}_{uuid.uuid4().hex}"
        path = self.paths[name] = new_path(self.spark, name)
        with settings(self.spark, **SORTED):
            run.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
        self.levels[level].append(name)
        if len(self.levels[level]) == 2:
            self._merge(level, self.levels[level])

    def _merge(self, level: int, pair: list[str]) -> None:
        self.levels = [[x for x in own if x not in pair] for own in self.levels]
        self._put(level + 1, merged(*map(self.spark.table, pair)))
        self._drop(pair)

    def whole(self) -> DataFrame:
        """All that is stored, as one run."""
        while len(self.runs()) > 1:
            level, small = next((k, own[0]) for k, own in enumerate(self.levels) if own)
            level, large = next((k, own[0]) for k, own in enumerate(self.levels) if own and own[0] != small)
            self._merge(level, [small, large])
        return self.runs()[0]

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"drop table {name}")
            remove(self.spark, self.paths.pop(name))

    def clear(self) -> None:
        """Remove all runs."""
        self._drop([name for level in self.levels for name in level])
        self.levels = []


def merged(one: DataFrame, two: DataFrame) -> DataFrame:
    """Both runs' lines by one merge of the two as they lie; runs are apart by document, so counts add up."""
    a, b = one.alias("a"), two.alias("b")
    keys = [F.coalesce(F.col(f"a.{h}"), F.col(f"b.{h}")).alias(h) for h in HASH]
    count = F.coalesce("a.n_docs", F.lit(0)) + F.coalesce("b.n_docs", F.lit(0))
    return a.join(b, [F.col(f"a.{h}") == F.col(f"b.{h}") for h in HASH], "full").select(*keys, count.alias("n_docs"), F.greatest("a.last_doc", "b.last_doc").alias("last_doc"))


def batches_of(docs: DataFrame, key: str) -> int:
    """One batch for each BATCH documents, and a few at least."""
    return max(4, docs.select(key).count() // BATCH)


BATCH = 50_000_000


def repeated_lines(docs: DataFrame, least: int, copies: int, batches: int | None = None, key: str = "doc_id", column: str = "text") -> tuple[DataFrame, DataFrame, LineRuns]:
    """All long lines (doc, hashes, batch), the run of those that at least `copies` documents hold, and the store."""
    batches = batches or batches_of(docs, key)
    ids = docs.select(F.col(key).cast("long").alias("doc")).where("doc is not null")
    spread = ids.approxQuantile("doc", [k / batches for k in range(1, batches)], min(0.01, 0.2 / batches))
    cuts = F.array(*map(F.lit, sorted({int(x) for x in spread}))).cast("array<bigint>")
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(column).alias("text"))
    dealt = rows.withColumn("batch", F.size(F.filter(cuts, lambda c: c > F.col("doc"))))
    lines = materialise(lines_of(dealt, least, "doc", "text", ["batch"]), "lines", ["batch"])
    store = LineRuns(docs.sparkSession)
    for k in range(batches):
        store.add(lines.where(F.col("batch") == k))
    return lines, store.whole().where(F.col("n_docs") >= copies), store


#: The most common lines, which are sent to where lines lie (32 bytes each).
COMMON = 10_000


def with_last(lines: DataFrame, repeated: DataFrame, most: int = COMMON) -> DataFrame:
    """doc, hash_a, last_doc of the lines that are among the repeated ones.

    The most common of these are broadcast, so a line that very many documents hold isn't gathered in one task; the
    others are merged with their run.
    """
    common = F.broadcast(repeated.orderBy(F.desc("n_docs"), *HASH).limit(most).select(*HASH, F.col("last_doc").alias("_last")))
    met = lines.select("doc", *HASH).join(common, HASH, "left")
    rest = met.where("_last is null").drop("_last").join(repeated.join(common, HASH, "left_anti").select(*HASH, "last_doc").hint("merge"), HASH)
    return met.where("_last is not null").select("doc", "hash_a", F.col("_last").alias("last_doc")).unionByName(rest.select("doc", "hash_a", "last_doc"))


def dedup_lines(docs: DataFrame, least: int = 40, copies: int = 5, batches: int | None = None, key: str = "doc_id", column: str = "text", names: tuple[str, str, str] = ("kept_text", "n_lines", "n_dropped")) -> DataFrame:
    """`docs` with the kept text, the number of lines and how many were dropped, under these names.

    Lines whose key has `least` code points or more and is in `copies` documents or more stay only in the
    largest doc_id that holds them. Documents meet only the hashes of their own lines to drop.
    """
    lines, repeated, store = repeated_lines(docs, least, copies, batches, key, column)
    drops = with_last(lines, repeated).where("doc <> last_doc").groupBy("doc").agg(F.collect_set("hash_a").alias("__drop"))
    drops = materialise(drops.withColumnRenamed("doc", "__doc"), "drops")
    store.clear()
    discard(lines)
    taken = docs.withColumn("__lines", F.split(F.coalesce(column, F.lit("")), "\n", -1))
    # a merge whatever the size, so that texts of a larger table don't move otherwise than those of a small one
    joined = taken.join(drops.hint("merge"), F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)) == F.col("__doc"), "left")
    dropped = lambda x: (F.length(stripped(x)) >= least) & F.array_contains("__drop", line_hash(x))
    kept = F.when(F.col("__drop").isNull(), F.col("__lines")).otherwise(F.filter("__lines", lambda x: ~dropped(x)))
    text, n_lines, n_dropped = names
    return (
        joined.withColumn("__kept", kept)
        .withColumn(n_lines, F.size("__lines").cast("long"))
        .withColumn(n_dropped, (F.size("__lines") - F.size("__kept")).cast("long"))
        .withColumn(text, F.array_join("__kept", "\n"))
        .drop("__lines", "__kept", "__doc", "__drop")
    )
