"""Tables written to the shared folder, where iterations cut their lineage."""

from __future__ import annotations

import contextlib
import itertools
import tempfile
import uuid
from collections.abc import Iterator
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Where the tables of this process lie, for as long as their frames are in use.
_WHERE: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; one of our own only where that is unset and all runs on this machine."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="voxframe-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write to a table in the shared folder and read it back: lineage ends there, and it outlives executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.mode("error").option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _WHERE[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that `written` made, when no frame that is still to be read comes from them."""
    for table in tables:
        if path := _WHERE.pop(table, None):
            remove(table.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings (dots as __) for what is run inside; what was set before comes back."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def in_ranges(df: DataFrame, order: list, parts: int | None = None) -> DataFrame:
    """The rows with the number of their range of the order as _p, kept in a table: ranges drawn anew could differ.

    Ranges rise with their numbers; equal rows of the order are in one range.
    """
    parts = parts or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return written(df.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id()), "ranges")


def before_ranges(sums: DataFrame, count: str) -> tuple[DataFrame, int]:
    """_p and _before, how much of `count` the ranges before each have; and the sum of all. A row for each range comes to the driver."""
    rows, total = [], 0
    for r in sorted(sums.select("_p", count).collect()):
        rows.append((r[0], total))
        total += int(r[1] or 0)
    return F.broadcast(sums.sparkSession.createDataFrame(rows, "_p int, _before long")), total


def dealt(df: DataFrame, cost: Column, order: list[str], each: int) -> DataFrame:
    """df in partitions of about equal cost, rows that follow each other in the order together, sorted by it.

    cost: a whole number for each row, of which a task should have `each` at most (one row may have more). There are
    as many partitions as cores at least, if there are as many rows. Adaptive execution leaves a partition of a stated number alone, however small its rows
    are; a key of many rows is split. A running sum of the cost goes by ranges, so no task sees all rows.
    """
    spark = df.sparkSession
    ranged = in_ranges(df.withColumn("_cost", cost.cast("long")), order)
    sums = sorted(ranged.groupBy("_p").agg(F.sum("_cost"), F.count(F.lit(1))).collect())  # a row for each range
    rows, total = sum(r[2] for r in sums), sum(r[1] or 0 for r in sums)
    starts = list(itertools.accumulate((r[1] or 0 for r in sums), initial=0))
    offsets = F.broadcast(spark.createDataFrame([(r[0], start) for r, start in zip(sums, starts, strict=False)], "_p int, _before long"))
    tasks = max(1, min(rows, spark.sparkContext.defaultParallelism), -(-total // each))
    earlier = F.coalesce(F.sum("_cost").over(Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = (F.col("_before") + F.col("_own") + F.col("_cost") / 2) * tasks / max(total, 1)
    placed = ranged.withColumn("_own", earlier).join(offsets, "_p").withColumn("_task", F.least(F.floor(at), F.lit(tasks - 1)).cast("int"))
    return placed.repartitionById(tasks, F.col("_task")).drop("_p", "_before", "_own", "_cost", "_task").sortWithinPartitions(*order)
