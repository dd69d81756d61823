"""Scratch tables, bounded draws of labelled rows and small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import written

materialise = written

#: Rows that a function of an Arrow batch gets at once. Texts are long, and what is made of them is longer.
BATCH_ROWS = 500


def mapped(df: DataFrame, function, schema) -> DataFrame:
    """df.mapInArrow with at most BATCH_ROWS rows at once.

    Spark bounds a batch by its bytes (spark.sql.execution.arrow.maxBytesPerBatch); slices of it, which copy nothing,
    bound what the function makes of them.
    """

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return function(batch.slice(at, BATCH_ROWS) for batch in batches for at in range(0, batch.num_rows, BATCH_ROWS))

    return df.mapInArrow(sliced, schema)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def if_small(ids: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Marked for broadcast if it has `most` rows (of a few numbers each) at most; else Spark shuffles it."""
    return F.broadcast(ids) if ids.limit(most + 1).count() <= most else ids


def unit_hash(column: Column, salt: str) -> Column:
    """A number in [0, 1) that depends on the value and the salt alone."""
    return F.pmod(F.xxhash64(F.lit(salt), column), F.lit(1 << 30)) / F.lit(float(1 << 30))


def draw(df: DataFrame, label: str, key: str, per_label: int, salt: str) -> DataFrame:
    """About per_label rows of each label value (all, where there are fewer), picked by the key's hash.

    The labels' counts, a row for each label value, are the only thing gathered before; so the draw needs
    no shuffle of the rows and no window over a hot label.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    chance = F.lit(0.0)
    for value, n in sorted(counts.items(), key=lambda x: str(x[0])):
        if value is not None:
            chance = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, per_label / n))).otherwise(chance)
    return df.where(unit_hash(F.col(key), salt) < chance)


def crc_of_id(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
