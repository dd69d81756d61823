"""Argmax, ranking with gaps, balanced halves and crossings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import before_ranges, in_ranges


def best_of(df: DataFrame, by: list[str], score: str, tie: str) -> DataFrame:
    """The row of each group with the highest score, the least tie value among equals."""
    others = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.max_by(F.struct(*others), F.struct(F.col(score), -F.col(tie))).alias("_b")).select(*by, *(F.col(f"_b.{c}").alias(c) for c in others))


def rank_with_gap(df: DataFrame, by: list[str], score: str, tie: str) -> DataFrame:
    """The best row of each group and the gap of its score to the next; null if it is alone."""
    w = Window.partitionBy(*by).orderBy(F.desc(score), tie)
    return df.withColumn("_n", F.row_number().over(w)).withColumn("gap", F.col(score) - F.lead(score).over(w)).where("_n = 1").drop("_n")


def split_halves(counts: DataFrame, group: str, count: str, order: Column) -> DataFrame:
    """half_set A or B for whole groups in shuffled order: A while fewer than half of all rows came before.

    `counts` has a row for each group. Groups are written once in ranges of the order; running sums go by range, and
    the ranges' own sums, a row each, give where a range begins.
    """
    ranged = in_ranges(counts.withColumn("_o", order), ["_o", group])
    offsets, total = before_ranges(ranged.groupBy("_p").agg(F.sum(count).alias("_s")), "_s")
    w = Window.partitionBy("_p").orderBy("_o", group).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_own", F.coalesce(F.sum(count).over(w), F.lit(0))).join(offsets, "_p")
    half = F.when(F.col("_own") + F.col("_before") < (total + 1) // 2, "A").otherwise("B")
    return placed.withColumn("half_set", half).drop("_o", "_p", "_own", "_before")


def representatives(df: DataFrame, by: list[str], picker: str, xyz: list[str], tie: str) -> DataFrame:
    """For each group and picker, the member nearest the picker's own mean, the first among equals."""
    means = df.groupBy(*by, picker).agg(*(F.avg(c).alias(f"_m_{c}") for c in xyz))
    d = sum(((F.col(c) - F.col(f"_m_{c}")) * (F.col(c) - F.col(f"_m_{c}")) for c in xyz), F.lit(0.0))
    joined = df.join(means, [*by, picker]).withColumn("_d", d)
    others = [c for c in df.columns if c not in (*by, picker)]
    return joined.groupBy(*by, picker).agg(F.min_by(F.struct(*others), F.struct("_d", tie)).alias("_b")).select(*by, picker, *(F.col(f"_b.{c}").alias(c) for c in others))


def nearest_attributes(df: DataFrame, by: list[str], xyz: list[str], tie: str, carry: list[str]) -> DataFrame:
    """The group's centroid and the carried columns of the member nearest it."""
    centre = df.groupBy(*by).agg(*(F.avg(c).alias(f"centre_{c}") for c in xyz), F.count(F.lit(1)).alias("n"))
    d = sum(((F.col(c) - F.col(f"centre_{c}")) * (F.col(c) - F.col(f"centre_{c}")) for c in xyz), F.lit(0.0))
    joined = df.join(centre, by).withColumn("_d", d)
    kept = [f"centre_{c}" for c in xyz]
    return joined.groupBy(*by, *kept, "n").agg(F.min_by(F.struct(*carry), F.struct("_d", tie)).alias("_b")).select(*by, *kept, "n", *(F.col(f"_b.{c}").alias(c) for c in carry))


def ranked(df: DataFrame, by: list[str], score: str, tie: str, most: int) -> DataFrame:
    """The `most` rows of each group with the highest scores, with their rank."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), tie)).cast("long")).where(F.col("rank") <= most)


def crossing(df: DataFrame, by: list[str], shell: str, value: str, threshold: float) -> DataFrame:
    """First shell below the threshold; the last one where none is, or where shell 0 already is (then it isn't crossed)."""
    found = F.min(F.when(F.col(value) < threshold, F.col(shell)))
    at = F.when(found > 0, found)
    return df.groupBy(*by).agg(F.coalesce(at, F.max(shell)).alias("crossing"), at.isNotNull().alias("crossed"))


def lowest_pool(df: DataFrame, by: list[str], score: str, tie: str, target: int | str, key: Column) -> DataFrame:
    """Of the 5 * target lowest-scoring rows of each group, `target` in the order of a hash.

    target: a number, or the column that has each group's own. A group with fewer rows than its target gives them all.
    """
    w, wanted = Window.partitionBy(*by), F.col(target) if isinstance(target, str) else F.lit(target)
    pool = df.withColumn("_r", F.row_number().over(w.orderBy(score, tie))).where(F.col("_r") <= 5 * wanted)
    return pool.withColumn("_k", F.row_number().over(w.orderBy(key, tie))).where(F.col("_k") <= wanted).drop("_r", "_k")
