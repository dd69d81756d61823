"""Predicates on positions, scores, angles and rows."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def inside_margin(position: list[Column], shape: list[Column | int], margin: Column | float) -> Column:
    """All axes at least margin from both faces, inclusive."""
    out = F.lit(True)
    for p, n in zip(position, shape, strict=True):
        out &= p.between(margin if isinstance(margin, Column) else F.lit(margin), (n if isinstance(n, Column) else F.lit(n)) - 1 - margin)
    return out


def box_fits(position: list[Column], extent: list[float], box: int) -> Column:
    """A box turned any way stays inside."""
    r = (box - 1) / 2 * math.sqrt(3)
    out = F.lit(True)
    for p, n in zip(position, extent, strict=True):
        out &= p.between(r, n - r)
    return out


def accepted(score: Column, threshold: float) -> Column:
    return score >= threshold


def in_slab(z: Column, centre: float, thickness: float) -> Column:
    return F.abs(z - centre) <= thickness


def under_angle(angle: Column, most: float) -> Column:
    return angle.isNull() | (angle <= most)


def not_degenerate(feature: Column) -> Column:
    return F.exists(feature, lambda x: x != 0)


def kept_and_skipped(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """Both sides of a guard; a null counts as skipped."""
    marked = df.withColumn("_keep", F.coalesce(keep, F.lit(False)))
    return marked.where("_keep").drop("_keep"), marked.where("not _keep").drop("_keep")


def in_polygon(x: Column, y: Column, corners: list[tuple[float, float]]) -> Column:
    """Even-odd rule over the polygon's edges."""
    inside = F.lit(False)
    for (x0, y0), (x1, y1) in zip(corners, corners[1:] + corners[:1], strict=True):
        if y0 == y1:
            continue
        crosses = ((F.lit(y0) > y) != (F.lit(y1) > y)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
        inside = inside != crosses
    return inside


def atom_records(line: Column) -> Column:
    return line.startswith("ATOM  ") | line.startswith("HETATM")


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """df, after a check that no row breaks the condition."""
    if df.where(~F.coalesce(condition, F.lit(False))).limit(1).count():
        raise ValueError(message)
    return df


def is_pure(df: DataFrame, flag: Column) -> DataFrame:
    """One row: n_flags, pure (exactly one distinct value)."""
    return df.agg(F.countDistinct(flag).alias("n_flags")).withColumn("pure", F.col("n_flags") == 1)


def single_half(df: DataFrame, half: str = "half_set") -> DataFrame:
    """df, after a check that all its rows are of one half and that there are some."""
    if df.select(half).distinct().limit(2).count() != 1:
        raise ValueError("the rows must be of exactly one half")
    return df


def comparable(real: DataFrame, decoy: DataFrame, least_share: float = 0.5) -> DataFrame:
    """One row: real_count, decoy_count and whether there are enough decoys."""
    counts = real.agg(F.count(F.lit(1)).alias("real_count")).crossJoin(decoy.agg(F.count(F.lit(1)).alias("decoy_count")))
    return counts.withColumn("enough", F.col("decoy_count") >= least_share * F.col("real_count"))


def unknown(ids: DataFrame, known: DataFrame) -> DataFrame:
    """Ids (one column, each once) that are not among the known ones."""
    return ids.distinct().exceptAll(known.distinct().intersect(ids))


def concatenated(sources: dict[str, DataFrame]) -> DataFrame:
    """The rows of all sources, with the source's name."""
    return functools.reduce(DataFrame.unionByName, (df.withColumn("source", F.lit(name)) for name, df in sources.items()))


def select_tomograms(df: DataFrame, ids: list[str] | None = None, sample: int | None = None, seed: int = 0) -> DataFrame:
    """Rows of the named tomograms (a missing one is an error), of a seeded sample of them, or all."""
    import random

    known = sorted(r[0] for r in df.select("tomogram_id").distinct().collect())
    if ids is not None:
        if missing := sorted(set(ids) - set(known)):
            raise ValueError(f"unknown tomograms: {', '.join(missing)}")
        return df.where(F.col("tomogram_id").isin(ids))
    return df if sample is None else df.where(F.col("tomogram_id").isin(random.Random(seed).sample(known, min(sample, len(known)))))
