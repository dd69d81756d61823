"""Identifiers, names and parsed options as column expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import before_ranges, in_ranges


def cluster_name(label: Column) -> Column:
    return F.when(label == -1, "noise").otherwise(F.format_string("c%02d", label))


def vesicle_name(tomogram: Column, label: Column) -> Column:
    """Empty for label 0 and below."""
    return F.when(label > 0, F.format_string("%s:v%04d", tomogram, label)).otherwise("")


def numbered(df: DataFrame, prefix: str, order: list[Column], name: str = "particle_id") -> DataFrame:
    """Zero-based ids of six digits in a total order.

    The order's ranges are written once and numbered apart; each range's own count is all that is added up, so no task
    holds all rows. Equal rows of the order take their numbers in no order of their own, but each number comes once.
    """
    ranged = in_ranges(df, order)
    offsets, _ = before_ranges(ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")), "_n")
    within = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    placed = ranged.withColumn("_at", within).join(offsets, "_p")
    return placed.withColumn(name, F.format_string(f"{prefix}%06d", (F.col("_at") + F.col("_before")).cast("long"))).drop("_p", "_at", "_before")


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) == "", None).otherwise(c)


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def class_of_file(stem: Column) -> Column:
    return F.regexp_extract(stem, "^(c[0-9]+)", 1)


def safe_file_name(c: Column) -> Column:
    return F.regexp_replace(c, "[^\\w.-]", "_")


def comma_list(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")


def is_decoy(source: Column) -> Column:
    return source.startswith("decoy-")


def joined_sources(c: Column) -> Column:
    """Aggregate: the sorted distinct values joined by +."""
    return F.array_join(F.array_sort(F.collect_set(c)), "+")


def json_option(c: Column, schema: str) -> Column:
    """A struct of an option given as JSON; null where it isn't valid."""
    return F.from_json(c, schema)


def sha256(c: Column) -> Column:
    """Lowercase hex digest of a text's UTF-8 bytes or of bytes."""
    return F.sha2(c.cast("binary"), 256)


def file_signature(path: str) -> str:
    """size:mtime of a file, which changes when it is written anew."""
    import os

    s = os.stat(path)
    return f"{s.st_size}:{s.st_mtime_ns}"


def file_sha256(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as file:
        while piece := file.read(1 << 20):
            digest.update(piece)
    return digest.hexdigest()


def log_level(verbose: int, quiet: int) -> int:
    return min(4, max(0, 2 + verbose - quiet))


def stage_folder(root: str, stage: str, track: str) -> str:
    """Where a stage of the real or the decoy track keeps its results."""
    name = "decoy" if (stage, track) == ("pick", "decoy") else f"{stage}_{track}" if stage == "classify" else stage
    return f"{root.rstrip('/')}/{name}"
