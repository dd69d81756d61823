"""Orientation and angle functions as column expressions. Quaternions are structs (w, x, y, z), vectors three columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def quaternion(w, x, y, z) -> Column:
    return F.struct(*(v.cast("double").alias(n) for v, n in zip((w, x, y, z), "wxyz", strict=True)))


def quaternion_from_normal(nx: Column, ny: Column, nz: Column) -> Column:
    """The rotation that takes +z to the vector; identity for a zero vector, half a turn about x for -z."""
    norm = F.sqrt(nx * nx + ny * ny + nz * nz)
    x, y, z = nx / norm, ny / norm, nz / norm
    length = F.sqrt((1 + z) * (1 + z) + x * x + y * y)
    one, zero = F.lit(1.0), F.lit(0.0)
    return (
        F.when(norm == 0, quaternion(one, zero, zero, zero))
        .when(z < -1 + 1e-8, quaternion(zero, one, zero, zero))
        .otherwise(quaternion((1 + z) / length, -y / length, x / length, zero))
    )


def roll_about_normal(q: Column, degrees: Column) -> Column:
    """q followed on its right by a turn about z, normalised."""
    c, s = F.cos(F.radians(degrees) / 2), F.sin(F.radians(degrees) / 2)
    w, x, y, z = q["w"] * c - q["z"] * s, q["x"] * c + q["y"] * s, q["y"] * c - q["x"] * s, q["z"] * c + q["w"] * s
    n = F.sqrt(w * w + x * x + y * y + z * z)
    return quaternion(w / n, x / n, y / n, z / n)


def rotation_rows(q: Column) -> Column:
    """The 3 x 3 rotation matrix as an array of nine numbers, row by row."""
    w, x, y, z = q["w"], q["x"], q["y"], q["z"]
    return F.array(
        1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
        2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
        2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
    )


def tilt_psi(q: Column) -> Column:
    """struct(tilt, psi) in degrees of the rotated z axis; zeros for null."""
    nx, ny, nz = 2 * (q["x"] * q["z"] + q["y"] * q["w"]), 2 * (q["y"] * q["z"] - q["x"] * q["w"]), 1 - 2 * (q["x"] * q["x"] + q["y"] * q["y"])
    tilt = F.degrees(F.acos(F.least(F.greatest(nz, F.lit(-1.0)), F.lit(1.0))))
    return F.struct(F.when(nz.isNotNull(), tilt).otherwise(0.0).alias("tilt"), F.coalesce(F.degrees(F.atan2(ny, nx)), F.lit(0.0)).alias("psi"))


def beam_angle(nx: Column, ny: Column, nz: Column) -> Column:
    """Degrees between the vector and the plane across the beam; an error for a zero vector."""
    norm = F.sqrt(nx * nx + ny * ny + nz * nz)
    angle = F.degrees(F.asin(F.least(F.greatest(F.abs(nz) / norm, F.lit(0.0)), F.lit(1.0))))
    return F.when(norm == 0, F.raise_error(F.lit("a zero vector has no direction")).cast("double")).otherwise(angle)


def order_statistic_offset(k: int) -> float:
    """What the largest of k unit normal scores exceeds one by: 0 for one, sqrt(2 ln k) beyond."""
    if k < 1:
        raise ValueError("at least one score is needed")
    return math.sqrt(2 * math.log(k)) if k > 1 else 0.0


def effective_threshold(n_mad: float, windows: int) -> float:
    return n_mad + order_statistic_offset(windows)


def to_voxels(angstrom: Column | float, voxel_size: Column | float):
    return angstrom / voxel_size


def box_voxels(box_angstrom: float, voxel_size: float) -> int:
    """Rounded half to even, made odd."""
    n = round(box_angstrom / voxel_size)
    return n + (n % 2 == 0)


def reversed_axes(position: Column) -> Column:
    """(z, y, x) of (x, y, z) and back."""
    return F.struct(position["z"].alias("x"), position["y"].alias("y"), position["x"].alias("z"))


def largest_offset(windows: list[tuple[float, float]]) -> float:
    return max(high for _, high in windows)


def decoys_wanted(n: Column, ratio: float = 1.0) -> Column:
    """Decoys for n real picks: their number times the ratio, rounded half to even, one at least."""
    return F.greatest(F.lit(1), F.bround(n * F.lit(float(ratio))).cast("long"))
