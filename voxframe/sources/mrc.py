"""MRC volumes as a Spark data source.

`spark.read.format("mrc").load(folder)` gives a row for each file, or for each slab of z planes with option slab; the voxels
are only read if `voxels` is "true" (the default) and a slab is a partition of its own, so large volumes don't
travel whole. Columns: path, stem, nz, ny, nx, mode, voxel_x, voxel_y, voxel_z, z0, dz, data (float32 bytes, or null).
Writing takes rows (stem, nz, ny, nx, voxel_x, data), one file each.
"""

from __future__ import annotations

import os
import struct
import uuid
import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

# The format's number types by mode, and its header length.
MODES = {0: "i1", 1: "i2", 2: "f4", 6: "u2", 12: "f2"}
HEADER = 1024
SCHEMA = "path string, stem string, nz int, ny int, nx int, mode int, voxel_x double, voxel_y double, voxel_z double, z0 int, dz int, data binary"


@dataclass
class Header:
    nx: int
    ny: int
    nz: int
    mode: int
    voxel: tuple[float, float, float]
    extended: int
    order: str

    @property
    def dtype(self) -> np.dtype:
        return np.dtype(self.order + MODES[self.mode])

    @property
    def start(self) -> int:
        return HEADER + self.extended


def read_header(path: str) -> Header:
    try:
        with open(path, "rb") as file:
            raw = file.read(HEADER)
    except OSError as e:
        raise ValueError(f"{path}: {e}") from e
    if len(raw) < HEADER:
        raise ValueError(f"{path}: the header is cut short")
    for order in "<>":
        nx, ny, nz, mode = struct.unpack_from(f"{order}4i", raw, 0)
        if mode in MODES and min(nx, ny, nz) > 0 and max(nx, ny, nz) < 1 << 20:
            break
    else:
        raise ValueError(f"{path}: not a readable volume")
    mx = struct.unpack_from(f"{order}3i", raw, 28)
    cell = struct.unpack_from(f"{order}3f", raw, 40)
    voxel = tuple(c / m if m else 0.0 for c, m in zip(cell, mx, strict=True))
    return Header(nx, ny, nz, mode, voxel, struct.unpack_from(f"{order}i", raw, 92)[0], order)


def read_volume(path: str, z0: int = 0, dz: int | None = None) -> np.ndarray:
    """Planes z0 to z0 + dz as float32, axes (z, y, x)."""
    h = read_header(path)
    dz = h.nz - z0 if dz is None else dz
    plane = h.nx * h.ny * h.dtype.itemsize
    with open(path, "rb") as file:
        file.seek(h.start + z0 * plane)
        data = np.frombuffer(file.read(dz * plane), dtype=h.dtype)
    if data.size != dz * h.nx * h.ny:
        raise ValueError(f"{path}: the data are cut short")
    return data.reshape(dz, h.ny, h.nx).astype(np.float32)


def write_volume(path: str, volume: np.ndarray, voxel: float = 1.0) -> None:
    """A float32 file, put in place whole."""
    nz, ny, nx = volume.shape
    raw = bytearray(HEADER)
    struct.pack_into("<4i", raw, 0, nx, ny, nz, 2)
    struct.pack_into("<3i", raw, 28, nx, ny, nz)
    struct.pack_into("<6f", raw, 40, nx * voxel, ny * voxel, nz * voxel, 90, 90, 90)
    struct.pack_into("<3i", raw, 64, 1, 2, 3)
    v = volume.astype("<f4")
    struct.pack_into("<3f", raw, 76, v.min(), v.max(), v.mean())
    struct.pack_into("<i", raw, 108, 20140)
    raw[208:212], raw[212:216] = b"MAP ", b"\x44\x44\0\0"
    struct.pack_into("<f", raw, 216, float(v.std()))
    part = f"{path}.{uuid.uuid4().hex}"
    try:
        with open(part, "wb") as file:
            file.write(raw)
            file.write(v.tobytes())
        os.replace(part, path)
    except OSError as e:
        raise ValueError(f"{path}: {e}") from e


@dataclass
class Slab(InputPartition):
    path: str
    z0: int
    dz: int


class MrcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.where = options["path"].removeprefix("file://").removeprefix("file:")
        self.slab = int(options.get("slab", 0))
        self.voxels = options.get("voxels", "true").lower() == "true"

    def partitions(self) -> list[Slab]:
        out = []
        for path in list_volumes(self.where):
            nz = read_header(path).nz
            step = self.slab or nz
            out += [Slab(path, z, min(step, nz - z)) for z in range(0, nz, step)]
        return out

    def read(self, part: Slab) -> Iterator[tuple]:
        h = read_header(part.path)
        data = read_volume(part.path, part.z0, part.dz).tobytes() if self.voxels else None
        yield part.path, Path(part.path).stem, h.nz, h.ny, h.nx, h.mode, *h.voxel, part.z0, part.dz, data


class MrcWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.where = options["path"].removeprefix("file://").removeprefix("file:")

    def write(self, rows) -> WriterCommitMessage:
        os.makedirs(self.where, exist_ok=True)
        for r in rows:
            write_volume(f"{self.where}/{r.stem}.mrc", np.frombuffer(r.data, "<f4").reshape(r.nz, r.ny, r.nx), r.voxel_x)
        return WriterCommitMessage()


class MrcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mrc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MrcReader:
        return MrcReader(self.options)

    def writer(self, schema, overwrite: bool) -> MrcWriter:
        return MrcWriter(self.options)


def list_volumes(where: str) -> list[str]:
    """Sorted *.mrc of a folder, or the file itself."""
    path = Path(where)
    if path.is_file():
        return [str(path)]
    if not path.is_dir() or not os.access(path, os.R_OK):
        raise ValueError(f"{where} isn't a readable folder")
    return sorted(str(p) for p in path.glob("*.mrc"))


def volumes(spark: SparkSession, where: str, voxels: bool = True, slab: int = 0) -> DataFrame:
    spark.dataSource.register(MrcSource)
    return spark.read.format("mrc").option("voxels", str(voxels).lower()).option("slab", slab).load(where)


def voxel_size(x: Column, y: Column, z: Column) -> Column:
    """x where all three are positive; null otherwise."""
    return F.when(F.least(x, y, z) > 0, x)


def non_cubic(x: Column, y: Column, z: Column) -> Column:
    """Whether a header's three sizes differ by a thousandth or more; the first one is used all the same."""
    return (F.least(x, y, z) > 0) & (F.greatest(x, y, z) - F.least(x, y, z) >= 1e-3)


def manifests(spark: SparkSession, segmentations: str, tomograms: str, voxel: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Matched manifests and the segmentations without a tomogram; the voxel size given, or the headers' most frequent."""
    from ..operators.aggregates import modal_value
    from ..operators.joins import longest_prefix

    seg = volumes(spark, segmentations, voxels=False).select(F.col("stem").alias("tomogram_id"), F.col("path").alias("segmentation_path"))
    raw = volumes(spark, tomograms, voxels=False)
    names = raw.select(F.col("stem").alias("raw_stem"), F.col("path").alias("raw_tomogram_path"))
    both = longest_prefix(seg, "tomogram_id", names, "raw_stem")
    if voxel is None:
        odd = raw.where(non_cubic(F.col("voxel_x"), F.col("voxel_y"), F.col("voxel_z"))).select("path").limit(1).collect()
        if odd:
            warnings.warn(f"{odd[0].path}: voxels aren't cubes, their first side is used", stacklevel=2)
        sizes = modal_value(raw, voxel_size(F.col("voxel_x"), F.col("voxel_y"), F.col("voxel_z")), F.col("path"))
        both = both.crossJoin(F.broadcast(sizes.select(F.col("value").alias("voxel_size_angstrom"))))
    else:
        both = both.withColumn("voxel_size_angstrom", F.lit(float(voxel)))
    out = both.withColumn("is_decoy", F.lit(False)).drop("raw_stem")
    return out.where("raw_tomogram_path is not null"), out.where("raw_tomogram_path is null").select("tomogram_id", "segmentation_path")
