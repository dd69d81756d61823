"""Negative-control picks: from rejected surface points, shifted picks, and synthetic noise."""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import decoys_wanted
from ..functions.text import numbered
from ..kernels import volume as V
from ..scratch import written
from .filters import comparable
from .joins import far_from, nearest
from .windows import lowest_pool, split_halves

POINT = "tomogram_id string, x double, y double, z double, nx double, ny double, nz double"


def hashed(seed: int, *of: Column, part: int = 0) -> Column:
    """A number from 0 to below 1 by the md5 of seed and values as text; part 0 to 3 gives four that don't depend on each other."""
    text = F.md5(F.concat_ws(":", F.lit(str(seed)), *(c.cast("string") for c in of)).cast("binary"))
    return F.conv(F.substring(text, 1 + 8 * part, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def from_rejected(scored: DataFrame, real: DataFrame, threshold: float, distance: float, target: int | None = None, ratio: float = 1.0, seed: int = 0) -> DataFrame:
    """Points under the threshold, far from real picks: of each tomogram's 5 * n lowest, n by a seeded hash.

    n is the target, or else the tomogram's own number of real picks times the ratio, one at least; so a tomogram without
    picks gives one. scored: tomogram_id, idx, x, y, z, score, ...; each tomogram is drawn for itself, so it parallelises.
    """
    under = scored.where(F.col("score") < threshold)
    apart = far_from(under, real, ["x", "y", "z"], distance, ["tomogram_id"])
    if target is None:
        wanted = real.groupBy(F.col("tomogram_id").alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
        apart = apart.join(wanted, F.col("tomogram_id").eqNullSafe(F.col("_t")), "left").withColumn("_wanted", decoys_wanted(F.coalesce("_n", F.lit(0)), ratio)).drop("_t", "_n")
    return lowest_pool(apart, ["tomogram_id"], "score", "idx", "_wanted" if target is None else target, hashed(seed, F.col("tomogram_id"), F.col("idx"))).select(*scored.columns)


#: Places that are tried together for each pick that has none yet; the rounds' sum is the number of tries.
ROUNDS = (8, 32, 160)


def shifted(picks: DataFrame, surfaces: DataFrame, shapes: DataFrame, key: str, least: float, most: float, from_surface: float, from_picks: float, seed: int = 0, rounds: tuple[int, ...] = ROUNDS) -> DataFrame:
    """Each pick moved to the first of some random places that is inside, off the surface and off all picks; else dropped.

    Places come from hashes of seed, key and the try's number. In each round the picks that have no place yet try several at
    once; anti-joins by grid cells leave those that are good. The orientation is the nearest surface normal. picks: tomogram_id, key, x, y, z;
    surfaces: tomogram_id, x, y, z, nx, ny, nz; shapes: tomogram_id, nz, ny, nx. Tomograms without a surface or
    a shape give none. Gives tomogram_id, key, x, y, z, nx, ny, nz.
    """
    xyz = ["x", "y", "z"]
    by = surfaces.select("tomogram_id").distinct()
    rest = picks.select("tomogram_id", key, *xyz).join(by, "tomogram_id", "left_semi").join(shapes.select("tomogram_id", "nz", "ny", "nx"), "tomogram_id")
    rest, found, tried, tasks = written(rest, "open"), None, 0, 4 * picks.sparkSession.sparkContext.defaultParallelism
    for n in rounds:
        # dealt before they get many, and each hash made once
        draw = lambda t: F.struct(t.alias("_try"), *(hashed(seed, F.col(key), t, part=k).alias(f"_u{k}") for k in range(3)))
        tries = F.transform(F.sequence(F.lit(tried), F.lit(tried + n - 1)), draw)
        at = rest.repartition(tasks, "tomogram_id", key).withColumn("_t", F.explode(tries)).select("*", "_t.*").drop("_t")
        tried += n
        u = [F.col(f"_u{k}") for k in range(3)]
        rise, turn, length = 2 * u[0] - 1, 2 * math.pi * u[1], least + (most - least) * u[2]
        flat = F.sqrt(1 - rise * rise) * length
        place = [F.col("x") + flat * F.cos(turn), F.col("y") + flat * F.sin(turn), F.col("z") + rise * length]
        tries = at.select("tomogram_id", key, "_try", "nz", "ny", "nx", *(p.alias(c) for p, c in zip(place, xyz, strict=True)))
        inside = tries.where(functools.reduce(Column.__and__, ((F.col(c) >= 0) & (F.col(c) <= F.col(f"n{c}") - 1) for c in xyz))).drop("nz", "ny", "nx")
        good = far_from(far_from(inside, picks, xyz, from_picks, ["tomogram_id"]), surfaces, xyz, from_surface, ["tomogram_id"])
        first = written(good.groupBy("tomogram_id", key).agg(F.min_by(F.struct(*xyz), "_try").alias("_p")).select("tomogram_id", key, "_p.*"), "places")
        found = first if found is None else found.unionByName(first)
        rest = written(rest.join(first.select("tomogram_id", key), ["tomogram_id", key], "left_anti"), "open")
        if not rest.limit(1).count():
            break
    normals = ["nx", "ny", "nz"]
    near = nearest(found, surfaces.select("tomogram_id", *xyz, *normals), key, xyz, normals, most + from_surface, ["tomogram_id"])
    return near.select("tomogram_id", key, *xyz, *(F.col(f"nearest_{c}").alias(c) for c in normals))


def noise_volume(index: int, shape: tuple[int, int, int], sign: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Normal noise with a brighter or darker shell of a third of the least side, and the shell's mask."""
    rng = np.random.default_rng([seed, index])
    grid = np.indices(shape) - (np.array(shape) - 1)[:, None, None, None] / 2
    shell = np.abs(np.sqrt((grid**2).sum(axis=0)) - min(shape) / 3) <= 1.5
    return (rng.normal(size=shape) + 2 * sign * shell).astype(np.float32), shell


def synthetic(spark: SparkSession, count: int, picks_each: int, shape: tuple[int, int, int], sign: float = -1.0, seed: int = 0) -> DataFrame:
    """Points on the shells of `count` noise volumes, with radial normals."""
    if not count:
        raise ValueError("the number of noise volumes is needed")

    def points(batches):
        for rows in batches:
            out = []
            for i in rows["id"]:
                _, shell = noise_volume(int(i), shape, sign, seed)
                at = np.argwhere(shell)
                pick = at[np.random.default_rng([seed, int(i), 1]).choice(len(at), min(picks_each, len(at)), replace=False)][:, ::-1]
                way = pick - (np.array(shape[::-1]) - 1) / 2
                way = way / np.maximum(np.linalg.norm(way, axis=1, keepdims=True), 1e-12)
                out += [(f"decoy-noise-{int(i):03d}", *p, *w) for p, w in zip(pick.astype(float), way, strict=True)]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in POINT.split(", ")])

    return spark.range(count).mapInPandas(points, POINT)


def noise_manifests(spark: SparkSession, count: int, shape: tuple[int, int, int], folder: str, voxel: float, sign: float = -1.0, seed: int = 0) -> DataFrame:
    """The noise volumes and their shells as files, and their manifests; one task writes a volume."""
    import os

    from ..sources import mrc

    form = "tomogram_id string, segmentation_path string, raw_tomogram_path string, voxel_size_angstrom double, is_decoy boolean"

    def put(batches):
        os.makedirs(folder, exist_ok=True)
        for rows in batches:
            out = []
            for i in rows["id"]:
                volume, shell = noise_volume(int(i), shape, sign, seed)
                name = f"decoy-noise-{int(i):03d}"
                paths = [f"{folder}/{name}_{kind}.mrc" for kind in ("seg", "raw")]
                for path, v in zip(paths, (shell.astype(np.float32), volume), strict=True):
                    mrc.write_volume(path, v, voxel)
                out.append((name, *paths, voxel, True))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in form.split(", ")])

    return spark.range(count).mapInPandas(put, form)


def finalised(points: DataFrame, method: str, seed: int = 0) -> DataFrame:
    """Ids, the picker decoy-<method>, and halves by whole tomograms."""
    ids = numbered(points.withColumn("source_picker", F.lit(f"decoy-{method}")), "decoy-", [F.col(c) for c in ("tomogram_id", "x", "y", "z")])
    counts = ids.groupBy("tomogram_id").agg(F.count(F.lit(1)).alias("n"))
    halves = split_halves(counts, "tomogram_id", "n", F.md5(F.concat(F.lit(f"{seed}:"), "tomogram_id").cast("binary")))
    return ids.join(halves.select("tomogram_id", "half_set"), "tomogram_id")


def checked(real: DataFrame, decoys: DataFrame) -> DataFrame:
    """decoys, if all are decoys, no real pick is one, and there are half as many at least."""
    flag = F.col("source_picker").startswith("decoy-")
    if real.where(flag).limit(1).count() or decoys.where(~flag).limit(1).count():
        raise ValueError("real picks and decoys are mixed")
    if not comparable(real, decoys).first().enough:
        raise ValueError("there are too few decoys to compare with")
    return decoys


def surface_points(volumes: DataFrame, spacing: float = 1.0) -> DataFrame:
    """tomogram_id, idx, x, y, z, nx, ny, nz of each segmentation (tomogram_id, nz, ny, nx, data); empty ones give none."""

    def extract(batches):
        for rows in batches:
            for r in rows.itertuples():
                try:
                    p, n = V.surface(np.frombuffer(r.data, "<f4").reshape(r.nz, r.ny, r.nx))
                except ValueError:
                    continue
                cell = np.floor(p / spacing).astype(int)
                _, first = np.unique(cell, axis=0, return_index=True)
                first = np.sort(first)
                p, n = p[first], n[first]
                yield pd.DataFrame({"tomogram_id": r.tomogram_id, "idx": np.arange(len(p)), "x": p[:, 2], "y": p[:, 1], "z": p[:, 0], "nx": n[:, 2], "ny": n[:, 1], "nz": n[:, 0]})

    return volumes.mapInPandas(extract, "tomogram_id string, idx long, x double, y double, z double, nx double, ny double, nz double")
