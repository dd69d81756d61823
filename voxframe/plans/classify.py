"""Particles to classes: subvolumes, features, clusters, alignment and averages."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cluster_name
from ..kernels import signal as S
from ..kernels import volume as V
from ..operators.aggregates import elementwise_mean, moments, whole_moments
from ..operators.filters import box_fits, kept_and_skipped, single_half
from ..operators.grouping import centroids, cluster, match_halves, reduce
from ..operators.joins import remapped, with_paths
from ..scratch import dealt, written
from ..sources import mrc
from . import slabs

BOXES = "particle_id string, tomogram_id string, half_set string, vesicle_id string, kept boolean, data binary"


#: Boxes that a task cuts.
BOXES_EACH = 1000


def extract(particles: DataFrame, manifests: DataFrame, box: int, subtract: bool = False, each: int = BOXES_EACH) -> DataFrame:
    """Oriented boxes of each particle (float32 bytes, axes x, y, z); what can't be cut has kept = false.

    Particles that follow each other in z go to a task together, `each` at most, so a tomogram with very many is cut by several; a task
    reads the planes around its own.
    """
    slim = particles.select("particle_id", "tomogram_id", "half_set", "vesicle_id", "x", "y", "z", "orientation")
    volumes = written(slabs.shaped(manifests), "shapes")
    fits = box_fits([F.col(c) for c in "xyz"], [F.col(c) for c in ("nx", "ny", "nz")], box) & F.col("orientation").isNotNull()
    inside, skipped = kept_and_skipped(with_paths(slim, volumes), fits)
    background = slabs.background_medians(slabs.in_slabs(volumes)) if subtract else volumes.select("tomogram_id", F.lit(None).cast("double").alias("background"))
    ready = inside.join(background, "tomogram_id", "left")

    def cut(batches):
        for batch in batches:
            out = []
            for _, own in batch.groupby(["tomogram_id", batch["z"] // PLANES]):
                r, around = own.iloc[0], int(np.ceil((box - 1) / 2 * np.sqrt(3))) + 2
                start = max(0, int(own["z"].min()) - around)
                n = min(r.nz, int(own["z"].max()) + around + 1) - start
                volume = mrc.read_volume(r.raw_tomogram_path, start, n)
                if r.background == r.background and r.background is not None:
                    volume[mrc.read_volume(r.segmentation_path, start, n) > 0] = np.float32(r.background)
                for p in own.itertuples():
                    q = p.orientation
                    q = np.array([q[k] for k in "wxyz"] if isinstance(q, dict) else [q.w, q.x, q.y, q.z])
                    data = V.extract_box(volume, np.array([p.x, p.y, p.z]), q, box, start).tobytes()
                    out.append((p.particle_id, p.tomogram_id, p.half_set, p.vesicle_id, True, data))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in BOXES.split(", ")])

    boxes = dealt(ready, F.lit(1), ["tomogram_id", "z", "particle_id"], each).mapInPandas(cut, BOXES)
    empty = skipped.select("particle_id", "tomogram_id", "half_set", "vesicle_id", F.lit(False).alias("kept"), F.lit(None).cast("binary").alias("data"))
    return boxes.unionByName(empty)


#: Planes that are read at once, besides those around a box.
PLANES = 64


#: How the further modes are made comparable: by the particle's own power, within its tomogram, both, or over all alone.
NORMALISATIONS = ("none", "particle", "tomogram", "both")


def raw_features(boxes: DataFrame, box: int, normalisation: str = "both", **options) -> DataFrame:
    """particle_id, half_set, tomogram_id, features as they are, mark (a hash of the box), of the boxes that aren't cut off."""
    if normalisation not in NORMALISATIONS:
        raise ValueError(f"unknown normalisation {normalisation}")

    def compute(batches):
        for rows in batches:
            f = [S.features(np.frombuffer(d, np.float32).reshape((box,) * 3).astype(float), power=normalisation in ("particle", "both"), **options).tolist() for d in rows["data"]]
            yield rows[["particle_id", "half_set", "tomogram_id", "mark"]].assign(features=f)[["particle_id", "half_set", "tomogram_id", "features", "mark"]]

    return boxes.where("kept").withColumn("mark", F.xxhash64("data")).mapInPandas(compute, "particle_id string, half_set string, tomogram_id string, features array<double>, mark long")


def feature_rows(boxes: DataFrame | None, box: int, normalisation: str = "both", least: int = 50, raw: DataFrame | None = None, **options) -> DataFrame:
    """particle_id, half_set, tomogram_id, features; boxes that are empty or cut off are left out.

    The columns of the further modes are standardised over all particles that aren't cut off, empty ones with their zeros,
    and then, for "tomogram" and "both", within each tomogram of `least` or more; for "particle" and "both", each particle's further modes have unit length before. Tasks add up their own rows' sums, so two rows of
    statistics a task and tomogram are all that moves.
    raw: what raw_features gave, if it is there.
    """
    raw = (written(raw_features(boxes, box, normalisation, **options), "features") if raw is None else raw).select("particle_id", "half_set", "tomogram_id", "features")
    flat = S.mode_zero_width(box, **options)
    return standardised(raw, flat, normalisation in ("tomogram", "both"), least).where(F.exists("features", lambda x: x != 0))


def standardised(raw: DataFrame, flat: int, by_tomogram: bool = True, least: int = 50) -> DataFrame:
    """raw with the features from place `flat` on as z-scores; constant columns give zeros, rows of zeros stay."""
    if not raw.where(F.size("features") > flat).limit(1).count():
        return raw

    own = written(moments(raw.withColumn("features", F.slice("features", flat + 1, F.size("features"))), "tomogram_id", "features"), "moments")
    whole = whole_moments(own, "tomogram_id")
    n, mean, q = whole
    spread = np.sqrt(q / n)
    spread[spread == 0] = 1.0

    def scale(batches):
        for rows in batches:
            out = []
            for f, k, m, s in rows[["features", "_n", "_m", "_q"]].itertuples(index=False):
                f = np.array(f, float)
                if f.any():
                    z = (f[flat:] - mean) / spread
                    if m is not None:
                        # of the tomogram's z-scores
                        about, wide = (np.array(m) - mean) / spread, np.sqrt(np.array(s) / k) / spread
                        z = (z - about) / np.where(wide == 0, 1.0, wide)
                    f = np.concatenate([f[:flat], z])
                out.append(f.tolist())
            yield rows.drop(columns=["_n", "_m", "_q"]).assign(features=out)

    large = own.where(F.lit(by_tomogram) & (F.col("n") >= least)).select(F.col("tomogram_id").alias("_t"), F.col("n").alias("_n"), F.col("m").alias("_m"), F.col("q").alias("_q"))
    joined = raw.join(large, F.col("tomogram_id").eqNullSafe(F.col("_t")), "left").select(*raw.columns, F.coalesce("_n", F.lit(0)).alias("_n"), "_m", "_q")
    return joined.mapInPandas(scale, raw.schema)


def assign(features: DataFrame, method: str = "kmeans", k: int = 8, least_size: int = 10, components: int = 10, strict: bool = False, seed: int = 0) -> DataFrame:
    """particle_id, cluster_id. Strict: each half for itself in common components, B's classes renamed to the A ones they match;
    a class of B that has no match gets a number that A doesn't use."""
    reduced = written(reduce(features, "particle_id", "features", components).join(features.select("particle_id", "half_set"), "particle_id"), "reduced")
    if not strict:
        return cluster(reduced, "particle_id", "scores", method, None, k, least_size, seed).select("particle_id", cluster_name(F.col("label")).alias("cluster_id"))
    if {r[0] for r in reduced.select("half_set").distinct().collect()} != {"A", "B"}:
        raise ValueError("both halves need particles")
    labels = written(cluster(reduced, "particle_id", "scores", method, "half_set", k, least_size, seed).join(reduced.select("particle_id", "half_set"), "particle_id"), "labels")
    means = [centroids(single_half(reduced.where(F.col("half_set") == h)), labels.select("particle_id", "label"), "particle_id", "scores").withColumn("half", F.lit(i)) for i, h in enumerate("AB")]
    both = means[0].unionByName(means[1])
    mapping = match_halves(both, "half", "label")
    used = {r[0] for r in labels.where("half_set = 'A'").select("label").distinct().collect()}
    matched = {r.label_b for r in mapping.collect()}
    free = (n for n in range(1 << 30) if n not in used)
    extra = [(r[0], next(free)) for r in labels.where("half_set = 'B' and label >= 0").select("label").distinct().orderBy("label").collect() if r[0] not in matched]
    if extra:
        mapping = mapping.unionByName(labels.sparkSession.createDataFrame(extra, "label_b int, label_a int"))
    b = remapped(labels.where("half_set = 'B'").select("particle_id", F.col("label").alias("label_b")), mapping).select("particle_id", "label")
    out = labels.where("half_set = 'A'").select("particle_id", "label").unionByName(b)
    return out.select("particle_id", cluster_name(F.col("label")).alias("cluster_id"))


def inplane_angles(boxes: DataFrame, assignments: DataFrame, box: int, rounds: int = 3, step: float = 10.0) -> DataFrame:
    """particle_id, inplane_angle_degrees: each class against its running mean.

    A round sums the turned boxes on the executors and sends the mean of each class back, so no task holds a class.
    """
    spark = boxes.sparkSession
    rows = written(boxes.where("kept").select("particle_id", "data").join(assignments.where("cluster_id <> 'noise'"), "particle_id"), "members")
    angles = rows.select("particle_id", F.lit(0.0).alias("angle"))
    for _ in range(max(rounds, 1)):
        means = {r.cluster_id: np.array(r["mean"]).reshape((box,) * 3) for r in _turned_mean(rows.join(angles, "particle_id"), box).collect()}
        shared = spark.sparkContext.broadcast(means)

        def best(batches, shared=shared):
            for b in batches:
                found = [S.best_roll(np.frombuffer(d, np.float32).reshape((box,) * 3), shared.value[c], step) for d, c in zip(b["data"], b["cluster_id"], strict=True)]
                yield pd.DataFrame({"particle_id": b["particle_id"], "angle": found})

        angles = written(rows.mapInPandas(best, "particle_id string, angle double"), "angles")
    return angles.withColumnRenamed("angle", "inplane_angle_degrees")


def _turned_mean(rows: DataFrame, box: int, by: list[str] | None = None) -> DataFrame:
    """Class means of boxes turned by their angle; each task adds up its own boxes first."""
    by = by or ["cluster_id"]

    def partial(batches):
        sums: dict[tuple, list] = {}
        for b in batches:
            for *key, data, angle in b[[*by, "data", "angle"]].itertuples(index=False):
                own = S.turn(np.frombuffer(data, np.float32).reshape((box,) * 3).astype(float), angle).ravel()
                have = sums.setdefault(tuple(key), [0, np.zeros(box**3)])
                have[0] += 1
                have[1] += own
        for key, (n, total) in sums.items():
            yield pd.DataFrame({**{k: [v] for k, v in zip(by, key, strict=True)}, "n": [n], "total": [total.tolist()]})

    schema = ", ".join(f"{c} string" for c in by) + ", n long, total array<double>"
    parts = written(rows.mapInPandas(partial, schema), "partial")
    each = parts.select(*by, F.posexplode("total").alias("i", "v")).groupBy(*by, "i").agg(F.sum("v").alias("v"))
    arrays = each.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("a"))
    counts = parts.groupBy(*by).agg(F.sum("n").alias("n"))
    return arrays.join(counts, by).select(*by, "n", F.transform("a", lambda s: s["v"] / F.col("n")).alias("mean"))


def class_averages(boxes: DataFrame, assignments: DataFrame, box: int, angles: DataFrame | None = None) -> DataFrame:
    """cluster_id, half_set, n, mean (array, axes x, y, z) of each class and half; noise is left out."""
    rows = boxes.where("kept").select("particle_id", "half_set", "data").join(assignments.where("cluster_id <> 'noise'"), "particle_id")
    rows = rows.join(angles, "particle_id", "left").withColumn("angle", F.coalesce("inplane_angle_degrees", F.lit(0.0))) if angles is not None else rows.withColumn("angle", F.lit(0.0))
    return _turned_mean(rows, box, ["cluster_id", "half_set"])


def put_averages(averages: DataFrame, folder: str, box: int, voxel: float) -> None:
    """<class>_half<H>_n<count>.mrc, axes turned to z, y, x; those of an earlier run go, since their counts are in their names."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    for old in Path(folder).glob("*_half?_n*.mrc"):
        old.unlink()
    for r in averages.toLocalIterator():
        mrc.write_volume(f"{folder}/{r.cluster_id}_half{r.half_set}_n{r.n}.mrc", np.array(r["mean"]).reshape((box,) * 3).transpose(2, 1, 0), voxel)


__all__ = ["assign", "box_fits", "class_averages", "elementwise_mean", "extract", "feature_rows", "inplane_angles", "put_averages"]
