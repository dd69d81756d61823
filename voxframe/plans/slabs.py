"""Surface points and their scores from slabs of volumes: a task holds some planes, never a tomogram.

Volumes are read by planes where their files lie. Everything between two readings is DataFrame operators: what is counted,
thinned out, normalised or suppressed goes through `operators`, by tomogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import vesicle_name
from ..kernels import volume as V
from ..operators import aggregates as A
from ..operators.filters import accepted, inside_margin
from ..operators.grouping import both_faces, downsample, suppress
from ..operators.windows import best_of
from ..scratch import dealt, written
from ..sources import mrc

#: Bytes of one volume's planes, as 32-bit floats, that a task works on at once, besides those around them.
SLAB_BYTES = 64 << 20
#: Points that a task samples.
POINTS = 20_000
PATHS = "tomogram_id string, segmentation_path string, raw_tomogram_path string, label_path string, voxel double"
SHAPED = f"{PATHS}, nz int, ny int, nx int"
EDGES = "tomogram_id string, number long, z double, y double, x double, nz double, ny double, nx double"


def shaped(manifests: DataFrame) -> DataFrame:
    """Paths, voxel size and shape of each tomogram. A segmentation, and labels, of another shape than the tomogram are an error."""
    labels = F.col("label_path") if "label_path" in manifests.columns else F.lit(None).cast("string")

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for r in rows.itertuples(index=False):
                heads = [mrc.read_header(p) for p in (r.segmentation_path, r.raw_tomogram_path, r.label_path) if p]
                shapes = [(h.nz, h.ny, h.nx) for h in heads]
                if len(set(shapes)) > 1:
                    raise ValueError(f"{r.tomogram_id}: the shapes differ")
                out.append((*r, *shapes[0]))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SHAPED.split(", ")])

    named = manifests.select("tomogram_id", "segmentation_path", "raw_tomogram_path", labels.alias("label_path"), F.col("voxel_size_angstrom").alias("voxel"))
    return named.mapInPandas(look, SHAPED)


def in_slabs(volumes: DataFrame, nbytes: int | None = None) -> DataFrame:
    """volumes with z0 and dz, a row for each slab."""
    nbytes = nbytes or SLAB_BYTES
    planes = F.greatest(F.lit(1), F.floor(F.lit(nbytes) / (4 * F.col("ny").cast("long") * F.col("nx")))).cast("int")
    cut = volumes.withColumn("_dz", planes).withColumn("z0", F.explode(F.expr("sequence(0, nz - 1, _dz)")))
    return cut.withColumn("dz", F.least("_dz", F.col("nz") - F.col("z0"))).drop("_dz")


def _voxels(slabs: DataFrame) -> DataFrame:
    return dealt(slabs, F.col("dz").cast("long") * F.col("ny") * F.col("nx"), ["tomogram_id", "z0"], (SLAB_BYTES // 4) * 4)


def _sortable(values: np.ndarray) -> np.ndarray:
    """32-bit floats as unsigned numbers of the same order."""
    bits = (values.astype(np.float32) + np.float32(0)).view(np.uint32)
    return np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))


def _background(r) -> np.ndarray:
    seg = mrc.read_volume(r.segmentation_path, r.z0, r.dz)
    return mrc.read_volume(r.raw_tomogram_path, r.z0, r.dz)[seg <= 0]


def background_medians(slabs: DataFrame) -> DataFrame:
    """tomogram_id and the exact median of its voxels outside the segmentation, if there are some.

    Tasks count values by the upper half of their bits; sums of the counts tell in which one or two of these 65,536 bins the
    middle lies, and a second reading counts the values of these alone.
    """
    dealt_slabs = written(slabs, "slabs")

    def coarse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for name, own in rows.groupby("tomogram_id"):
                counts = sum(np.bincount(_sortable(_background(r)) >> 16, minlength=1 << 16) for r in own.itertuples())
                bins = np.flatnonzero(counts)
                yield pd.DataFrame({"tomogram_id": name, "bin": bins.astype("int32"), "n": counts[bins]})

    counted = _voxels(dealt_slabs).mapInPandas(coarse, "tomogram_id string, bin int, n long").groupBy("tomogram_id", "bin").agg(F.sum("n").alias("n"))
    order, whole = Window.partitionBy("tomogram_id").orderBy("bin"), Window.partitionBy("tomogram_id")
    placed = counted.select("*", (F.sum("n").over(order) - F.col("n")).alias("before"), F.sum("n").over(whole).alias("total"))
    middle = (F.col("before") <= F.floor(F.col("total") / 2)) & (F.col("before") + F.col("n") > F.floor((F.col("total") - 1) / 2))
    wanted = written(placed.where(middle), "bins")

    def fine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for r in rows.itertuples():
                values = _background(r)
                own, n = np.unique(values[np.isin(_sortable(values) >> 16, np.asarray(r.bins))], return_counts=True)
                yield pd.DataFrame({"tomogram_id": r.tomogram_id, "value": own.astype(float), "n": n})

    bins = wanted.groupBy("tomogram_id").agg(F.collect_list("bin").alias("bins"), F.min("before").alias("before"), F.max("total").alias("total"))
    values = _voxels(dealt_slabs.join(bins.select("tomogram_id", "bins"), "tomogram_id")).mapInPandas(fine, "tomogram_id string, value double, n long")
    values = values.groupBy("tomogram_id", "value").agg(F.sum("n").alias("n")).join(bins.drop("bins"), "tomogram_id")
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("tomogram_id").orderBy("value"))
    found = values.select("tomogram_id", "value", "n", "total", upto.alias("upto")).where((F.col("upto") - F.col("n") <= F.floor(F.col("total") / 2)) & (F.col("upto") > F.floor((F.col("total") - 1) / 2)))
    return written(found.groupBy("tomogram_id").agg(((F.min("value") + F.max("value")) / 2).cast("float").cast("double").alias("background")), "backgrounds")


def surface_edges(slabs: DataFrame) -> DataFrame:
    """Points and normals of each segmentation's surface, with a number in the order of the edges' middles; empty ones give none."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for r in rows.itertuples():
                start = max(0, r.z0 - V.SIGHT - 1)
                end = min(r.nz, r.z0 + r.dz + V.SIGHT + 1)
                middle, p, n = V.surface_edges(mrc.read_volume(r.segmentation_path, start, end - start), planes=(r.z0 - start, r.z0 + r.dz - start))
                middle[:, 0] += 2 * start
                number = np.ravel_multi_index(tuple(middle.T), (2 * r.nz, 2 * r.ny, 2 * r.nx)) if len(p) else np.zeros(0, np.int64)
                yield pd.DataFrame({"tomogram_id": r.tomogram_id, "number": number.astype(np.int64), "z": p[:, 0] + start, "y": p[:, 1], "x": p[:, 2], "nz": n[:, 0], "ny": n[:, 1], "nx": n[:, 2]})

    return _voxels(slabs).mapInPandas(find, EDGES)


def sampled(points: DataFrame, windows: list[tuple[float, float]], samples: int) -> DataFrame:
    """points with raw (samples of each window along the normal, in the tomogram with its membrane filled) and label.

    points: tomogram_id, idx, x, y, z, nx, ny, nz and the tomogram's paths, voxel and background. Tasks get points that follow each other in z and read
    the planes around them.
    """
    reach = max(abs(offset) for window in windows for offset in window)
    form = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in points.schema)}, raw array<array<double>>, label long"

    def take(own: pd.DataFrame) -> pd.DataFrame:
        r = own.iloc[0]
        head, around = mrc.read_header(r.raw_tomogram_path), int(np.ceil(reach / r.voxel)) + 2
        start = max(0, int(own["z"].min()) - around)
        n = min(head.nz, int(own["z"].max()) + around + 1) - start
        volume = mrc.read_volume(r.raw_tomogram_path, start, n)
        if r.background == r.background:
            volume[mrc.read_volume(r.segmentation_path, start, n) > 0] = np.float32(r.background)
        at, normals = own[["z", "y", "x"]].to_numpy(float) - (start, 0, 0), own[["nz", "ny", "nx"]].to_numpy(float)
        raw = [V.sample_along(volume, at, normals, low / r.voxel, high / r.voxel, samples) for low, high in windows]
        labels = np.zeros(len(own), np.int64)
        if r.label_path:
            near = np.clip(np.rint(at).astype(int), 0, np.array(volume.shape) - 1)
            labels = mrc.read_volume(r.label_path, start, n)[tuple(near.T)].astype(np.int64)
        return own.assign(raw=[[w[k].tolist() for w in raw] for k in range(len(own))], label=labels)

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, tomogram in rows.groupby("tomogram_id"):
                head = mrc.read_header(tomogram["raw_tomogram_path"].iloc[0])
                for _, own in tomogram.groupby(tomogram["z"] // max(1, SLAB_BYTES // (4 * head.ny * head.nx))):
                    yield take(own)

    return written(dealt(points, F.lit(1), ["tomogram_id", "z", "idx"], POINTS).mapInPandas(sample, form), "samples")


def scored(manifests: DataFrame, s) -> DataFrame:
    """Both faces of each surface point with the score of their best window; `kept` marks picks. s: PickSettings.

    manifests may have label_path. A tomogram without a surface gives no rows.
    """
    volumes = written(shaped(manifests), "shapes")
    slabs = in_slabs(volumes)
    edges = surface_edges(slabs).join(volumes.withColumnsRenamed({c: f"size_{c}" for c in ("nz", "ny", "nx")}), "tomogram_id")
    edges = edges.select("*", *((F.col(c) * F.col("voxel")).alias(f"{c}_angstrom") for c in "xyz"))
    thin = downsample(edges, [f"{c}_angstrom" for c in "zyx"], s.spacing_angstrom, "number", ["tomogram_id"])
    size = [F.col(f"size_{c}") for c in ("nz", "ny", "nx")]
    thin = thin.where(inside_margin([F.col(c) for c in "zyx"], size, s.margin_angstrom / F.col("voxel")))
    faces = both_faces(thin, ["nx", "ny", "nz"]).withColumn("idx", F.col("number") + F.when(F.col("side") < 0, 8 * size[0].cast("long") * size[1] * size[2]).otherwise(0))
    faces = faces.select("tomogram_id", "idx", *"xyz", *(F.col(f"n_{c}").alias(c) for c in ("nx", "ny", "nz")), "segmentation_path", "raw_tomogram_path", "label_path", "voxel").join(background_medians(slabs), "tomogram_id", "left")
    rows = sampled(faces, s.windows, s.samples).select("*", F.posexplode("raw").alias("window", "samples"))
    rows = rows.withColumn("samples", F.transform("samples", lambda v: F.lit(-1.0 if s.dark else 1.0) * v)).withColumn("vesicle_id", vesicle_name(F.col("tomogram_id"), F.col("label")))
    mean = F.aggregate("samples", F.lit(0.0), lambda a, v: a + v) / s.samples
    profile = F.lit(None).cast("double")
    for k, (low, high) in enumerate(s.windows):
        profile = F.when(F.col("window") == k, A.profile_correlation(F.col("samples"), A.window_profile(low, high, s.samples, s.profile_width_angstrom))).otherwise(profile)
    rows = written(rows.select("tomogram_id", "idx", *"xyz", "nx", "ny", "nz", *((F.col(c) * F.col("voxel")).alias(f"{c}_angstrom") for c in "xyz"), "window", "vesicle_id", F.col("label_path").isNotNull().alias("labelled"), mean.alias("mean"), profile.alias("profile")), "windows")
    angstrom, by = [f"{c}_angstrom" for c in "xyz"], ["tomogram_id", "window"]
    for x in ("mean", "profile"):
        if s.normalisation == "vesicle":
            rows = A.normalise_by_vesicle(rows, x, "vesicle_id", f"{x}_score", by).withColumn("fell_back", F.col("fell_back") & F.col("labelled"))
        elif s.normalisation == "local":
            rows = A.normalise_locally(rows, x, angstrom, s.local_radius_angstrom, s.min_local_neighbours, "idx", by, f"{x}_score")
        else:
            rows = A.robust_normalise(rows, x, by, f"{x}_score").withColumn("fell_back", F.lit(False))
        rows = rows.withColumnRenamed("fell_back", f"{x}_fell_back")
    rows = rows.withColumn("score", F.col(f"{s.mode}_score")).withColumn("fell_back", F.col(f"{s.mode}_fell_back"))
    best = written(best_of(rows.drop("mean", "profile", "mean_fell_back", "profile_fell_back", "labelled"), ["tomogram_id", "idx"], "score", "window"), "best")
    over = best.where(accepted(F.col("score"), s.threshold))
    kept = suppress(over.select("tomogram_id", "idx", *angstrom, "score"), ["tomogram_id"], angstrom, "score", "idx", s.separation_angstrom).select("tomogram_id", "idx", F.lit(True).alias("_kept"))
    out = best.join(kept, ["tomogram_id", "idx"], "left").withColumn("kept", F.coalesce("_kept", F.lit(False)))
    return out.select("tomogram_id", "idx", *"xyz", "nx", "ny", "nz", "score", "mean_score", "profile_score", "window", "vesicle_id", "fell_back", "kept")


def surface_areas(manifests: DataFrame) -> DataFrame:
    """vesicle_id and area in square angstrom of the segmentations' triangles, by the label nearest to a triangle's middle. manifests have label_path."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for r in rows.itertuples():
                n = min(r.nz, r.z0 + r.dz + 1) - r.z0  # a slab's last cells reach one plane on
                triangles = V.surface_triangles(mrc.read_volume(r.segmentation_path, r.z0, n), planes=(0, r.dz))
                labels = mrc.read_volume(r.label_path, r.z0, n).astype(np.int64)
                near = np.clip(np.rint(triangles.mean(axis=1) + (r.z0, 0, 0)).astype(int) - (r.z0, 0, 0), 0, np.array(labels.shape) - 1)
                own, areas = labels[tuple(near.T)], V.triangle_areas(triangles) * r.voxel**2
                out += [(r.tomogram_id, int(k), float(areas[own == k].sum())) for k in np.unique(own[own > 0])]
            yield pd.DataFrame(out, columns=["tomogram_id", "label", "area"])

    slabs = in_slabs(written(shaped(manifests.where("label_path is not null")), "shapes"))
    parts = _voxels(slabs).mapInPandas(measure, "tomogram_id string, label long, area double")
    return parts.groupBy(vesicle_name(F.col("tomogram_id"), F.col("label")).alias("vesicle_id")).agg(F.sum("area").alias("area"))
