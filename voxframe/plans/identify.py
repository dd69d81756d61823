"""Class averages against candidate structures, with a decoy control; half maps to resolution."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import class_of_file
from ..kernels import signal as S
from ..kernels import volume as V
from ..operators.aggregates import decoy_control, elementwise_mean
from ..operators.joins import all_candidates, pending
from ..operators.windows import rank_with_gap
from ..scratch import dealt
from ..sources import mrc
from .state import half_map


def load_averages(spark: SparkSession, folder: str) -> DataFrame:
    """cluster_id, box, voxel, mean: of each class, the plain mean over its files, axes x, y, z."""

    def turn(batches):
        for rows in batches:
            data = [np.frombuffer(r.data, np.float32).reshape(r.nz, r.ny, r.nx).transpose(2, 1, 0).ravel().astype(float).tolist() for r in rows.itertuples()]
            yield pd.DataFrame({"stem": rows["stem"], "box": rows["nx"], "voxel": rows["voxel_x"], "data": data})

    files = mrc.volumes(spark, folder).mapInPandas(turn, "stem string, box int, voxel double, data array<double>")
    named = files.withColumn("cluster_id", class_of_file(F.col("stem"))).where("cluster_id <> ''")
    means = elementwise_mean(named, ["cluster_id"], "data").drop("n")
    heads = named.groupBy("cluster_id").agg(F.max("box").alias("box"), F.max_by("voxel", "stem").alias("voxel"))
    out = means.join(heads, "cluster_id")
    if not out.limit(1).count():
        raise ValueError("no class averages were found")
    return out


#: Pairs that a task fits.
FITS = 4


def fit_all(averages: DataFrame, panel: DataFrame, atoms: dict[str, tuple[np.ndarray, np.ndarray]], resolution: float, done: DataFrame | None = None, absolute: bool = True, wanted: DataFrame | None = None, **search) -> DataFrame:
    """cluster_id, candidate_protein, at, fit_score for every class with every candidate, or the wanted pairs; finished pairs are left out.

    Pairs are dealt out, FITS to a task at most; candidates' atoms are a few thousand numbers each. Averages and candidates are
    compared at one resolution and smeared about z.
    """

    def comparable(batches):
        for rows in batches:
            means = [V.to_comparable(np.array(r.mean).reshape((r.box,) * 3), V.blur_sigma(resolution, r.voxel)).ravel().tolist() for r in rows.itertuples()]
            yield rows.assign(mean=means)

    if wanted is not None:
        averages = averages.join(wanted, "cluster_id", "left_semi")
    pairs = all_candidates(averages.mapInPandas(comparable, averages.schema), panel.select(F.col("name").alias("candidate_protein"), F.col("at")))
    if wanted is not None:
        pairs = pairs.join(wanted, ["cluster_id", "candidate_protein"], "left_semi")
    if done is not None:
        pairs = pending(pairs, done, ["cluster_id", "candidate_protein"])
    shared = averages.sparkSession.sparkContext.broadcast(atoms)

    def fit(batches):
        for rows in batches:
            scores = []
            for r in rows.itertuples():
                points, weights = shared.value[r.candidate_protein]
                own = V.to_comparable(V.simulate_density(points, weights, r.box, r.voxel, resolution))
                scores.append(V.fit_score(np.array(r.mean).reshape((r.box,) * 3), own, absolute=absolute, **search))
            yield pd.DataFrame({"cluster_id": rows["cluster_id"], "candidate_protein": rows["candidate_protein"], "at": rows["at"], "fit_score": scores})

    spread = dealt(pairs, F.lit(1), ["cluster_id", "candidate_protein"], FITS)
    return spread.mapInPandas(fit, "cluster_id string, candidate_protein string, at int, fit_score double")


def identified(scores: DataFrame) -> DataFrame:
    """The best candidate of each class and its gap to the next; ties go by the panel's order."""
    best = rank_with_gap(scores, ["cluster_id"], "fit_score", "at")
    return best.select("cluster_id", "candidate_protein", "fit_score", F.lit("native").alias("method"), F.col("gap").alias("score_gap_to_runner_up"))


def control(real: DataFrame, decoy: DataFrame) -> dict:
    """Verdict on the best scores of the real and the decoy classes."""
    best = lambda df: [r[0] for r in identified(df).select("fit_score").collect()]
    return decoy_control(best(real), best(decoy))


def resolve(folder: str, cluster: str, threshold: float = 0.143, halves: dict[str, str] | None = None, mask: np.ndarray | None = None) -> dict:
    """Shell correlation of a class's two half maps: those of the halves' own folders if they have one, else the averages. Under the mask, or a soft sphere."""
    found = {half: half_map((halves or {}).get(half), folder, cluster, half) for half in "AB"}
    if missing := [half for half, path in found.items() if not path]:
        raise ValueError(f"{cluster} has no half {missing[0]}")
    a, b = (mrc.read_volume(found[half]).astype(float) for half in "AB")
    return S.half_map_fsc(a, b, V.soft_sphere(a.shape[0]) if mask is None else mask.astype(float), mrc.read_header(found["B"]).voxel[0], threshold)
