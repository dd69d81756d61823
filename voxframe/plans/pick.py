"""Volumes to particle sets: surface points, face scores, picks, consensus and halves."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import beam_angle, effective_threshold, largest_offset, quaternion_from_normal
from ..functions.text import numbered
from ..operators.filters import under_angle
from ..operators.grouping import reconcile
from ..operators.joins import density
from ..operators.windows import split_halves
from ..sources import mrc
from . import slabs


@dataclass
class PickSettings:
    # The picker's usual windows, distances and thresholds.
    windows: list[tuple[float, float]] = field(default_factory=lambda: [(20.0, 50.0), (40.0, 80.0), (70.0, 110.0), (100.0, 160.0)])
    samples: int = 5
    n_mad: float = 3.0
    spacing_angstrom: float = 20.0
    separation_angstrom: float = 60.0
    mode: str = "mean"
    normalisation: str = "global"
    dark: bool = True
    boundary_margin_angstrom: float | None = None
    local_radius_angstrom: float = 150.0
    min_local_neighbours: int = 20
    profile_width_angstrom: float | None = None

    def __post_init__(self):
        if not self.windows or any(low > high for low, high in self.windows):
            raise ValueError("offset windows must not fall")
        if self.samples < 3:
            raise ValueError("a profile needs three samples")
        if self.mode not in ("mean", "profile") or self.normalisation not in ("global", "local", "vesicle"):
            raise ValueError("unknown scoring mode or normalisation")
        if min(self.spacing_angstrom, self.local_radius_angstrom) <= 0 or self.min_local_neighbours < 1:
            raise ValueError("spacing, local radius and neighbours must be positive")
        if self.profile_width_angstrom is not None and self.profile_width_angstrom <= 0:
            raise ValueError("the profile's width must be positive")

    @property
    def threshold(self) -> float:
        return effective_threshold(self.n_mad, len(self.windows))

    @property
    def margin_angstrom(self) -> float:
        return largest_offset(self.windows) if self.boundary_margin_angstrom is None else self.boundary_margin_angstrom


def scored_points(manifests: DataFrame, settings: PickSettings) -> DataFrame:
    """Both faces of every surface point of every manifest with their scores; see `slabs`."""
    return slabs.scored(manifests, settings)


#: Pickers by name: functions of (manifests, settings) that give rows as scored_points does.
PICKERS: dict[str, Callable[[DataFrame, PickSettings], DataFrame]] = {"native": scored_points}


def raw_picks(scored: DataFrame, picker: str = "native") -> DataFrame:
    kept = scored.where("kept").drop("kept").withColumn("picker", F.lit(picker))
    return kept.withColumn("orientation", quaternion_from_normal(F.col("nx"), F.col("ny"), F.col("nz"))).withColumn("beam_angle", beam_angle(F.col("nx"), F.col("ny"), F.col("nz")))


def particle_set(picks: DataFrame, threshold_voxels: float, rule: str = "union", n_pickers: int = 1, max_beam_angle: float | None = None, seed: int = 0) -> DataFrame:
    """Reconciled picks with ids and halves; whole tomograms go to one half. The angle filter comes after the halves."""
    flat = picks.select("tomogram_id", "picker", "idx", "x", "y", "z", F.col("score").alias("confidence"), "orientation", "beam_angle", "vesicle_id")
    rows = reconcile(flat, threshold_voxels, rule, n_pickers, ("orientation", "beam_angle", "vesicle_id")).withColumnRenamed("sources", "source_picker")
    rows = numbered(rows, "p", [F.col("tomogram_id"), F.col("group_id")])
    counts = rows.groupBy("tomogram_id").agg(F.count(F.lit(1)).alias("n"))
    halves = split_halves(counts, "tomogram_id", "n", F.md5(F.concat(F.lit(f"{seed}:"), "tomogram_id").cast("binary")))
    out = rows.join(halves.select("tomogram_id", "half_set"), "tomogram_id")
    if max_beam_angle is not None:
        out = out.where(under_angle(F.col("beam_angle"), max_beam_angle))
    if not out.limit(1).count():
        raise ValueError("no particle is left")
    return out.drop("group_id", "n_pickers")


def vesicle_summary(picks: DataFrame, areas: DataFrame) -> DataFrame:
    """vesicle_id, n_picks, area, per_1000 of every vesicle that has picks or area."""
    counts = picks.where("vesicle_id <> ''").groupBy("vesicle_id").agg(F.count(F.lit(1)).alias("n_picks"))
    return density(counts, areas, "vesicle_id")


def run_pick(spark: SparkSession, segmentations: str, tomograms: str, settings: PickSettings, threshold_voxels: float = 5.0, rule: str = "union", voxel: float | None = None, pickers: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The particle set and all scored points (for decoys)."""
    from ..scratch import written

    found, _ = mrc.manifests(spark, segmentations, tomograms, voxel)
    pickers = pickers or ["native"]
    if unknown := [p for p in pickers if p not in PICKERS]:
        raise ValueError(f"unknown pickers: {', '.join(unknown)}")
    points = {p: written(PICKERS[p](found, settings), "scored") for p in pickers}
    picks = None
    for p in pickers:
        own = raw_picks(points[p], p)
        picks = own if picks is None else picks.unionByName(own)
    return particle_set(picks, threshold_voxels, rule, len(pickers)), points[pickers[0]]


__all__ = ["PICKERS", "PickSettings", "particle_set", "raw_picks", "run_pick", "scored_points", "vesicle_summary"]
