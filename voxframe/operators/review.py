"""Accepting and rejecting picks by hand: sets of ids, their history, and what a viewer shows."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import new_path
from .filters import in_slab


def toggled(rejected: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """(rejected or added) and not removed, each id once."""
    return rejected.union(added).distinct().exceptAll(removed.distinct())


def symmetric(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).exceptAll(a.intersect(b)).exceptAll(a.intersect(b))


#: Rows of a review's places: the last one counts.
PLACE = "turn long, at int, n int, kind string"


def fold(log: DataFrame, key: str, upto: int | Column) -> DataFrame:
    """key of what is rejected after operation `upto`: the last of an id's rows (op, key, rejected) tells, so one aggregate folds any number of operations."""
    return log.where(F.col("op") <= upto).groupBy(key).agg(F.max_by("rejected", "op").alias("_rejected")).where("_rejected").select(key)


class Review:
    """A log of operations on a rejected set; undo and redo move the place in it up to which it counts.

    Operation n is a table of its own (op=n in the folder): an id that it changed, and whether that is rejected from then on. The
    rejected set is the fold of the operations up to the place, so its plan is the same after any number of them, and folders of
    operations that were taken back aren't read. An operation after some that were taken back replaces them. Place and number of
    operations are a row that is written last, so what a failed run left half-written doesn't count. A review
    of the same folder goes on where the last one ended. Null ids are left out; ids that come twice in an operation count once.

    states: the rejected set to begin with, and further ones, each an operation; none for a folder that has a log.
    """

    def __init__(self, states: list[DataFrame], key: str = "particle_id", folder: str | None = None):
        self.key, self.spark = key, (states[0].sparkSession if states else SparkSession.active())
        self.folder = folder or new_path(self.spark, "review")
        self.kind = states[0].schema[key].dataType.simpleString() if states else None
        self.at = self.n = -1
        if (mark := read_place(self.spark, self.folder)) is not None:
            self.at, self.n, self.kind = mark
        elif not states:
            raise ValueError("a new review needs a rejected set to begin with")
        else:
            self._append(states[0].select(key, F.lit(True).alias("rejected")))
        for s in states[1:] if mark is None else []:
            self.put(s)

    def _log(self) -> DataFrame:
        return self.spark.read.schema(f"`{self.key}` {self.kind}, rejected boolean, op int").option("basePath", self.folder).parquet(f"{self.folder}/op=*")

    @property
    def rejected(self) -> DataFrame:
        return fold(self._log(), self.key, self.at)

    def _append(self, changes: DataFrame) -> None:
        if self.n > self.at:
            # what was taken back can't be done again from here on, whatever becomes of the next write
            self.n = self.at
            self._note()
        changes.where(F.col(self.key).isNotNull()).dropDuplicates([self.key]).write.mode("overwrite").parquet(f"{self.folder}/op={self.at + 1}")
        self.at = self.n = self.at + 1
        self._note()

    def _note(self) -> None:
        self.spark.createDataFrame([(time.time_ns(), self.at, self.n, self.kind)], PLACE).coalesce(1).write.mode("append").parquet(f"{self.folder}/place")

    def put(self, rejected: DataFrame) -> None:
        """Make this the rejected set; what is in it and wasn't, and what was and isn't, is the operation."""
        now, new = self.rejected.withColumn("_was", F.lit(True)), rejected.select(self.key).distinct().withColumn("rejected", F.lit(True))
        both = now.join(new, self.key, "full_outer").where("_was is null or rejected is null")
        self._append(both.select(self.key, F.coalesce("rejected", F.lit(False)).alias("rejected")))

    def toggle(self, ids: DataFrame) -> None:
        was = self.rejected.withColumn("_was", F.lit(True))
        self._append(ids.select(self.key).distinct().join(was, self.key, "left").select(self.key, F.col("_was").isNull().alias("rejected")))

    def reject(self, ids: DataFrame) -> None:
        self._append(ids.select(self.key, F.lit(True).alias("rejected")))

    def reset(self, ids: DataFrame) -> None:
        self._append(ids.select(self.key, F.lit(False).alias("rejected")))

    def undo(self) -> None:
        self.at = max(0, self.at - 1)
        self._note()

    def redo(self) -> None:
        self.at = min(self.n, self.at + 1)
        self._note()

    def saved(self, particles: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Accepted particles and the rejected (id, tomogram); an error if nothing is accepted."""
        accepted = particles.join(self.rejected, self.key, "left_anti")
        if not accepted.limit(1).count():
            raise ValueError("no particle is accepted")
        return accepted, particles.join(self.rejected, self.key, "left_semi").select(self.key, "tomogram_id")


def read_place(spark: SparkSession, folder: str) -> tuple[int, int, str] | None:
    """Place, number of the last operation and the ids' type of a log; None if there is none."""
    try:
        last = spark.read.schema(PLACE).parquet(f"{folder}/place").orderBy(F.desc("turn")).first()
    except AnalysisException:
        return None
    return (last["at"], last["n"], last["kind"]) if last else None


def load_review(spark: SparkSession, particle_set: str, segmentations: str | None = None, tomograms: str | None = None, folder: str | None = None) -> tuple[DataFrame, DataFrame, Review]:
    """Particles, the volumes of their tomograms (tomogram_id, segmentation_path, raw_tomogram_path; exact stems), and a review.

    The review goes on from what an earlier one saved in the folder.
    """
    from ..sources import mrc, records

    particles = records.placed(records.read_particles(spark, particle_set))
    known = particles.select("tomogram_id").distinct()
    for name, where in (("segmentation_path", segmentations), ("raw_tomogram_path", tomograms)):
        files = mrc.volumes(spark, where, voxels=False).select(F.col("stem").alias("tomogram_id"), F.col("path").alias(name)) if where else spark.createDataFrame([], f"tomogram_id string, {name} string")
        known = known.join(files, "tomogram_id", "left")
    before = records.read_rejected(spark, folder) if folder else spark.createDataFrame([], records.REJECTED)
    return particles, known, Review([before.select("particle_id").distinct()])


def save_review(review: Review, particles: DataFrame, folder: str, rule: str = "union", pickers: list[str] | None = None) -> tuple[str, str]:
    """particle_set.filtered.json with the accepted and rejected_picks.json; an error if nothing is accepted."""
    from ..sources import sinks

    accepted, rejected = review.saved(particles)
    paths = f"{folder}/particle_set.filtered.json", f"{folder}/rejected_picks.json"
    sinks.put_particle_set(accepted, paths[0], rule, pickers or [])
    sinks.put_rows(rejected, paths[1])
    return paths


def z_diagram(df: DataFrame, z: Column, centre: float, thickness: float) -> DataFrame:
    return df.agg(
        F.count_if(z < centre - thickness).alias("below"),
        F.count_if(in_slab(z, centre, thickness)).alias("visible"),
        F.count_if(z > centre + thickness).alias("above"),
    )


def review_counts(particles: DataFrame, rejected: DataFrame, key: str, visible: Column) -> DataFrame:
    marked = particles.join(rejected.distinct().withColumn("_r", F.lit(True)), key, "left")
    accepted = F.col("_r").isNull()
    return marked.agg(F.count(F.lit(1)).alias("total"), F.count_if(accepted).alias("accepted"), F.count_if(accepted & visible).alias("visible"))


def score_matrix(scores: DataFrame, candidates: list[str], row: str = "cluster_id", column: str = "candidate_protein", value: str = "fit_score") -> DataFrame:
    """A row for each class with a column for each candidate of the panel; null where a pair has no score."""
    return scores.groupBy(row).pivot(column, candidates).agg(F.max(value))


def page(df: DataFrame, order: str, number: int, size: int) -> DataFrame:
    """One page of tomograms for a viewer."""
    return df.orderBy(order).offset(number * size).limit(size)
