"""The whole run on both tracks: pick, decoys, classify, identify, refine, report; finished stages are kept."""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import box_voxels, decoys_wanted, quaternion_from_normal
from ..functions.text import stage_folder
from ..operators import decoys as D
from ..operators.joins import labels_for, with_roll
from ..sources import mrc, records, sinks
from . import classify, identify, pick, slabs
from .state import ContentCache, RunState, content_digests, half_tree, signatures, symmetry, with_source


# The settings file's names and what they are called here.
NAMES = {
    "run": {"segmentation_dir": "segmentations", "raw_tomogram_dir": "tomograms", "raw_dir": "tomograms", "output_dir": "out", "voxel_size_angstrom": "voxel", "stop_after": "stop_after", "vesicle_labels": "vesicle_labels"},
    "decoy": {
        "enabled": "decoys", "method": "decoy_method", "n_decoys_per_tomogram": "decoy_count", "min_distance_from_real_angstrom": "decoy_distance_angstrom", "min_distance_from_picks_angstrom": "decoy_pick_distance_angstrom",
        "min_shift_angstrom": "decoy_least_shift_angstrom", "max_shift_angstrom": "decoy_most_shift_angstrom", "n_synthetic_tomograms": "noise_count", "synthetic_shape_voxels": "noise_shape",
    },
    "pick": {"pickers": "pickers", "consensus_rule": "rule", "distance_threshold": "threshold_voxels", "half_set_seed": "seed", "max_beam_angle": "max_beam_angle", "vesicle_labels": "vesicle_labels"},
    "classify": {
        "method": "method", "min_cluster_size": "least_size", "n_clusters": "k", "n_components": "components", "box_angstrom": "box_angstrom", "n_radial_bins": "radial_bins", "strict_halfset_independence": "strict",
        "inplane_alignment": "align", "inplane_angular_step_degrees": "align_step_degrees", "inplane_iterations": "align_rounds", "random_state": "random_state", "feature_normalisation": "normalisation",
    },
    "identify": {"candidates": "candidates", "resolution": "resolution", "search": "search"},
    "refine": {"class_id": "class_id", "threshold": "fsc_threshold", "mask": "mask"},
}
#: Known names without a meaning here: Spark is the scheduler, nothing is fetched or plotted, and refinement itself is another program's.
WITHOUT_EFFECT = {"n_workers", "keep_raw", "backend", "fitter", "fetch_missing", "tool", "iterations"}
PATHS = ("segmentations", "tomograms", "out", "vesicle_labels", "candidates", "mask")


@dataclass
class RunSettings:
    """Settings of a run. Distances are angstrom, save the consensus threshold, which is voxels."""

    segmentations: str
    tomograms: str
    out: str
    voxel: float | None = None
    stop_after: str | None = None
    pick: pick.PickSettings = field(default_factory=pick.PickSettings)
    pickers: tuple[str, ...] = ("native",)
    threshold_voxels: float = 15.0
    rule: str = "intersection"
    seed: int = 0
    max_beam_angle: float | None = None
    vesicle_labels: str | None = None
    decoys: bool = True
    decoy_method: str = "rejected-surface"
    decoy_ratio: float = 1.0
    decoy_count: int | None = None
    decoy_distance_angstrom: float = 100.0
    decoy_pick_distance_angstrom: float = 60.0
    decoy_least_shift_angstrom: float = 200.0
    decoy_most_shift_angstrom: float = 600.0
    noise_count: int | None = 3
    #: z, y, x; the first tomogram's, if none is given.
    noise_shape: tuple[int, int, int] | None = None
    box_angstrom: float = 300.0
    method: str = "density"
    k: int = 5
    least_size: int = 20
    components: int = 20
    radial_bins: int = 12
    normalisation: str = "both"
    strict: bool = True
    align: bool = True
    align_step_degrees: float = 10.0
    align_rounds: int = 3
    random_state: int = 0
    candidates: str | None = None
    resolution: float | None = None
    search: dict = field(default_factory=dict)
    class_id: str = "all"
    fsc_threshold: float = 0.143
    mask: str | None = None

    @classmethod
    def from_file(cls, path: str) -> RunSettings:
        """Settings of a run's TOML file; names that no stage knows are an error, blank values are unset, paths lie beside the file.

        [stage.pick] also takes the native picker's own settings, as PickSettings has them.
        """
        config, flat, own = records.read_config(path), {}, {}
        sections = {"run": config.get("run", {}), "decoy": config.get("decoy", {}), **config.get("stage", {})}
        for name, values in sections.items():
            if name not in NAMES:
                raise ValueError(f"unknown stage {name}")
            for key, value in values.items():
                if value is None or key in WITHOUT_EFFECT:
                    continue
                if key in NAMES[name]:
                    flat[NAMES[name][key]] = value
                elif name == "pick" and key in pick.PickSettings.__dataclass_fields__:
                    own[key] = value
                else:
                    raise ValueError(f"{name} doesn't know {key}")
        if not all(flat.get(x) for x in ("segmentations", "tomograms", "out")):
            raise ValueError("run needs segmentation_dir, raw_tomogram_dir and output_dir")
        if flat.get("stop_after") in ("pick", "classify"):
            flat.pop("candidates", None), flat.pop("resolution", None)
        for key in PATHS:
            if flat.get(key):
                flat[key] = str((Path(path).parent / flat[key]).resolve())
        if "pickers" in flat:
            flat["pickers"] = tuple(x.rpartition("-")[2] for x in flat["pickers"])  # a picker's maker may stand before its name
        if flat.get("method") == "hdbscan":
            flat["method"] = "density"
        for key in ("noise_shape",):
            if key in flat:
                flat[key] = tuple(flat[key])
        if "windows" in own:
            own["windows"] = [tuple(w) for w in own["windows"]]
        return cls(pick=pick.PickSettings(**own), **flat)

    @property
    def stages(self) -> tuple[str, ...]:
        """Stages of the run; candidates are needed from identify on."""
        own = ("pick", "classify", "identify", "refine")
        return own[: own.index(self.stop_after) + 1] if self.stop_after else own

    def __post_init__(self):
        if unknown := [p for p in self.pickers if p not in pick.PICKERS]:
            raise ValueError(f"unknown pickers: {', '.join(unknown)}")
        if not self.pickers:
            raise ValueError("a picker is needed")
        if self.rule not in ("union", "intersection"):
            raise ValueError(f"unknown rule {self.rule}")
        if self.stop_after not in (None, "pick", "classify", "identify", "refine"):
            raise ValueError(f"unknown stage {self.stop_after}")
        if self.method not in ("density", "kmeans"):
            raise ValueError(f"unknown method {self.method}")
        if self.decoy_method not in DECOYS:
            raise ValueError(f"unknown decoy method {self.decoy_method}")
        if self.decoy_method == "synthetic-noise" and not self.noise_count:
            raise ValueError("the number of noise volumes is needed")
        if self.decoy_least_shift_angstrom > self.decoy_most_shift_angstrom:
            raise ValueError("shifts must not fall")
        if (self.candidates is None) != (self.resolution is None):
            raise ValueError("candidates and a resolution go together")


DECOYS = ("rejected-surface", "shifted", "synthetic-noise")


class Run:
    """Stages of one output folder; each is a Parquet table with a provenance file."""

    def __init__(self, spark: SparkSession, settings: RunSettings):
        self.spark, self.s, self.state = spark, settings, RunState(settings.out)
        self.caches: dict[tuple[str, str, str], ContentCache] = {}

    def where(self, track: str, stage: str) -> str:
        return stage_folder(self.s.out, stage, track)

    def table(self, track: str, stage: str, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.where(track, stage)}/{name}")

    def put(self, track: str, stage: str, **tables: DataFrame) -> None:
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.where(track, stage)}/{name}")

    def finish(self, track: str, stage: str) -> None:
        """Only now the stage counts as done."""
        folder = self.where(track, stage)
        sinks.put_provenance(folder, stage, "voxframe", {k: str(v) for k, v in vars(self.s).items()}, self.inputs())
        self.state.mark(track, stage)

    def inputs(self) -> dict[str, str]:
        return signatures({"segmentation": self.s.segmentations, "raw": self.s.tomograms, "labels": self.s.vesicle_labels})

    def cache(self, track: str, stage: str, name: str, *unit: str) -> ContentCache:
        """Results of a stage by the content of their units: what neither inputs nor settings changed isn't made again."""
        return self.caches.setdefault((track, stage, name), ContentCache(self.spark, f"{self.where(track, stage)}/{name}", list(unit or ("tomogram_id",))))

    def manifests(self, track: str = "real") -> DataFrame:
        """Paths of each tomogram, with label_path where vesicles are labelled."""
        if track == "decoy" and self.s.decoy_method == "synthetic-noise":
            return self.table("decoy", "pick", "manifests")
        found = mrc.manifests(self.spark, self.s.segmentations, self.s.tomograms, self.s.voxel)[0]
        if not self.s.vesicle_labels:
            return found
        stems = mrc.volumes(self.spark, self.s.vesicle_labels, voxels=False).select("stem", F.col("path").alias("label_path"))
        return labels_for(found, stems).drop("stem")

    def voxel(self) -> float:
        return self.manifests().first().voxel_size_angstrom

    def box(self) -> int:
        return box_voxels(self.s.box_angstrom, self.voxel())

    def scored(self, picker: str) -> DataFrame:
        """The picker's scored points; of a tomogram whose files and settings are the same, those of before."""
        work = with_source(self.manifests())
        made = content_digests(work, ["tomogram_id"], F.col("source"), F.col("voxel_size_angstrom"))
        name = "scored" if picker == self.s.pickers[0] else f"scored_{picker}"
        return self.cache("real", "pick", name).results(made, vars(self.s.pick), lambda units: pick.PICKERS[picker](self.manifests().join(units, "tomogram_id", "left_semi"), self.s.pick)).drop("digest")

    def pick_real(self) -> None:
        """Particles that the pickers found, together by the rule."""
        picks = [pick.raw_picks(self.scored(name), name) for name in self.s.pickers]
        found = functools.reduce(DataFrame.unionByName, picks)
        self.put("real", "pick", particles=pick.particle_set(found, self.s.threshold_voxels, self.s.rule, len(picks), self.s.max_beam_angle, self.s.seed))
        particles, folder = self.table("real", "pick", "particles"), self.where("real", "pick")
        sinks.put_particle_set(particles, f"{folder}/particle_set.json", self.s.rule, list(self.s.pickers))
        if self.s.vesicle_labels:
            sinks.put_vesicle_summary(pick.vesicle_summary(particles, slabs.surface_areas(self.manifests())), f"{folder}/vesicle_summary.json")
        self.finish("real", "pick")

    def decoy_points(self, real: DataFrame) -> DataFrame:
        """tomogram_id, x, y, z, nx, ny, nz of the decoys, by the method asked for; a tomogram whose files, picks and settings are the same keeps its own."""
        if self.s.decoy_method == "synthetic-noise":
            return self.noise_points(real)
        files = with_source(self.manifests()).select("tomogram_id", F.col("source").alias("name"), *(F.lit(None).cast("double").alias(c) for c in "xyz"))
        picks = real.select("tomogram_id", F.col("particle_id").alias("name"), "x", "y", "z")
        made = content_digests(files.unionByName(picks), ["tomogram_id"], *(F.col(c) for c in ("name", "x", "y", "z")))
        of = {k: v for k, v in vars(self.s).items() if k.startswith("decoy_")} | vars(self.s.pick) | {"voxel": self.voxel(), "picker": self.s.pickers[0]}
        scored, own = self.scored(self.s.pickers[0]), ["tomogram_id", "x", "y", "z", "nx", "ny", "nz"]
        only = lambda df, units: df.join(units, "tomogram_id", "left_semi")
        return self.cache("decoy", "pick", "points").results(made, of, lambda units: self.drawn(only(real, units), only(scored, units)).select(own)).drop("digest")

    def drawn(self, real: DataFrame, scored: DataFrame) -> DataFrame:
        """Decoys from scored points or shifted picks; each tomogram's for itself."""
        s, xyz, voxel = self.s, ["x", "y", "z"], self.voxel()
        if s.decoy_method == "rejected-surface":
            return D.from_rejected(scored, real, s.pick.threshold, s.decoy_distance_angstrom / voxel, s.decoy_count, s.decoy_ratio)
        else:
            shapes = mrc.volumes(self.spark, s.segmentations, voxels=False).select(F.col("stem").alias("tomogram_id"), "nz", "ny", "nx")
            surface = scored.select("tomogram_id", *xyz, "nx", "ny", "nz").dropDuplicates(["tomogram_id", *xyz])
            return D.shifted(real.select("tomogram_id", "particle_id", *xyz), surface, shapes, "particle_id", *(x / voxel for x in (s.decoy_least_shift_angstrom, s.decoy_most_shift_angstrom, s.decoy_distance_angstrom, s.decoy_pick_distance_angstrom)))

    def noise_points(self, real: DataFrame) -> DataFrame:
        s, voxel = self.s, self.voxel()
        wanted = s.decoy_count or real.groupBy("tomogram_id").count().agg(F.max(decoys_wanted(F.col("count"), s.decoy_ratio))).first()[0]
        first = s.noise_shape or mrc.volumes(self.spark, s.tomograms, voxels=False).orderBy("stem").select("nz", "ny", "nx").first()
        folder, shape = self.where("decoy", "pick"), tuple(first)
        sign = -1.0 if s.pick.dark else 1.0
        self.put("decoy", "pick", manifests=D.noise_manifests(self.spark, s.noise_count, shape, f"{folder}/volumes", voxel, sign))
        sinks.put_rows(self.table("decoy", "pick", "manifests").orderBy("tomogram_id"), f"{folder}/decoy_manifests.json")
        return D.synthetic(self.spark, s.noise_count, wanted, shape, sign)

    def pick_decoy(self) -> None:
        real = self.table("real", "pick", "particles")
        normal = [F.col(c) for c in ("nx", "ny", "nz")]
        points = self.decoy_points(real).select("tomogram_id", "x", "y", "z", quaternion_from_normal(*normal).alias("orientation"), F.lit("").alias("vesicle_id"))
        decoys = D.finalised(points, self.s.decoy_method)
        self.put("decoy", "pick", unchecked=decoys)
        decoys = D.checked(real, self.table("decoy", "pick", "unchecked"))
        self.put("decoy", "pick", particles=decoys)
        sinks.put_particle_set(self.table("decoy", "pick", "particles"), f"{self.where('decoy', 'pick')}/decoy_particle_set.json", "union", [f"decoy-{self.s.decoy_method}"])
        self.finish("decoy", "pick")

    def classify(self, track: str) -> None:
        box, s, found = self.box(), self.s, self.manifests(track)
        particles = self.table(track, "pick", "particles")
        of = particles.join(with_source(found).select("tomogram_id", "source"), "tomogram_id")
        made = content_digests(of, ["tomogram_id"], *(F.col(c) for c in ("source", "particle_id", "half_set", "vesicle_id", "x", "y", "z", "orientation")))
        boxes = self.cache(track, "classify", "boxes").results(made, {"box": box}, lambda units: classify.extract(particles.join(units, "tomogram_id", "left_semi"), found, box))
        whole = boxes.select("tomogram_id", "digest").distinct()
        power = s.normalisation in ("particle", "both")
        raw = self.cache(track, "classify", "features").results(whole, {"box": box, "power": power, "radial": s.radial_bins}, lambda units: classify.raw_features(boxes.drop("digest").join(units, "tomogram_id", "left_semi"), box, s.normalisation, radial=s.radial_bins))
        features = classify.feature_rows(None, box, s.normalisation, raw=raw, radial=s.radial_bins)
        assigned = classify.assign(features, s.method, s.k, s.least_size, s.components, s.strict, s.random_state)
        self.put(track, "classify", assignments=assigned)
        assigned = self.table(track, "classify", "assignments")
        angles = None
        if s.align:
            members = assigned.where("cluster_id <> 'noise'")
            made = content_digests(members.join(raw.select("particle_id", "mark"), "particle_id"), ["cluster_id"], F.col("particle_id"), F.col("mark"))

            def align(units: DataFrame) -> DataFrame:
                own = members.join(units, "cluster_id", "left_semi")
                return classify.inplane_angles(boxes, own, box, s.align_rounds, s.align_step_degrees).join(own, "particle_id")

            turned = self.cache(track, "classify", "turned", "cluster_id").results(made, {"box": box, "rounds": s.align_rounds, "step": s.align_step_degrees}, align)
            self.put(track, "classify", angles=turned.select("particle_id", "inplane_angle_degrees"))
            angles = self.table(track, "classify", "angles")
        of = assigned.where("cluster_id <> 'noise'").join(raw.select("particle_id", "half_set", "mark"), "particle_id")
        of = of.join(angles, "particle_id", "left") if angles is not None else of.withColumn("inplane_angle_degrees", F.lit(None).cast("double"))
        marks = content_digests(of, ["cluster_id"], *(F.col(c) for c in ("particle_id", "half_set", "mark", "inplane_angle_degrees")))
        self.put(track, "classify", marks=marks.withColumnRenamed("digest", "content"))
        folder = self.where(track, "classify")
        sinks.put_assignments(assigned.join(particles.select("particle_id", "vesicle_id"), "particle_id", "left"), f"{folder}/class_assignments.json", s.method, angles)
        classify.put_averages(classify.class_averages(boxes, assigned, box, angles), f"{folder}/averages", box, self.voxel())
        self.finish(track, "classify")

    def identify(self) -> None:
        panel = records.read_panel(self.spark, self.s.candidates).collect()
        atoms = {}
        for p in panel:
            rows = np.array(records.read_pdb(self.spark, p.structure_path).select("x", "y", "z", "weight").collect(), dtype=float)
            atoms[p.name] = rows[:, :3], rows[:, 3]
        names = self.spark.createDataFrame([(p.name, k, hashlib.sha256(b"".join(np.ascontiguousarray(x).tobytes() for x in atoms[p.name])).hexdigest()) for k, p in enumerate(panel)], "name string, at int, atoms_mark string")
        tracks = {}
        for track in ("real", "decoy") if self.s.decoys else ("real",):
            folder = f"{self.where(track, 'classify')}/averages"
            averages = identify.load_averages(self.spark, folder)
            # by what the averages were made from: the order in which sums meet may change a mean's last bits
            own = F.coalesce("content", F.xxhash64("mean").cast("string"))
            marked = averages.join(self.table(track, "classify", "marks"), "cluster_id", "left")
            pairs = marked.select("cluster_id", F.concat_ws(":", own, "box", "voxel").alias("class_mark")).crossJoin(F.broadcast(names))
            made = pairs.select("cluster_id", F.col("name").alias("candidate_protein"), F.concat_ws(":", "class_mark", "atoms_mark").alias("digest"))
            make = lambda units, averages=averages: identify.fit_all(averages, names, atoms, self.s.resolution, wanted=units, **self.s.search).drop("at")
            scores = self.cache("real", "identify", f"scores_{track}", "cluster_id", "candidate_protein").results(made, {"resolution": self.s.resolution, "search": self.s.search}, make)
            tracks[track] = scores.drop("digest").join(F.broadcast(names.select(F.col("name").alias("candidate_protein"), "at")), "candidate_protein")
        verdict = identify.control(tracks["real"], tracks["decoy"]) if self.s.decoys else {"passed": None, "reason": "there are no decoys"}
        folder = self.where("real", "identify")
        self.put("real", "identify", identified=identify.identified(tracks["real"]))
        sinks.put_rows(self.table("real", "identify", "identified").orderBy("cluster_id"), f"{folder}/identification.json")
        sinks.put_json(f"{folder}/decoy_control.json", verdict)
        sinks.put_text(f"{folder}/identification_report.txt", sinks.identification_report(tracks["real"], verdict, symmetry(self.where("real", "classify"))))
        self.finish("real", "identify")

    def refine(self) -> None:
        """Resolution of each class from its two half averages; a star file of its particles, rolled as they were aligned, for other programs."""
        folder, out = f"{self.where('real', 'classify')}/averages", self.where("real", "refine")
        classes = sorted({Path(p).stem.split("_half")[0] for p in mrc.list_volumes(folder)})
        if self.s.class_id != "all":
            classes = [c for c in classes if c == self.s.class_id or c == f"c{int(self.s.class_id):02d}"] if self.s.class_id.removeprefix("c").isdigit() else []
            if not classes:
                raise ValueError(f"there is no class {self.s.class_id}")
        particles, assigned = self.table("real", "pick", "particles"), self.table("real", "classify", "assignments")
        if self.s.align:
            particles = with_roll(particles, self.table("real", "classify", "angles"))
        mask = mrc.read_volume(self.s.mask) if self.s.mask else None
        rows = []
        for c in classes:
            tree = half_tree(out, c)
            members = particles.join(assigned.where(F.col("cluster_id") == c), "particle_id", "left_semi")
            sinks.put_star(members, f"{tree['both']}/particles.star")
            for half in "AB":
                sinks.put_star(members.where(F.col("half_set") == half), f"{tree[half]}/particles.star")
            try:
                found = identify.resolve(folder, c, self.s.fsc_threshold, tree, mask)
            except ValueError:
                rows.append((c, None, False))
                continue
            sinks.put_fsc(found, f"{out}/{c}", self.s.fsc_threshold)
            rows.append((c, found["resolution"], found["crossed"]))
        self.put("real", "refine", resolution=self.spark.createDataFrame(rows, "cluster_id string, resolution double, crossed boolean"))
        self.finish("real", "refine")

    def report(self) -> None:
        done = self.state.done.get("real", {})
        best = [r.asDict() for r in self.table("real", "identify", "identified").orderBy("cluster_id").collect()] if "identify" in done else []
        found = {r.cluster_id: r.resolution for r in self.table("real", "refine", "resolution").collect()} if "refine" in done else {}
        sinks.put_report(self.s.out, best, found, self.s.fsc_threshold, {"inputs": self.inputs()})

    def go(self, force: bool = False, start: str | None = None) -> list[tuple[str, str]]:
        """Run what isn't finished, in order; what was run."""
        stages = [s for s in self.s.stages if s != "identify" or self.s.candidates]
        plan = [x for x in self.state.planned(stages, force, start) if self.s.decoys or x[0] == "real"]
        for track, stage in plan:
            if stage == "pick":
                self.pick_real() if track == "real" else self.pick_decoy()
            elif stage == "classify":
                self.classify(track)
            else:
                getattr(self, stage)()
        self.report()
        return plan
