"""What is finished: fingerprints beside results, run state, and the order of stages."""

from __future__ import annotations

import functools
import json
import shutil
import tomllib
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import file_sha256, file_signature, stage_folder
from ..scratch import written
from ..sources.sinks import put_json

STAGES = ("pick", "classify", "identify", "refine")


def sync(folder: str, fingerprint: dict) -> bool:
    """True if the folder's results were made from this fingerprint; else it is emptied and gets it."""
    wanted, mark = json.loads(json.dumps(fingerprint, default=str)), Path(folder) / "checkpoint.json"
    try:
        if json.loads(mark.read_text()) == wanted:
            return True
    except (OSError, ValueError):
        pass
    shutil.rmtree(folder, ignore_errors=True)
    Path(folder).mkdir(parents=True)
    put_json(str(mark), wanted)
    return False


#: Tomograms (or other units of work) of one write; after a failure at most so many are done again.
BATCH = 256


def resumed(work: DataFrame, key: str, folder: str, fingerprint: dict, make: Callable[[DataFrame], DataFrame], size: int = BATCH) -> DataFrame:
    """make(work), written a batch of keys at a time; keys whose batch the folder holds aren't made again.

    A batch counts once its mark lies beside it, so what a failed run left half-written isn't read. Results of another
    fingerprint are thrown away. Names of the units come to the driver, their rows don't.
    """
    sync(folder, fingerprint)
    marks = {m: json.loads(m.read_text()) for m in Path(folder).glob("*.done")}
    have = {k for keys in marks.values() for k in keys}
    rest = sorted(r[0] for r in work.select(key).distinct().collect() if r[0] not in have)
    for at in range(0, len(rest), size) if rest or have else [0]:
        some, mark = rest[at : at + size], Path(folder) / f"{uuid.uuid4().hex}.done"
        make(work.where(F.col(key).isin(some))).write.parquet(str(mark.with_suffix("")))
        put_json(str(mark), some)
        marks[mark] = some
    return work.sparkSession.read.parquet(*(str(m.with_suffix("")) for m in marks))


def content_digests(members: DataFrame, unit: list[str], *content: Column) -> DataFrame:
    """unit, digest: a digest of each unit's rows that their order doesn't change; rows that come twice count twice.

    Number, and sums of two hashes of the rows with their nulls told apart, are merged in the tasks before the shuffle, so a unit with
    most of the rows is no burden.
    """
    text = F.to_json(F.array(*(c.cast("string") for c in content)), {"ignoreNullFields": "false"})
    wide = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")
    sums = members.select(*unit, F.xxhash64(text).cast("decimal(38,0)").alias("_x"), wide.alias("_w")).groupBy(*unit).agg(F.count(F.lit(1)).alias("_n"), F.sum("_x").alias("_x"), F.sum("_w").alias("_w"))
    return sums.select(*unit, F.concat_ws(":", "_n", "_x", "_w").alias("digest"))


class ContentCache:
    """Results of units of work (a tomogram, a class, a class with a candidate), kept by the digest of what they were made from.

    A digest holds the unit's members and the settings, so a change makes only the units anew that it reaches: an anti-join of the
    digests with those of the parts that are there. Missing units are made some at a time; a part has a table of its units and one of their
    results, and counts once its mark lies beside them, so a run that died goes on after its last whole part. Parts without a unit
    that is still wanted go; superseded results in other parts stay until then, and aren't read. The names of units don't come to the driver.
    """

    def __init__(self, spark: SparkSession, folder: str, unit: list[str]):
        self.spark, self.folder, self.unit = spark, folder, unit
        #: Units that the last call made.
        self.made = 0

    def _parts(self) -> list[str]:
        return sorted(str(m.with_suffix("")) for m in Path(self.folder).glob("*.done") if (m.with_suffix("") / "units").exists())

    def _units(self, parts: list[str], like: DataFrame) -> DataFrame:
        schema = T.StructType([*like.select(*self.unit, "digest").schema.fields, T.StructField("part", T.StringType())])
        return self.spark.read.schema(schema).parquet(*(f"{p}/units" for p in parts)) if parts else self.spark.createDataFrame([], schema)

    def results(self, digests: DataFrame, settings: dict, make: Callable[[DataFrame], DataFrame], size: int = BATCH) -> DataFrame:
        """What make(units) gives for all units, with their digest; it is called with the units (unit columns, digest) that are missing.

        digests: unit, digest, as content_digests gives them; a unit comes once. make's rows carry the unit's columns; a unit
        may give none.
        """
        mark = F.sha2(F.concat_ws("|", F.col("digest"), F.lit(json.dumps(settings, sort_keys=True, default=str))), 256)
        wanted = written(digests.where(all_named(digests, self.unit)).select(*self.unit, mark.alias("digest")), "wanted")
        on = [*self.unit, "digest"]
        missing = written(wanted.join(self._units(self._parts(), wanted).select(*on), on, "left_anti"), "missing")
        self.made = missing.count()
        batches = -(-self.made // size)
        schema = None
        for k in range(batches):
            some = missing.where(F.pmod(F.xxhash64(*self.unit), F.lit(batches)) == k)
            part = Path(self.folder) / uuid.uuid4().hex
            made = make(some).join(some, self.unit)
            made.write.parquet(f"{part}/results")
            some.withColumn("part", F.lit(part.name)).write.parquet(f"{part}/units")
            put_json(f"{part}.done", k)
            schema = made.schema
        parts = self._parts()
        if not parts:
            return make(wanted.limit(0)).join(wanted.limit(0), self.unit)
        alive = self._units(parts, wanted).join(wanted, on, "left_semi").dropDuplicates(on)
        used = {r[0] for r in alive.select("part").distinct().collect()}  # parts, not units
        for p in parts:
            if Path(p).name not in used:
                Path(f"{p}.done").unlink()
                shutil.rmtree(p, ignore_errors=True)
        kept = [f"{p}/results" for p in parts if Path(p).name in used]
        if not kept:
            return make(wanted.limit(0)).join(wanted.limit(0), self.unit)
        out = (self.spark.read.schema(schema) if schema else self.spark.read).parquet(*kept)
        return out.join(wanted.select(*on), on, "left_semi").select(*out.columns)


def all_named(df: DataFrame, unit: list[str]) -> Column:
    """An error where a unit has a null in its name: such a one would be made again each time."""
    named = functools.reduce(Column.__and__, (F.col(c).isNotNull() for c in unit))
    return F.when(named, F.lit(True)).otherwise(F.raise_error(F.lit("a unit of work has no name")).cast("boolean"))


def with_source(manifests: DataFrame) -> DataFrame:
    """manifests with source: size and time of the files that each names, looked up by tasks; a missing file is an error."""
    paths = [c for c in ("segmentation_path", "raw_tomogram_path", "label_path") if c in manifests.columns]

    def look(batches):
        for rows in batches:
            yield rows.assign(source=[" ".join(file_signature(p) if p else "-" for p in own) for own in rows[paths].itertuples(index=False)])

    return manifests.mapInPandas(look, T.StructType([*manifests.schema.fields, T.StructField("source", T.StringType())]))


def signatures(folders: dict[str, str | None]) -> dict[str, str]:
    """role/name -> size:mtime of all files; a missing folder has none."""
    out = {}
    for role, folder in sorted(folders.items()):
        for p in sorted(Path(folder).glob("*")) if folder else []:
            if p.is_file():
                out[f"{role}/{p.name}"] = file_signature(str(p))
    return out


def checksums(paths: list[str], cache: str) -> dict[str, str]:
    """sha256 of each file; one that has its size and time of the cache isn't read again. A broken cache counts as empty."""
    try:
        known = json.loads(Path(cache).read_text())
    except (OSError, ValueError):
        known = {}
    out = {}
    for path in paths:
        mark = file_signature(path)
        out[path] = known[path][1] if known.get(path, [None])[0] == mark else file_sha256(path)
        known[path] = [mark, out[path]]
    put_json(cache, known)
    return out


def provenance(folder: str) -> dict:
    """What a stage's params.toml says; empty if there is none."""
    try:
        return tomllib.loads((Path(folder) / "params.toml").read_text())
    except (OSError, ValueError):
        return {}


def symmetry(folder: str) -> str:
    """C1 of classes that were aligned in their plane, else that of a turn about z."""
    return "C1" if str(provenance(folder).get("parameters", {}).get("align", False)).lower() == "true" else "Cinf_z"


def half_map(half_folder: str | None, class_folder: str, cluster: str, half: str) -> str | None:
    """The map of one half: the half's own folder goes before the class averages; of several the first by name."""
    for folder, pattern in ((half_folder, "*.mrc"), (class_folder, f"{cluster}_half{half}_*.mrc")):
        found = sorted(Path(folder).glob(pattern)) if folder else []
        if found:
            return str(found[0])
    return None


def half_tree(root: str, cluster: str) -> dict[str, str]:
    """Where a class's halves and their combination go: names to folders."""
    return {name: f"{root}/{cluster}/{folder}" for name, folder in (("A", "halfA"), ("B", "halfB"), ("both", "combined"))}


class RunState:
    """track -> stage -> done, in a small file; a broken file counts as empty."""

    def __init__(self, root: str):
        self.root, self.path = root, f"{root}/run_state.json"
        try:
            self.done = json.loads(Path(self.path).read_text())
        except (OSError, ValueError):
            self.done = {}

    def mark(self, track: str, stage: str) -> None:
        self.done.setdefault(track, {})[stage] = True
        put_json(self.path, self.done)

    def complete(self, track: str, stage: str) -> bool:
        return bool(self.done.get(track, {}).get(stage)) and (Path(stage_folder(self.root, stage, track)) / "params.toml").exists()

    def planned(self, stages: list[str], force: bool = False, start: str | None = None) -> list[tuple[str, str]]:
        """(track, stage) to run in order: from the first unfinished one, or from `start`, on both tracks."""
        out, redo = [], {"real": force, "decoy": force}
        for stage in (s for s in STAGES if s in stages):
            for track in ("real", "decoy") if stage in ("pick", "classify") else ("real",):
                redo[track] |= stage == start or not self.complete(track, stage) or stage == "identify" and redo["decoy"]
                if redo[track]:
                    out.append((track, stage))
        return out


def job_graph(stages: list[str]) -> dict[tuple[str, str], list[tuple[str, str]]]:
    """What each (track, stage) waits for; stages that aren't asked for drop out."""
    waits = {
        ("real", "pick"): [], ("decoy", "pick"): [("real", "pick")],
        ("real", "classify"): [("real", "pick")], ("decoy", "classify"): [("decoy", "pick")],
        ("real", "identify"): [("real", "classify"), ("decoy", "classify")], ("real", "refine"): [("real", "identify")],
    }
    return {k: [w for w in v if w[1] in stages] for k, v in waits.items() if k[1] in stages}
