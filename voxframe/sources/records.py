"""JSON, PDB, panel and configuration inputs."""

from __future__ import annotations

import tomllib
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_D, _S = T.DoubleType(), T.StringType()


def _struct(**kinds) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


PICK = _struct(tomogram_id=_S, position=T.ArrayType(_D), orientation=T.ArrayType(_D), confidence=_D, source_picker=_S, metadata=T.MapType(_S, _S), beam_angle_deviation_degrees=_D, offset_window_angstrom=T.ArrayType(_D), mean_score=_D, profile_score=_D, vesicle_id=_S)
PARTICLE = _struct(particle_id=_S, tomogram_id=_S, position=T.ArrayType(_D), orientation=T.ArrayType(_D), source_picker=_S, confidence=_D, half_set=_S, vesicle_id=_S, beam_angle_deviation_degrees=_D)
PARTICLE_SET = _struct(particles=T.ArrayType(PARTICLE), consensus_rule=_S, contributing_pickers=T.ArrayType(_S))
ASSIGNMENT = _struct(particle_id=_S, cluster_id=_S, classifier=_S, inplane_angle_degrees=_D, vesicle_id=_S)
IDENTIFICATION = _struct(cluster_id=_S, candidate_protein=_S, fit_score=_D, method=_S, score_gap_to_runner_up=_D)
REJECTED = _struct(particle_id=_S, tomogram_id=_S)
MANIFEST = _struct(tomogram_id=_S, segmentation_path=_S, raw_tomogram_path=_S, voxel_size_angstrom=_D, is_decoy=T.BooleanType())
VESICLE = _struct(vesicle_id=_S, tomogram_id=_S, n_picks=T.IntegerType(), surface_area_angstrom2=_D, picks_per_1000_angstrom2=_D)
PANEL = _struct(name=_S, uniprot=_S, structure_path=_S, expected_mass_kda=_D, oligomer=T.IntegerType())

# Atomic weights by element; any other counts as the last one.
WEIGHTS = {"H": 1.0, "C": 6.0, "N": 7.0, "O": 8.0, "F": 9.0, "P": 15.0, "S": 16.0, "CL": 17.0, "FE": 26.0, "ZN": 30.0, "MG": 12.0, "MN": 25.0, "CA": 20.0}
OTHER_WEIGHT = 6.0


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType, lenient: bool = False) -> DataFrame:
    """Rows of JSON lists of records; a file that doesn't fit is an error, or left out."""
    mode = "DROPMALFORMED" if lenient else "FAILFAST"
    return spark.read.schema(schema).option("multiLine", True).option("mode", mode).json(path)


def read_particles(spark: SparkSession, path: str) -> DataFrame:
    """Particles of a particle-set document, checked: halves, unit quaternions, not empty."""
    from ..operators.filters import require

    rows = read_json(spark, path, PARTICLE_SET).selectExpr("inline(particles)")
    if not rows.limit(1).count():
        raise ValueError("the particle set is empty")
    norm = F.sqrt(F.aggregate("orientation", F.lit(0.0), lambda a, x: a + x * x))
    return require(rows, F.col("half_set").isin("A", "B") & (F.col("orientation").isNull() | norm.between(0.99, 1.01)), "a particle has a bad half or orientation")


def placed(particles: DataFrame) -> DataFrame:
    """Particles of a document as the plans have them: x, y, z, orientation as a struct, beam_angle, no vesicle as ''."""
    xyz = [F.col("position")[k].alias("xyz"[k]) for k in range(3)]
    turn = F.when(F.col("orientation").isNotNull(), F.struct(*(F.col("orientation")[k].alias("wxyz"[k]) for k in range(4)))).alias("orientation")
    return particles.select("particle_id", "tomogram_id", *xyz, turn, "source_picker", "confidence", "half_set", F.coalesce("vesicle_id", F.lit("")).alias("vesicle_id"), F.col("beam_angle_deviation_degrees").alias("beam_angle"))


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, ASSIGNMENT)


def read_angles(spark: SparkSession, path: str) -> DataFrame:
    """particle_id, inplane_angle_degrees of the particles that have one."""
    return read_assignments(spark, path).where("inplane_angle_degrees is not null").select("particle_id", "inplane_angle_degrees")


def read_identification(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, IDENTIFICATION)


def read_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected particles of an earlier session; none if it left nothing."""
    path = f"{folder}/rejected_picks.json"
    return read_json(spark, path, REJECTED) if Path(path).exists() else spark.createDataFrame([], REJECTED)


def read_cached_picks(spark: SparkSession, folder: str, ids: list[str]) -> DataFrame:
    """Picks of the tomograms that have a file; files that can't be read are left out."""
    paths = [f"{folder}/{i}.json" for i in ids if Path(f"{folder}/{i}.json").exists()]
    return read_json(spark, paths, PICK, lenient=True) if paths else spark.createDataFrame([], PICK)


def atom_element(line: Column) -> Column:
    """Columns 77-78, else the first letter of the atom's name, else H."""
    from ..functions.text import blank_to_null

    return F.coalesce(blank_to_null(F.trim(F.substring(line, 77, 2))), blank_to_null(F.substring(F.trim(F.substring(line, 13, 4)), 1, 1)), F.lit("H"))


def atoms(lines: DataFrame, line: str = "value") -> DataFrame:
    """The atom records among the lines, with x, y, z, element and weight; other columns stay."""
    from ..operators.filters import atom_records

    text = F.col(line)
    at = lambda start: F.trim(F.substring(text, start, 8)).cast("double")
    element = F.upper(atom_element(text))
    weight = F.coalesce(F.create_map(*(F.lit(x) for kv in WEIGHTS.items() for x in kv))[element], F.lit(OTHER_WEIGHT))
    others = [c for c in lines.columns if c != line]
    return lines.where(atom_records(text)).select(*others, at(31).alias("x"), at(39).alias("y"), at(47).alias("z"), element.alias("element"), weight.alias("weight"))


def read_pdb(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, x, y, z, element, weight of all atom records; an error if there are none."""
    out = atoms(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path")))
    if not out.limit(1).count():
        raise ValueError("no atoms were found")
    return out


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """Candidates of a YAML panel; names are unique and structures lie beside the file."""
    import yaml

    items = (yaml.safe_load(Path(path).read_text()) or {}).get("candidates") or []
    if not items:
        raise ValueError("the panel has no candidates")
    names = [x.get("name") for x in items]
    if None in names or len(set(names)) < len(names):
        raise ValueError("candidates need unique names")
    rows = []
    for x in items:
        if not x.get("structure_path"):
            raise ValueError(f"{x['name']} has no structure")
        where = Path(path).parent / x["structure_path"]
        if not where.exists():
            raise ValueError(f"{where} is missing")
        mass, oligomer = x.get("expected_mass_kda"), x.get("oligomer")
        rows.append((str(x["name"]), x.get("uniprot"), str(where), None if mass is None else float(mass), None if oligomer is None else int(oligomer)))
    return spark.createDataFrame(rows, PANEL)


SECTIONS = {"run", "decoy", "stage", "plots"}


def read_config(path: str) -> dict:
    """A run's settings: known sections only, blank strings unset, paths beside the file."""

    def clean(value):
        if isinstance(value, dict):
            return {k: clean(v) for k, v in value.items()}
        return None if value == "" else value

    config = clean(tomllib.loads(Path(path).read_text()))
    if extra := set(config) - SECTIONS:
        raise ValueError(f"unknown sections: {', '.join(sorted(extra))}")
    stage = config.setdefault("stage", {})
    identify, stop = stage.get("identify"), config.setdefault("run", {}).get("stop_after")
    if identify is not None and stop not in ("pick", "classify") and not (identify.get("candidates") and identify.get("resolution")):
        raise ValueError("identify needs candidates and a resolution")
    return config


def read_model_star(path: str) -> float | None:
    """The current resolution of a refinement's model file."""
    for line in Path(path).read_text().splitlines():
        parts = line.split()
        if len(parts) == 2 and parts[0] == "_rlnCurrentResolution":
            return float(parts[1])
    return None
