"""Documents, star files, reports and provenance of finished stages."""

from __future__ import annotations

import datetime
import hashlib
import json
import math
import os
import tarfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import tilt_psi
from .documents import as_json, put_document


def put_text(path: str, text: str) -> None:
    """Whole or not at all."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    Path(part).write_text(text)
    os.replace(part, path)


def put_json(path: str, value) -> None:
    put_text(path, json.dumps(value, indent=2, default=str))


def put_rows(df: DataFrame, path: str) -> None:
    """A JSON list of the rows in their order, a row a line; tasks write it."""
    put_document(df, as_json(df), path, "[\n", ",\n", "\n]\n")


def particle_documents(particles: DataFrame) -> DataFrame:
    """Particles (x, y, z, orientation as a struct) in the shape of their document; columns that are missing are null."""
    have = set(particles.columns)
    own = lambda c, kind, source=None: (F.col(source or c) if (source or c) in have else F.lit(None)).cast(kind).alias(c)
    turn = F.when(F.col("orientation").isNotNull(), F.array(*(F.col(f"orientation.{k}") for k in "wxyz"))) if "orientation" in have else F.lit(None).cast("array<double>")
    vesicle = F.when(F.col("vesicle_id") != "", F.col("vesicle_id")) if "vesicle_id" in have else F.lit(None).cast("string")
    return particles.select(
        "particle_id", "tomogram_id", F.array("x", "y", "z").alias("position"), turn.alias("orientation"), own("source_picker", "string"),
        own("confidence", "double"), own("half_set", "string"), vesicle.alias("vesicle_id"), own("beam_angle_deviation_degrees", "double", "beam_angle"),
    )


def put_particle_set(particles: DataFrame, path: str, rule: str, pickers: list[str]) -> None:
    """The document that records.read_particles reads, particles by their ids; tasks write it."""
    if not particles.limit(1).count():
        raise ValueError("the particle set is empty")
    rows = particle_documents(particles).orderBy("particle_id")
    rest = json.dumps({"consensus_rule": rule, "contributing_pickers": sorted(pickers)})[1:]
    put_document(rows, as_json(rows), path, '{"particles": [\n', ",\n", f"\n], {rest}\n")


def put_assignments(assignments: DataFrame, path: str, classifier: str = "native", angles: DataFrame | None = None) -> None:
    """particle_id, cluster_id, classifier, inplane_angle_degrees, vesicle_id, in the order of the particles."""
    rows = assignments.join(angles, "particle_id", "left") if angles is not None else assignments.withColumn("inplane_angle_degrees", F.lit(None).cast("double"))
    vesicle = F.col("vesicle_id") if "vesicle_id" in rows.columns else F.lit(None).cast("string").alias("vesicle_id")
    put_rows(rows.select("particle_id", "cluster_id", F.lit(classifier).alias("classifier"), "inplane_angle_degrees", vesicle).orderBy("particle_id"), path)


def put_vesicle_summary(summary: DataFrame, path: str) -> None:
    """vesicle_id, tomogram_id, n_picks, area and density; nothing where there is no vesicle."""
    rows = summary.select(
        "vesicle_id", F.substring_index("vesicle_id", ":", 1).alias("tomogram_id"), F.col("n_picks").cast("int").alias("n_picks"),
        F.col("area").alias("surface_area_angstrom2"), F.col("per_1000").alias("picks_per_1000_angstrom2"),
    )
    if rows.limit(1).count():
        put_rows(rows.orderBy("vesicle_id"), path)


def star_rows(particles: DataFrame) -> DataFrame:
    """Columns of a particle star file; orientation is a struct (w, x, y, z)."""
    angles = tilt_psi(F.col("orientation"))
    return particles.select(
        F.col("tomogram_id").alias("rlnTomoName"), F.col("x").alias("rlnCoordinateX"), F.col("y").alias("rlnCoordinateY"), F.col("z").alias("rlnCoordinateZ"),
        F.lit(0.0).alias("rlnAngleRot"), angles["tilt"].alias("rlnAngleTiltPrior"), angles["psi"].alias("rlnAnglePsiPrior"), F.col("particle_id").alias("rlnTomoParticleName"),
    )


def put_star(particles: DataFrame, path: str) -> None:
    """A star file of the particles by their ids; tasks write it. What is missing is written as None."""
    rows = star_rows(particles).orderBy("rlnTomoParticleName")
    show = [F.when(F.col(c).isNull(), "None").otherwise(F.format_string("%.6f", c) if kind == "double" else F.col(c)) for c, kind in rows.dtypes]
    head = ["", "data_particles", "", "loop_", *(f"_{c} #{k}" for k, c in enumerate(rows.columns, 1)), ""]
    put_document(rows, F.concat_ws(" ", *show), path, "\n".join(head))


def put_fsc(result: dict, folder: str, threshold: float = 0.143) -> None:
    """fsc.txt and a plain fsc.svg with the threshold as a dashed line."""
    rows = list(zip(result["frequency"], result["fsc_unmasked"], result["fsc_masked"], strict=True))
    put_text(f"{folder}/fsc.txt", "# freq_per_A  fsc_unmasked  fsc_masked\n" + "".join(f"{f:.6f}  {u:.4f}  {m:.4f}\n" for f, u, m in rows))
    top = max(float(rows[-1][0]), 1e-9)
    line = lambda k, colour: f'<polyline fill="none" stroke="{colour}" points="' + " ".join(f"{10 + 380 * r[0] / top:.1f},{150 - 130 * r[k]:.1f}" for r in rows) + '"/>'
    put_text(f"{folder}/fsc.svg", f'<svg xmlns="http://www.w3.org/2000/svg" width="400" height="170">{line(1, "grey")}{line(2, "black")}<line x1="10" x2="390" y1="{150 - 130 * threshold:.1f}" y2="{150 - 130 * threshold:.1f}" stroke="red" stroke-dasharray="4"/></svg>\n')


def resolution_text(value: float | None) -> str:
    if value is None or math.isnan(value):
        return "n/a"
    return "> Nyquist" if math.isinf(value) else f"{value:.2f}"


def identification_report(ranked: DataFrame, control: dict, symmetry: str | None = None) -> str:
    """The verdict, then each class's candidates from best to worst."""
    lines = [f"decoy control: {'passed' if control['passed'] else 'FAILED'} ({control['reason']})", *([f"symmetry: {symmetry}"] if symmetry else []), ""]
    last = None
    for r in ranked.orderBy("cluster_id", F.desc("fit_score"), "candidate_protein").collect():
        if r.cluster_id != last:
            lines.append(r.cluster_id)
            last = r.cluster_id
        lines.append(f"  {r.candidate_protein}: {r.fit_score:.4f}")
    return "\n".join(lines) + "\n"


def put_report(folder: str, identified: list[dict], resolutions: dict[str, float | None], threshold: float, provenance: dict) -> None:
    lines = ["# Run report", "", "## Identified classes", ""]
    lines += [f"- {x['cluster_id']}: {x['candidate_protein']} ({x['fit_score']:.4f})" for x in identified] or ["- none"]
    lines += ["", f"## Resolution (FSC = {threshold:g})", "", *(f"- {k}: {resolution_text(v)}" for k, v in sorted(resolutions.items()))]
    put_text(f"{folder}/report.md", "\n".join(lines) + "\n")
    put_json(f"{folder}/report.json", {"identified": identified, "resolution": {k: resolution_text(v) for k, v in resolutions.items()}, "provenance": provenance})


def put_provenance(folder: str, stage: str, tool: str, parameters: dict, inputs: dict[str, str], version: str | None = None) -> None:
    """params.toml beside a stage's results."""
    show = lambda v: json.dumps("" if v is None else v if isinstance(v, (bool, int, float, str)) else str(v))
    lines = [f"stage = {show(stage)}", f"tool = {show(tool)}", f"tool_version = {show(version)}", f'timestamp = "{datetime.datetime.now(datetime.UTC).isoformat()}"', "", "[parameters]"]
    lines += [f"{json.dumps(k)} = {show(v)}" for k, v in sorted(parameters.items())] + ["", "[input_checksums]"]
    lines += [f"{json.dumps(k)} = {show(v)}" for k, v in sorted(inputs.items())]
    put_text(f"{folder}/params.toml", "\n".join(lines) + "\n")


def folder_digest(folder: str) -> str:
    """sha256 over the sorted lines path:sha256 of a folder; 'absent' if it is missing."""
    root = Path(folder)
    if not root.exists():
        return "absent"
    files = [root] if root.is_file() else sorted(p for p in root.rglob("*") if p.is_file() and not p.name.startswith(".checksums"))
    lines = [f"{p.relative_to(root).as_posix()}:{hashlib.sha256(p.read_bytes()).hexdigest()}" for p in files]
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def archive(folder: str) -> str:
    """folder.tar.gz in place of the folder."""
    import shutil

    with tarfile.open(f"{folder}.tar.gz", "w:gz") as tar:
        tar.add(folder, arcname=Path(folder).name)
    shutil.rmtree(folder)
    return f"{folder}.tar.gz"
