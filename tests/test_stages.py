"""Volumes to report on small generated data."""

import json
import os
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxframe.kernels import signal as S
from voxframe.kernels import volume as V
import by_hand
from voxframe.operators import decoys as D
from voxframe.operators.review import Review, load_review, save_review
from voxframe.plans import classify, identify, pick
from voxframe.plans.state import RunState, job_graph, resumed, sync
from voxframe.sources import mrc, records, sinks

SIDE = 48


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    root = tmp_path_factory.mktemp("volumes")
    rng = np.random.default_rng(0)
    for k in range(4):
        seg, tomo = np.zeros((SIDE,) * 3), rng.normal(size=(SIDE,) * 3)
        seg[:, :, 20] = 1
        for y, z in ((16, 16), (16, 32), (32, 16), (32, 32)):
            tomo[z - 2 : z + 3, y - 2 : y + 3, 23:28] = -9
        for name, v in (("seg", seg), ("tomo", tomo)):
            (root / name).mkdir(exist_ok=True)
            mrc.write_volume(str(root / name / (f"t{k:02d}_mask.mrc" if name == "seg" else f"t{k:02d}.mrc")), v, 10.0)
    return root


SETTINGS = pick.PickSettings(windows=[(20.0, 60.0)], n_mad=3.0, separation_angstrom=80.0)


@pytest.fixture(scope="module")
def picked(spark, data):
    particles, scored = pick.run_pick(spark, f"{data}/seg", f"{data}/tomo", SETTINGS)
    return particles.cache(), scored


def test_mrc_round_trip(spark, tmp_path):
    v = np.random.default_rng(1).random((4, 5, 6)).astype(np.float32)
    mrc.write_volume(f"{tmp_path}/a.mrc", v, 13.48)
    assert np.array_equal(mrc.read_volume(f"{tmp_path}/a.mrc"), v)
    rows = mrc.volumes(spark, str(tmp_path), slab=3).orderBy("z0").collect()
    assert [(r.z0, r.dz) for r in rows] == [(0, 3), (3, 1)] and abs(rows[0].voxel_x - 13.48) < 1e-4
    assert np.array_equal(np.concatenate([np.frombuffer(r.data, "<f4") for r in rows]), v.ravel())
    assert mrc.volumes(spark, str(tmp_path), voxels=False).first().data is None
    out = mrc.volumes(spark, str(tmp_path))
    out.write.format("mrc").mode("append").save(f"{tmp_path}/out")
    assert np.array_equal(mrc.read_volume(f"{tmp_path}/out/a.mrc"), v)
    (tmp_path / "bad.mrc").write_bytes(b"x" * 10)
    with pytest.raises(ValueError):
        mrc.read_header(f"{tmp_path}/bad.mrc")
    with pytest.raises(ValueError):
        mrc.list_volumes(f"{tmp_path}/none")


def test_manifests_match_by_longest_prefix(spark, data):
    matched, unmatched = mrc.manifests(spark, f"{data}/seg", f"{data}/tomo")
    rows = matched.collect()
    assert len(rows) == 4 and unmatched.count() == 0
    assert all(r.raw_tomogram_path.endswith(r.tomogram_id[:3] + ".mrc") and r.voxel_size_angstrom == 10 for r in rows)


def test_pick_finds_the_particles(picked):
    particles, _ = picked
    rows = particles.collect()
    near = [r for r in rows if any((r.y - y) ** 2 + (r.z - z) ** 2 <= 16 for y in (16, 32) for z in (16, 32))]
    assert len(near) >= 12 and len(near) >= 0.8 * len(rows)
    halves = {}
    for r in rows:
        halves.setdefault(r.tomogram_id, set()).add(r.half_set)
    assert all(len(h) == 1 for h in halves.values()) and {h for s in halves.values() for h in s} == {"A", "B"}
    assert sorted(r.particle_id for r in rows) == [f"p{k:06d}" for k in range(len(rows))]


def test_decoys(spark, picked):
    particles, scored = picked
    real = particles.select("tomogram_id", "particle_id", "x", "y", "z")
    found = D.finalised(D.from_rejected(scored, real, 3.0, 6.0, 5), "rejected-surface")
    rows = found.collect()
    assert rows and all(r.particle_id.startswith("decoy-") for r in rows)
    where = {}
    for r in real.collect():
        where.setdefault(r.tomogram_id, []).append((r.x, r.y, r.z))
    assert all(np.linalg.norm(np.array(where[r.tomogram_id]) - (r.x, r.y, r.z), axis=1).min() >= 6 for r in rows)
    D.checked(particles, found)
    with pytest.raises(ValueError):
        D.checked(found, found)
    shapes = real.select("tomogram_id", *(F.lit(SIDE).alias(c) for c in ("nz", "ny", "nx"))).distinct()
    moved = D.shifted(real, scored.select("tomogram_id", "x", "y", "z", "nx", "ny", "nz"), shapes, "particle_id", 8.0, 20.0, 4.0, 5.0)
    assert moved.count() > 0
    noise = D.synthetic(spark, 2, 10, (24, 24, 24))
    assert noise.count() == 20 and noise.select("tomogram_id").distinct().count() == 2


def test_classify_to_resolution(spark, data, picked, tmp_path):
    particles, _ = picked
    found, _ = mrc.manifests(spark, f"{data}/seg", f"{data}/tomo")
    boxes = classify.extract(particles, found, 9).cache()
    assert boxes.where("kept").count() >= 10
    features = classify.feature_rows(boxes, 9, radial=6, angular=16, modes=3).cache()
    strict = classify.assign(features, k=2, components=3, strict=True)
    assert strict.count() == features.count()
    assigned = classify.assign(features, k=1, components=3)
    angles = classify.inplane_angles(boxes, assigned, 9, rounds=1, step=90.0)
    averages = classify.class_averages(boxes, assigned, 9, angles)
    classify.put_averages(averages, f"{tmp_path}/avg", 9, 10.0)
    loaded = identify.load_averages(spark, f"{tmp_path}/avg")
    assert [r.cluster_id for r in loaded.collect()] == ["c00"]
    line = np.array([[x, 0.0, 0.0] for x in np.linspace(-30, 30, 13)])
    atoms = {"dot": (np.zeros((1, 3)), np.ones(1)), "line": (line, np.ones(13))}
    panel = spark.createDataFrame([("dot", 0), ("line", 1)], "name string, at int")
    few = {"turns": 1, "tilts": (0,), "shifts": (0,)}
    scores = identify.fit_all(loaded, panel, atoms, 20.0, **few).cache()
    best = identify.identified(scores).collect()
    assert len(best) == 1 and best[0].score_gap_to_runner_up >= 0
    assert identify.fit_all(loaded, panel, atoms, 20.0, done=scores.where("at = 0"), **few).count() == 1
    fsc = identify.resolve(f"{tmp_path}/avg", "c00")
    assert len(fsc["frequency"]) == 4
    sinks.put_fsc(fsc, f"{tmp_path}/fsc")
    lines = (tmp_path / "fsc/fsc.txt").read_text().splitlines()
    assert len(lines) == 5 and lines[0].startswith("#") and "stroke-dasharray" in (tmp_path / "fsc/fsc.svg").read_text()
    sinks.put_star(particles, f"{tmp_path}/p.star")
    assert "_rlnTomoParticleName #8" in (tmp_path / "p.star").read_text()


def test_averages_are_made_comparable_and_candidates_flipped(spark):
    top = np.array([[x, y, 30.0] for x in np.linspace(-40, 40, 9) for y in np.linspace(-40, 40, 9)])
    atoms = {"cap": (np.concatenate([top, [[0.0, 0.0, z] for z in np.linspace(-60, 20, 9)]]), np.ones(90))}
    panel = spark.createDataFrame([("cap", 0)], "name string, at int")
    own = V.simulate_density(*atoms["cap"], 15, 10.0, 25.0)
    few = {"tilts": (0,), "shifts": (0,), "absolute": False}
    rng = np.random.default_rng(4)
    means = [("c00", V.gaussian(own, 1.06)), ("c01", own[:, :, ::-1] + rng.normal(0, 0.1, own.shape))]
    averages = spark.createDataFrame([(c, m.ravel().tolist(), 15, 10.0) for c, m in means], "cluster_id string, mean array<double>, box int, voxel double")
    got = {r.cluster_id: r.fit_score for r in identify.fit_all(averages, panel, atoms, 25.0, **few).collect()}
    sigma, want = V.blur_sigma(25.0, 10.0), V.to_comparable(own)
    for c, m in means:
        assert np.isclose(got[c], V.fit_score(V.to_comparable(m, sigma), want, **few)) and got[c] > 0.85


def test_features_are_standardised_by_column(spark):
    rng = np.random.default_rng(7)
    names = ["big"] * 60 + ["small"] * 9
    boxes = [rng.normal(size=(9, 9, 9)).astype(np.float32) + (k % 3) for k in range(len(names))]
    boxes[3] = np.zeros((9, 9, 9), np.float32)
    rows = [(f"p{k:02d}", t, "A", "", True, b.tobytes()) for k, (t, b) in enumerate(zip(names, boxes, strict=True))]
    df = spark.createDataFrame([*rows, ("cut", "big", "A", "", False, None)], classify.BOXES).repartition(4)
    options = {"radial": 6, "angular": 16, "modes": 3}
    raw = np.stack([S.features(b.astype(float), **options) for b in boxes])
    z = lambda x: (x - x.mean(axis=0)) / np.where(x.std(axis=0) == 0, 1, x.std(axis=0))
    flat = 6 * 9
    for by_tomogram in (True, False):
        want = raw.copy()
        want[:, flat:] = z(raw[:, flat:])
        if by_tomogram:
            want[:60, flat:] = z(want[:60, flat:])
        got = {r.particle_id: np.array(r.features) for r in classify.feature_rows(df, 9, "both" if by_tomogram else "particle", **options).collect()}
        assert len(got) == 68 and "p03" not in got
        assert all(np.allclose(got[f"p{k:02d}"], want[k]) for k in range(69) if k != 3)


def test_records(spark, tmp_path):
    particle = {"particle_id": "p000000", "tomogram_id": "t", "position": [1, 2, 3], "orientation": [1, 0, 0, 0], "source_picker": "native", "half_set": "A"}
    doc = tmp_path / "set.json"
    doc.write_text(json.dumps({"particles": [particle], "consensus_rule": "union", "contributing_pickers": ["native"]}))
    assert records.read_particles(spark, str(doc)).first().position == [1.0, 2.0, 3.0]
    doc.write_text(json.dumps({"particles": [particle | {"orientation": [2, 0, 0, 0]}]}))
    with pytest.raises(ValueError):
        records.read_particles(spark, str(doc))
    pdb = tmp_path / "a.pdb"
    pdb.write_text("ATOM      1  CA  ALA A   1      11.104   6.134  -6.504  1.00  0.00           C\nHETATM    2  O   HOH A   2       1.000   2.000   3.000\nEND\n")
    rows = records.read_pdb(spark, str(pdb)).orderBy("x").collect()
    assert [(r.x, r.element) for r in rows] == [(1.0, "O"), (11.104, "C")]
    pdb.write_text("".join(f"HETATM    1 {e:<4} LIG A   1      11.104   6.134  -6.504  1.00  0.00          {e:>2}\n" for e in ("CL", "FE", "ZN", "MG", "MN", "CA", "F", "X")))
    assert sorted(r.weight for r in records.read_pdb(spark, str(pdb)).collect()) == [6.0, 9.0, 12.0, 17.0, 20.0, 25.0, 26.0, 30.0]
    (tmp_path / "panel.yaml").write_text("candidates:\n- {name: a, structure_path: a.pdb, expected_mass_kda: 3}\n")
    assert records.read_panel(spark, str(tmp_path / "panel.yaml")).first().expected_mass_kda == 3.0
    (tmp_path / "panel.yaml").write_text("candidates:\n- {name: a, structure_path: a.pdb}\n- {name: a, structure_path: a.pdb}\n")
    with pytest.raises(ValueError):
        records.read_panel(spark, str(tmp_path / "panel.yaml"))
    (tmp_path / "run.toml").write_text('[run]\nraw_dir = "x"\noutput_dir = ""\n[stage.pick]\nrule = "union"\n')
    config = records.read_config(str(tmp_path / "run.toml"))
    assert config["run"]["raw_dir"] == "x" and config["run"]["output_dir"] is None
    (tmp_path / "run.toml").write_text("[other]\n")
    with pytest.raises(ValueError):
        records.read_config(str(tmp_path / "run.toml"))


def test_documents_come_back(spark, picked, tmp_path):
    particles, _ = picked
    sinks.put_particle_set(particles, f"{tmp_path}/set.json", "union", ["native"])
    back = records.placed(records.read_particles(spark, f"{tmp_path}/set.json"))
    columns = ["particle_id", "tomogram_id", "x", "y", "z", "orientation", "source_picker", "confidence", "half_set", "vesicle_id", "beam_angle"]
    assert back.columns == columns and sorted(back.collect()) == sorted(particles.select(columns).collect())
    assigned = particles.select("particle_id", F.lit("c01").alias("cluster_id"))
    angles = particles.limit(3).select("particle_id", F.lit(20.0).alias("inplane_angle_degrees"))
    sinks.put_assignments(assigned, f"{tmp_path}/classes.json", "kmeans", angles)
    assert sorted(records.read_angles(spark, f"{tmp_path}/classes.json").collect()) == sorted(angles.collect())
    assert records.read_assignments(spark, f"{tmp_path}/classes.json").where("classifier = 'kmeans' and cluster_id = 'c01'").count() == particles.count()
    summary = pick.vesicle_summary(spark.createDataFrame([("t:v0001",)], "vesicle_id string"), spark.createDataFrame([("t:v0001", 500.0)], "vesicle_id string, area double"))
    sinks.put_vesicle_summary(summary, f"{tmp_path}/vesicles.json")
    assert records.read_json(spark, f"{tmp_path}/vesicles.json", records.VESICLE).first() == ("t:v0001", "t", 1, 500.0, 2.0)


def test_documents_are_written_by_tasks(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Frame
    from voxframe.sources.documents import put_document

    def no(*_, **__):
        raise AssertionError("rows came to the driver")

    df = spark.range(5000).repartition(7)
    particles = df.select(
        F.format_string("p%06d", "id").alias("particle_id"), F.lit('t"\\n\u00e9').alias("tomogram_id"), *((F.col("id") / k).alias(c) for k, c in ((3, "x"), (7, "y"), (9, "z"))),
        F.when(F.col("id") % 2 == 0, F.struct(*(F.lit(v).alias(c) for v, c in zip((1.0, 0.0, 0.0, 0.0), "wxyz")))).alias("orientation"), F.lit("A").alias("half_set"),
    )
    with monkeypatch.context() as m:
        m.setattr(Frame, "toLocalIterator", no)
        sinks.put_particle_set(particles, f"{tmp_path}/set.json", "union", ["b", "a"])
        sinks.put_star(particles, f"{tmp_path}/set.star")
        sinks.put_rows(particles.limit(0), f"{tmp_path}/none.json")
    whole = json.loads((tmp_path / "set.json").read_text())
    assert (whole["consensus_rule"], whole["contributing_pickers"]) == ("union", ["a", "b"])
    assert [r["particle_id"] for r in whole["particles"]] == [f"p{k:06d}" for k in range(5000)]
    assert all(r["position"] == [k / 3, k / 7, k / 9] and r["vesicle_id"] is None and r["tomogram_id"] == 't"\\n\u00e9' for k, r in enumerate(whole["particles"]))
    assert json.loads((tmp_path / "none.json").read_text()) == []
    lines = (tmp_path / "set.star").read_text().splitlines()
    assert lines[:4] == ["", "data_particles", "", "loop_"] and lines[4:12] == [f"_{c} #{k}" for k, c in enumerate(sinks.star_rows(particles).columns, 1)]
    assert [x.split()[-1] for x in lines[12:]] == [f"p{k:06d}" for k in range(5000)] and lines[13].split()[1:4] == ["0.333333", "0.142857", "0.111111"]
    assert lines[12].split()[4:7] == lines[13].split()[4:7] == ["0.000000"] * 3  # an upright particle, and one without an orientation
    # a job that fails leaves the document of before and no parts
    with pytest.raises(Exception, match="no"):
        put_document(df, F.when(F.col("id") == 4000, F.raise_error(F.lit("no"))).otherwise("x"), f"{tmp_path}/set.star")
    assert (tmp_path / "set.star").read_text().splitlines() == lines and sorted(p.name for p in tmp_path.iterdir()) == ["none.json", "set.json", "set.star"]


def test_a_review_goes_on(spark, data, picked, tmp_path):
    sinks.put_particle_set(picked[0], f"{tmp_path}/set.json", "union", ["native"])
    particles, volumes, review = load_review(spark, f"{tmp_path}/set.json", f"{data}/seg", f"{data}/tomo", str(tmp_path))
    assert review.rejected.count() == 0 and volumes.where("segmentation_path is not null and raw_tomogram_path is null").count() == volumes.count()
    review.toggle(particles.orderBy("particle_id").limit(2).select("particle_id"))
    save_review(review, particles, str(tmp_path), "union", ["native"])
    assert records.read_particles(spark, f"{tmp_path}/particle_set.filtered.json").count() == particles.count() - 2
    again = load_review(spark, f"{tmp_path}/set.json", folder=str(tmp_path))[2]
    assert {r[0] for r in again.rejected.collect()} == {"p000000", "p000001"}
    again.reset(again.rejected)
    save_review(again, particles, str(tmp_path))
    assert records.read_rejected(spark, str(tmp_path)).count() == 0


def test_work_goes_on_where_it_stopped(spark, tmp_path):
    work = spark.createDataFrame([(f"t{k}", k) for k in range(7)], "tomogram_id string, n int")
    done = []

    def make(rows):
        names = sorted(r[0] for r in rows.select("tomogram_id").collect())
        if "t4" in names and "t4" not in done and len(done) < 5:
            done.append("t4")
            raise RuntimeError("lost")
        done.extend(names)
        return rows

    go = lambda settings: resumed(work, "tomogram_id", f"{tmp_path}/out", settings, make, 2)
    with pytest.raises(RuntimeError):
        go({"a": 1})
    assert done == ["t0", "t1", "t2", "t3", "t4"]
    assert sorted(r.n for r in go({"a": 1}).collect()) == list(range(7)) and done[5:] == ["t4", "t5", "t6"]
    assert sorted(r.n for r in go({"a": 1}).collect()) == list(range(7)) and len(done) == 8
    assert go({"a": 2}).count() == 7 and len(done) == 15
    assert resumed(work.limit(0), "tomogram_id", f"{tmp_path}/none", {}, lambda rows: rows).count() == 0


def test_only_what_changed_is_made_again(spark, tmp_path):
    from voxframe.plans.state import ContentCache, content_digests

    calls = []

    def go(rows, settings=None, size=2, fail=None):
        df = spark.createDataFrame(rows, "t string, id int, x double")

        def make(units):
            names = sorted(r[0] for r in units.select("t").collect())
            if fail in names:
                raise RuntimeError("lost")
            calls.extend(names)
            return df.join(units.select("t"), "t").where("x <> 0").groupBy("t").agg(F.sum("x").alias("total"))

        cache = ContentCache(spark, f"{tmp_path}/c", ["t"])
        out = cache.results(content_digests(df, ["t"], F.col("id"), F.col("x")), settings or {}, make, size)
        made, calls[:] = sorted(calls), []
        return {r.t: r.total for r in out.collect()}, made

    rows = [(f"t{k}", i, float(k)) for k in range(5) for i in range(3)]
    want = {f"t{k}": 3.0 * k for k in range(1, 5)}  # t0 gives no row, and counts as made all the same
    with pytest.raises(RuntimeError):
        go(rows, fail="t3")
    calls[:] = []
    rest = go(rows)
    assert rest[0] == want and "t3" in rest[1]
    assert go(rows[::-1]) == (want, [])
    assert go([*rows, ("t2", 9, 1.0)]) == (want | {"t2": 7.0}, ["t2"])
    assert go([r for r in rows if r[0] != "t4"])[0] == {k: v for k, v in want.items() if k != "t4"}
    assert go([(t, i, None if (t, i) == ("t1", 0) else x) for t, i, x in rows])[0]["t1"] == 2.0
    assert go(rows, {"a": 1}) == (want, [f"t{k}" for k in range(5)])
    # parts without a unit that counts are gone
    assert len(list((tmp_path / "c").glob("*.done"))) == len([p for p in (tmp_path / "c").iterdir() if p.is_dir()]) <= 3
    assert go([])[0] == {}
    with pytest.raises(Exception, match="no name"):
        go([(None, 1, 1.0)])
    # rows that come twice, and nulls, make a difference
    digest = lambda *own: content_digests(spark.createDataFrame([("t", *r) for r in own], "t string, a string, b string"), ["t"], F.col("a"), F.col("b")).first().digest
    kinds = [digest(*own) for own in ([("a", None)], [(None, "a")], [("a", "")], [("a", None)] * 2, [("a", None), (None, "a")])]
    assert len(set(kinds)) == 5 and digest(("x", "y"), ("z", "w")) == digest(("z", "w"), ("x", "y"))


def test_scores_by_neighbours_and_vesicles():
    rng = np.random.default_rng(3)
    points, x = rng.uniform(0, 30, (150, 3)), rng.normal(size=150)
    got, few = by_hand.by_neighbours(x, points, 7.0, 6)
    mad = lambda v: 1.4826 * np.median(np.abs(v - np.median(v)))
    for i in range(150):
        near = x[((points - points[i]) ** 2).sum(axis=1) <= 49]
        own = (np.median(near), mad(near) or mad(x)) if len(near) >= 6 else (np.median(x), mad(x))
        assert few[i] == (len(near) < 6) and np.isclose(got[i], (x[i] - own[0]) / own[1])
    assert few.any() and not few.all()
    groups = np.array(["", "a", "b"], object)[rng.integers(0, 3, 150)]
    got, fell = by_hand.by_vesicle(x, groups)
    assert np.array_equal(fell, groups == "") and np.allclose(got[groups == "a"], by_hand.robust(x[groups == "a"])) and np.allclose(got[fell], by_hand.robust(x)[fell])
    offsets = np.linspace(20, 50, 5)
    own = np.exp(-0.5 * ((offsets - 35) / 7.5) ** 2)
    assert np.isclose(np.corrcoef(by_hand.profile_shape(20, 50, 5, None), own)[0, 1], 1)
    with pytest.raises(ValueError):
        pick.PickSettings(windows=[(50.0, 20.0)])
    assert pick.PickSettings(windows=[(20.0, 20.0)], normalisation="local").margin_angstrom == 20


def matrix_linkage(points, threshold):
    """Complete linkage from a matrix of all distances."""
    labels, d = np.arange(len(points)), np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    while d.min() < threshold:
        i, j = sorted(divmod(int(np.argmin(d)), len(points)))
        labels[labels == j] = i
        d[i] = d[:, i] = np.maximum(d[i], d[j])
        d[i, i] = np.inf
        d[j] = d[:, j] = np.inf
    return labels


def test_linkage_by_chains_is_that_of_the_matrix():
    from voxframe.kernels.cluster import complete_linkage

    rng = np.random.default_rng(1)
    for k in range(120):
        points = rng.uniform(0, 10, (rng.integers(2, 60), rng.integers(1, 4)))
        if k % 3 == 0:
            points = np.concatenate([points, points[:4], points[:2]])
        threshold = rng.uniform(0.1, 9)
        assert np.array_equal(matrix_linkage(points, threshold), complete_linkage(points, threshold))
    assert complete_linkage(np.zeros((0, 3)), 1.0).tolist() == [] and complete_linkage(np.zeros((3, 3)), 0.0).tolist() == [0, 1, 2]


def test_linkage_holds_no_matrix():
    import tracemalloc

    from voxframe.kernels import cluster

    points = np.random.default_rng(2).uniform(0, 150, (8000, 3))
    hot = np.concatenate([points, np.tile(points[:1], (20_000, 1)), points[1] + np.random.default_rng(3).normal(0, 0.2, (500, 3))])
    tracemalloc.start()
    labels = cluster.complete_linkage(hot, 6.0)
    assert tracemalloc.get_traced_memory()[1] < 100e6 and len(set(labels[8000:28000])) == 1
    tracemalloc.stop()


def test_picks_are_joined_as_by_hand(spark):
    """Complete linkage, representatives and consensus over two tomograms and those without one; pickers number their picks alike."""
    from voxframe.operators.grouping import reconcile

    rng = np.random.default_rng(5)
    rows = [(t, i // 3, *map(float, rng.uniform(0, 12, 3)), f"p{i % 3}", float(i) if i % 4 else None, f"{t} {i}") for t in ("t1", "t2", None) for i in range(60)]
    df = spark.createDataFrame(rows, "tomogram_id string, idx long, x double, y double, z double, picker string, confidence double, mark string").repartition(5)
    for rule, least in (("union", 1), ("intersection", 3)):
        want = {}
        for t in ("t1", "t2", None):
            own = sorted((r for r in rows if r[0] == t), key=lambda r: (r[5], r[1]))
            labels = matrix_linkage(np.array([r[2:5] for r in own]), 5.0)
            for g in set(labels):
                best = []
                for p in ("p0", "p1", "p2"):
                    members = [r for r, k in zip(own, labels, strict=True) if k == g and r[5] == p]
                    if members:
                        mean = np.mean([m[2:5] for m in members], axis=0)
                        best.append(min(members, key=lambda m: (((np.array(m[2:5]) - mean) ** 2).sum(), m[1])))
                if len(best) >= least:
                    known, centre = [b[6] for b in best if b[6] is not None], np.mean([b[2:5] for b in best], axis=0)
                    near = min(best, key=lambda b: (((np.array(b[2:5]) - centre) ** 2).sum(), b[5]))
                    want[t, own[g][5], own[g][1]] = (*centre, "+".join(b[5] for b in best), np.mean(known) if known else None, len(best), near[7])
        got = {(r.tomogram_id, r.group_id.picker, r.group_id.idx): r for r in reconcile(df, 5.0, rule, 3, ("mark",)).collect()}
        assert set(got) == set(want) and want
        for k, (x, y, z, sources, confidence, n, mark) in want.items():
            r = got[k]
            assert np.allclose((r.x, r.y, r.z), (x, y, z)) and (r.sources, r.n_pickers, r.mark) == (sources, n, mark)
            assert r.confidence == confidence or np.isclose(r.confidence, confidence)


PICKS = "tomogram_id string, picker string, idx long, x double, y double, z double, score double, orientation string, beam_angle double, vesicle_id string"


def test_two_pickers_agree_on_two_places(spark):
    """Each picker numbers its picks from 0."""
    rows = [("t", "a", 0, 0.0, 0.0, 0.0, 1.0, "a0", 1.0, "va0"), ("t", "a", 1, 100.0, 0.0, 0.0, 2.0, "a1", 2.0, "va1"), ("t", "b", 0, 100.5, 0.0, 0.0, 3.0, "b0", 3.0, "vb0"), ("t", "b", 1, 0.5, 0.0, 0.0, 4.0, "b1", 4.0, "vb1")]
    found = sorted((r.x, r.source_picker, r.confidence, r.orientation, r.vesicle_id) for r in pick.particle_set(spark.createDataFrame(rows, PICKS), 5.0, "intersection", 2).collect())
    assert found == [(0.25, "a+b", 2.5, "a0", "va0"), (100.25, "a+b", 2.5, "a1", "va1")]


def test_a_particle_is_that_of_its_representative(spark):
    rows = [("t", "a", k, x, 0.0, 0.0, float(k + 1), f"q{k}", 10.0 * k, f"v{k}") for k, x in enumerate((0.0, 1.9, 3.9))]
    (r,) = pick.particle_set(spark.createDataFrame(rows, PICKS), 5.0).collect()
    assert (r.x, r.confidence, r.orientation, r.beam_angle, r.vesicle_id, r.particle_id) == (1.9, 2.0, "q1", 10.0, "v1", "p000000")


def test_groups_are_told_apart(spark):
    """Suppression where groups number their rows alike; statistics where rows have no group, and of each group's own."""
    from voxframe.operators.aggregates import normalise_by_vesicle, normalise_locally, robust_normalise
    from voxframe.operators.grouping import suppress

    rows = [("a", 0, 0.0, 1.0), ("a", 1, 1.0, 2.0), ("b", 0, 0.0, 1.0), ("b", 1, 50.0, 2.0), (None, 0, 0.0, 3.0), (None, 1, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "g string, k int, x double, s double").withColumn("y", F.lit(0.0))
    kept = {(r.g, r.k) for r in suppress(df, ["g"], ["x", "y"], "s", "k", 5.0).collect()}
    assert kept == {("a", 1), ("b", 0), ("b", 1), (None, 0)}

    rows = [(t, k, v, 100.0 * k, g) for t, base in (("t0", 0.0), ("t1", 1000.0), (None, 5.0)) for k, (v, g) in enumerate(((base, "v"), (base + 1, ""), (base + 2, None)))]
    df = spark.createDataFrame(rows, "t string, k int, v double, x double, g string").repartition(3)
    own = 1 / 1.4826
    expected = {(t, k): (k - 1) * own for t in ("t0", "t1", None) for k in range(3)}
    for z in (robust_normalise(df, "v", ["t"]), normalise_locally(df, "v", ["x"], 5.0, 2, "k", ["t"])):
        got = {(r.t, r.k): r.z for r in z.collect()}
        assert got.keys() == expected.keys() and all(np.isclose(got[k], expected[k]) for k in got)
    got = {(r.t, r.k): (r.z, r.fell_back) for r in normalise_by_vesicle(df, "v", "g", by=["t"]).collect()}
    assert got == {(t, k): (0.0, False) if k == 0 else (pytest.approx((k - 1) * own), True) for t in ("t0", "t1", None) for k in range(3)}


@pytest.fixture(scope="module")
def curved(tmp_path_factory):
    """Two tomograms of different shapes with labelled shells, dips beside them, and one without a membrane."""
    root, rng = tmp_path_factory.mktemp("curved"), np.random.default_rng(11)
    for k, shape in enumerate(((36, 40, 38), (34, 36, 60), (20, 20, 20))):
        grid = np.indices(shape).astype(float)
        tomo, seg, labels = rng.normal(size=shape), np.zeros(shape), np.zeros(shape)
        for v, centre in enumerate(((18, 20, 18), (22, 24, 40))[: 2 - k] if k < 2 else ()):
            r = np.sqrt(sum((g - c) ** 2 for g, c in zip(grid, centre, strict=True)))
            shell = np.abs(r - 9) <= 1
            seg[shell], labels[r <= 11] = 1, v + 1
            for way in ((0, 0, 1), (0, 1, 0), (1, 0, 0)):
                at = np.array(centre) + 13 * np.array(way)
                tomo[tuple(slice(max(0, int(a) - 1), int(a) + 2) for a in at)] = -9
        for name, volume in (("seg", seg), ("tomo", tomo), ("labels", labels)):
            (root / name).mkdir(exist_ok=True)
            mrc.write_volume(str(root / name / (f"c{k}_mask.mrc" if name == "seg" else f"c{k}_mask_labelled.mrc" if name == "labels" else f"c{k}.mrc")), volume, 10.0)
    return root


@pytest.mark.parametrize(("normalisation", "mode", "labelled"), [("global", "mean", False), ("local", "profile", False), ("vesicle", "mean", True)])
def test_slabs_give_what_whole_volumes_give(spark, curved, monkeypatch, normalisation, mode, labelled):
    from voxframe.operators.joins import labels_for
    from voxframe.plans import slabs

    monkeypatch.setattr(slabs, "SLAB_BYTES", 4 * 52 * 60 * 5)  # five planes
    monkeypatch.setattr(slabs, "POINTS", 300)
    s = pick.PickSettings(windows=[(20.0, 50.0), (30.0, 60.0)], n_mad=2.0 if mode == "mean" else 0.5, separation_angstrom=45.0, spacing_angstrom=15.0 if mode == "mean" else 25.0, boundary_margin_angstrom=30.0, normalisation=normalisation, mode=mode, local_radius_angstrom=50.0, min_local_neighbours=20)
    found = mrc.manifests(spark, f"{curved}/seg", f"{curved}/tomo")[0]
    if labelled:
        found = labels_for(found, mrc.volumes(spark, f"{curved}/labels", voxels=False).select("stem", F.col("path").alias("label_path"))).drop("stem")
    got = {}
    for r in slabs.scored(found, s).collect():
        got[r.tomogram_id, r.x, r.y, r.z, round(r.nx, 6), round(r.ny, 6), round(r.nz, 6)] = r
    want = {}
    for k in range(2):
        tomo, seg, labels = (mrc.read_volume(f"{curved}/{x}") for x in (f"tomo/c{k}.mrc", f"seg/c{k}_mask.mrc", f"labels/c{k}_mask_labelled.mrc"))
        for r in by_hand.score_surface(tomo, seg, 10.0, s, labels if labelled else None, f"c{k}_mask").itertuples():
            want[r.tomogram_id, r.x, r.y, r.z, round(r.nx, 6), round(r.ny, 6), round(r.nz, 6)] = r
    assert got.keys() == want.keys() and len(want) > 300
    for key, w in want.items():
        g = got[key]
        assert np.allclose((g.score, g.mean_score, g.profile_score), (w.score, w.mean_score, w.profile_score), atol=1e-9), key
        assert (g.window, g.vesicle_id, g.fell_back, g.kept) == (w.window, w.vesicle_id, w.fell_back, w.kept), key
    assert 0 < sum(r.kept for r in got.values()) < len(got) / 4
    for name in ("c0_mask", "c1_mask"):  # ties go by idx, so it rises as by hand
        ids = [[key for key, _ in sorted(((k, getattr(r, "idx")) for k, r in rows.items() if k[0] == name), key=lambda x: x[1])] for rows in (got, want)]
        assert ids[0] == ids[1]


def test_background_median_is_exact(spark, curved, monkeypatch):
    from voxframe.plans import slabs

    monkeypatch.setattr(slabs, "SLAB_BYTES", 4 * 52 * 60 * 3)
    shapes = slabs.shaped(mrc.manifests(spark, f"{curved}/seg", f"{curved}/tomo")[0])
    got = {r.tomogram_id: r.background for r in slabs.background_medians(slabs.in_slabs(shapes)).collect()}
    for k in range(3):
        tomo, seg = mrc.read_volume(f"{curved}/tomo/c{k}.mrc"), mrc.read_volume(f"{curved}/seg/c{k}_mask.mrc")
        assert got[f"c{k}_mask"] == float(np.median(tomo[seg <= 0]))
    values = np.array([-np.inf, -3.5, -0.0, 0.0, 1e-40, 2.0, np.inf], np.float32)
    assert (np.diff(slabs._sortable(values).astype(np.int64)) >= 0).all()


def test_areas_of_labelled_surfaces(spark, curved, tmp_path, monkeypatch):
    from voxframe.plans import slabs

    g = np.indices((60, 56, 50)) - np.array([28, 27, 24])[:, None, None, None]
    r = np.sqrt((g**2).sum(axis=0))
    smooth, label = np.clip((15.3 - r) / 5 + 0.5, 0, 1), np.where(r < 19, np.where(g[2] < 0, 1, 4), 0)
    triangles = V.surface_triangles(smooth)
    whole = V.triangle_areas(triangles).sum()
    assert abs(whole / (4 * np.pi * 15.3**2) - 1) < 0.02 and np.isclose(np.linalg.norm(triangles - (28, 27, 24), axis=2), 15.3, atol=0.1).all()
    assert len(V.surface_triangles(np.zeros((4, 4, 4)))) == 0
    assert np.isclose(V.triangle_areas(V.surface_triangles(np.repeat([0.0, 1.0], 3)[:, None, None] * np.ones((6, 5, 4)))).sum(), 12)
    for name, v in (("seg", smooth), ("raw", smooth), ("labels", label)):
        mrc.write_volume(f"{tmp_path}/{name}.mrc", v.astype(float), 2.0)
    m = spark.createDataFrame([("t", f"{tmp_path}/seg.mrc", f"{tmp_path}/raw.mrc", f"{tmp_path}/labels.mrc", 2.0), ("u", f"{tmp_path}/seg.mrc", f"{tmp_path}/raw.mrc", None, 2.0)], "tomogram_id string, segmentation_path string, raw_tomogram_path string, label_path string, voxel_size_angstrom double")
    monkeypatch.setattr(slabs, "SLAB_BYTES", 4 * 56 * 50 * 7)
    areas = {r.vesicle_id: r.area for r in slabs.surface_areas(m).collect()}
    assert areas.keys() == {"t:v0001", "t:v0004"} and np.isclose(sum(areas.values()), 4 * whole) and abs(areas["t:v0001"] / areas["t:v0004"] - 1) < 0.1


def test_heavy_rows_reach_many_tasks(spark, curved):
    """With adaptive execution on: small rows that are long work."""
    from voxframe.scratch import dealt

    cores = spark.sparkContext.defaultParallelism
    count = lambda df: len({r[0] for r in df.select(F.spark_partition_id()).collect()})
    units = spark.range(64).withColumn("cost", F.lit(1))
    assert count(dealt(units, F.col("cost"), ["id"], 1000)) == cores
    assert count(dealt(units, F.col("cost"), ["id"], 4)) == 16
    assert count(dealt(units.limit(2), F.col("cost"), ["id"], 1)) == 2 and dealt(units.limit(0), F.col("cost"), ["id"], 1).count() == 0
    # one tomogram has most rows: it is split, and rows stay in order
    skewed = spark.range(1000).select(F.when(F.col("id") < 900, "a").otherwise("b").alias("t"), "id", F.when(F.col("id") % 100 == 0, 50).otherwise(1).alias("cost"))
    parts = dealt(skewed, F.col("cost"), ["t", "id"], 150).select("*", F.spark_partition_id().alias("p")).collect()
    loads = {}
    for r in parts:
        loads[r.p] = loads.get(r.p, 0) + r.cost
    assert len(parts) == 1000 and max(loads.values()) <= 200 and len(loads) == 10
    assert [r.id for r in sorted(parts, key=lambda r: r.p)] == list(range(1000))
    particles = spark.range(400).select(F.format_string("p%03d", "id").alias("particle_id"), F.lit("c0_mask").alias("tomogram_id"), F.lit("A").alias("half_set"), F.lit("").alias("vesicle_id"), F.lit(20.0).alias("x"), F.lit(20.0).alias("y"), (F.col("id") / 10).alias("z"), F.struct(*(F.lit(v).alias(n) for n, v in zip("wxyz", (1.0, 0.0, 0.0, 0.0), strict=True))).alias("orientation"))
    boxes = classify.extract(particles, mrc.manifests(spark, f"{curved}/seg", f"{curved}/tomo")[0], 5, each=40)
    volume = mrc.read_volume(f"{curved}/tomo/c0.mrc")
    rows = {r.particle_id: r for r in boxes.collect()}
    kept = [r for r in rows.values() if r.kept]
    assert len(rows) == 400 and 250 < len(kept) < 400 and count(boxes.where("kept")) >= 8
    for r in kept[::37]:
        z = int(r.particle_id[1:]) / 10
        assert np.allclose(np.frombuffer(r.data, np.float32).reshape(5, 5, 5), V.extract_box(volume, np.array([20, 20, z]), np.array([1.0, 0, 0, 0]), 5), atol=1e-5)


def test_a_box_does_not_depend_on_the_others(spark, data, picked):
    found = mrc.manifests(spark, f"{data}/seg", f"{data}/tomo")[0]
    particles = picked[0].withColumn("z", F.col("z") + 0.3).withColumn("y", F.col("y") + 0.7)
    cut = lambda rows, **o: {r.particle_id: bytes(r.data) for r in classify.extract(rows, found, 9, **o).where("kept").collect()}
    all_of, alone = cut(particles), cut(particles, each=1)
    one = cut(particles.where("z > 20"))
    assert all_of == alone and one and all(all_of[k] == v for k, v in one.items())


def test_search_by_fourier_is_the_loop(spark):
    """Scores at all shifts, against shifting and correlating one by one."""
    rng = np.random.default_rng(12)
    for shape, reach in (((6, 7, 8), 3), ((9, 9, 9), 1), ((5, 5, 5), 0)):
        reference, candidate = rng.normal(size=shape), rng.normal(size=shape) + 5
        search = V.Shifted(reference, reach)
        found = search.correlations(candidate)
        for by in np.ndindex(*[2 * reach + 1] * 3):
            d = tuple(k - reach for k in by)
            padded = np.pad(candidate, reach)
            moved = padded[tuple(slice(reach - k, reach - k + n) for k, n in zip(d, shape, strict=True))]
            want = V.correlation(reference, moved, V.significant(reference))
            assert abs(found[by] - want) < 1e-9 and abs(search.exact(candidate, d) - want) < 1e-12
    assert not V.Shifted(reference, 1).correlations(np.zeros(shape)).any() and not V.Shifted(np.ones(shape), 1).correlations(candidate).any()
    box = rng.normal(size=(7, 7, 7))
    moved = V.shift(box, (1, -1, 0))
    assert V.fit_score(moved, box, turns=1, tilts=(0,), shifts=(-1, 0, 1)) > V.fit_score(moved, box, turns=1, tilts=(0,), shifts=(0,))


def test_suppression_in_rounds_is_the_greedy_one(spark):
    from voxframe.kernels.cluster import suppress as greedy
    from voxframe.operators.grouping import suppress

    rng = np.random.default_rng(6)
    points, score, group = rng.uniform(0, 12, (160, 3)), rng.integers(0, 9, 160).astype(float), rng.integers(0, 2, 160)
    df = spark.createDataFrame([(int(g), k, *map(float, p), float(s)) for k, (g, p, s) in enumerate(zip(group, points, score, strict=True))], "g int, k long, x double, y double, z double, s double")
    for by in (["g"], []):
        parts = [np.flatnonzero(group == g) for g in (0, 1)] if by else [np.arange(160)]
        want = sorted(int(p[i]) for p in parts for i in greedy(points[p], score[p], 3.0))
        assert sorted(r.k for r in suppress(df, by, ["x", "y", "z"], "s", "k", 3.0).collect()) == want
    assert suppress(df, [], ["x", "y", "z"], "s", "k", 0.0).count() == 160


def test_suppression_makes_no_pairs(spark, monkeypatch):
    """Of rows that share a place, no table has more rows than the input."""
    from voxframe.kernels.cluster import suppress as greedy
    from voxframe.operators import grouping

    made = []

    def counted(df, name, by=None, write=grouping.written):
        made.append(write(df, name, by))
        assert made[-1].count() <= 700, name
        return made[-1]

    monkeypatch.setattr(grouping, "written", counted)
    rng = np.random.default_rng(8)
    points, score = np.concatenate([rng.uniform(0, 6, (400, 3)), rng.normal(2, 1e-3, (200, 3)), np.full((100, 3), 4.0)]), rng.integers(0, 5, 700).astype(float)
    df = spark.createDataFrame([(k, *map(float, p), float(s)) for k, (p, s) in enumerate(zip(points, score, strict=True))], "k long, x double, y double, z double, s double")
    assert sorted(r.k for r in grouping.suppress(df, [], ["x", "y", "z"], "s", "k", 3.0).collect()) == greedy(points, score, 3.0).tolist()
    assert made


def test_suppression_over_tiles(spark, monkeypatch):
    """Small tiles and few rows of a cell at a time; groups, one of them without a name; chains through many tiles; lists that are copied."""
    from voxframe.kernels.cluster import suppress as greedy
    from voxframe.operators import grouping

    for name, value in (("FRONT", 2), ("TILE", 3), ("RIM", 2), ("DEALT", 100), ("TOGETHER", 3)):
        monkeypatch.setattr(grouping, name, value)
    rng = np.random.default_rng(9)
    points, group = rng.uniform(-12, 12, (260, 2)), rng.integers(0, 2, 260)
    points[:30] = np.stack([np.arange(30) * 1.5 - 22, np.zeros(30)], 1)
    score = np.concatenate([np.arange(30.0), np.floor(points[30:, 0] / 5)])
    df = spark.createDataFrame([("a" if g else None, k, *map(float, p), float(s)) for k, (g, p, s) in enumerate(zip(group, points, score, strict=True))], "g string, k long, x double, y double, s double")
    want = sorted(int(p[i]) for p in (np.flatnonzero(group == g) for g in (0, 1)) for i in greedy(points[p], score[p], 2.0))
    assert sorted(r.k for r in grouping.suppress(df, ["g"], ["x", "y"], "s", "k", 2.0).collect()) == want
    assert sorted(r.k for r in grouping.suppress(df, [], ["x", "y"], "s", "k", 2.0).collect()) == greedy(points, score, 2.0).tolist()


def test_suppression_of_rows_without_a_score_or_place(spark):
    """Rows without a score come last, as in SQL; those without a place are near to none; places far out."""
    from voxframe.operators.grouping import suppress

    nan, inf = float("nan"), float("inf")
    rows = [(0, 0.0, None), (1, 1.0, None), (2, 2.0, 1.0), (3, 10.0, None), (4, 11.0, None), (5, None, 5.0), (6, nan, 5.0), (7, inf, 5.0), (8, inf, 4.0), (9, 1e30, 1.0), (10, 1e30, 2.0), (11, -2e30, 0.0), (12, 20.0, nan), (13, 21.0, 7.0)]
    df = spark.createDataFrame(rows, "k int, x double, s double").withColumn("y", F.lit(0.0))
    assert sorted(r.k for r in suppress(df, [], ["x", "y"], "s", "k", 2.0).collect()) == [2, 3, 5, 6, 7, 8, 10, 11, 12]
    assert suppress(df.limit(0), [], ["x", "y"], "s", "k", 2.0).count() == 0


def test_each_tomogram_has_its_own_number_of_decoys(spark):
    scored = spark.createDataFrame([(t, k, float(10 * k), 0.0, 0.0, 0.01 * k) for t in ("t0", "t1", "t2") for k in range(40)], "tomogram_id string, idx long, x double, y double, z double, score double")
    real = scored.where("(tomogram_id = 't0' and idx < 6) or (tomogram_id = 't1' and idx in (5, 9))")
    found = {r.tomogram_id: (r.n, r.most) for r in D.from_rejected(scored, real, 0.35, 5.0).groupBy("tomogram_id").agg(F.count("*").alias("n"), F.max("idx").alias("most")).collect()}
    assert {t: n for t, (n, _) in found.items()} == {"t0": 6, "t1": 2, "t2": 1} and found["t2"][1] < 5
    assert {r["count"] for r in D.from_rejected(scored, real, 0.35, 5.0, 3).groupBy("tomogram_id").count().collect()} == {3}
    assert {r["count"] for r in D.from_rejected(scored, real, 0.35, 5.0, ratio=0.5).groupBy("tomogram_id").count().collect()} == {3, 1}


def test_nearest_of_a_crowd(spark):
    """Many rows within the radius: cells get narrow, and each row has its nearest, the first of those in one place."""
    from voxframe.operators import joins

    rng = np.random.default_rng(15)
    to, at = rng.normal(50, 10, (3000, 3)), rng.normal(50, 20, (60, 3))
    right = spark.createDataFrame([("t", *map(float, p), k) for k, p in enumerate(np.concatenate([to, to[:50]]))], "g string, x double, y double, z double, n long")
    left = spark.createDataFrame([("t", k, *map(float, p)) for k, p in enumerate(at)], "g string, k long, x double, y double, z double")
    assert joins.uncrowded_side(right.where("n < 3000").withColumn("_g", F.struct("g")), ["x", "y", "z"], 40.0) <= 10
    found = {r.k: r for r in joins.nearest(left, right, "k", ["x", "y", "z"], ["n"], 40.0, ["g"]).collect()}
    d = np.linalg.norm(at[:, None] - to[None], axis=2)
    assert [found[k].nearest_n for k in range(60)] == d.argmin(axis=1).tolist() and np.allclose([found[k].distance for k in range(60)], d.min(axis=1))
    apart = {r.k for r in joins.far_from(left, right, ["x", "y", "z"], 6.0, ["g"]).collect()}
    assert apart == set(np.flatnonzero(d.min(axis=1) >= 6).tolist()) and 0 < len(apart) < 60


def test_shifted_decoys_keep_to_their_own_volume(spark):
    rng = np.random.default_rng(8)
    picks = spark.createDataFrame([(t, f"{t}p{k}", *map(float, rng.uniform(5, s - 5, 3))) for t, s in (("t0", 30), ("t1", 60), ("t2", 60), ("t3", 60)) for k in range(12)], "tomogram_id string, particle_id string, x double, y double, z double")
    surface = [(t, float(x), float(y), s / 2, 0.0, 0.0, 1.0 + k) for k, (t, s) in enumerate((("t0", 30), ("t1", 60), ("t3", 60))) for x in range(0, s, 3) for y in range(0, s, 3)]
    shapes = spark.createDataFrame([("t0", 30, 30, 30), ("t1", 60, 60, 60), ("t2", 60, 60, 60)], "tomogram_id string, nz int, ny int, nx int")
    found = D.shifted(picks, spark.createDataFrame(surface, "tomogram_id string, x double, y double, z double, nx double, ny double, nz double"), shapes, "particle_id", 6.0, 14.0, 4.0, 5.0).collect()
    here = {t: np.array([r[2:] for r in picks.where(F.col("tomogram_id") == t).collect()]) for t in ("t0", "t1")}
    assert {r.tomogram_id for r in found} == {"t0", "t1"} and len(found) > 12 and len({r.particle_id for r in found}) == len(found)
    for r in found:
        at, side = np.array([r.x, r.y, r.z]), 29 if r.tomogram_id == "t0" else 59
        own = np.array([p[2:] for p in picks.where(F.col("particle_id") == r.particle_id).collect()])[0]
        assert (at >= 0).all() and (at <= side).all() and 6 <= np.linalg.norm(at - own) <= 14
        assert np.linalg.norm(here[r.tomogram_id] - at, axis=1).min() >= 5 and r.nz == (1 if r.tomogram_id == "t0" else 2)
        assert min(np.linalg.norm(np.array(s[1:4]) - at) for s in surface if s[0] == r.tomogram_id) >= 4
    assert D.shifted(picks, spark.createDataFrame(surface, "tomogram_id string, x double, y double, z double, nx double, ny double, nz double"), shapes, "particle_id", 6.0, 14.0, 400.0, 5.0).count() == 0


@pytest.mark.parametrize("name", ["k", "s"])
def test_density_clusters_over_blocks(spark, name):
    """The same labels as from all distances at once, with blocks of few rows, number and text keys."""
    from voxframe.kernels.cluster import density_clusters as at_once
    from voxframe.operators.grouping import cluster, density_clusters

    rng = np.random.default_rng(9)
    rows = np.concatenate([rng.normal(c, 0.5, (35, 2)) for c in ((0, 0), (6, 0), (0, 7))] + [rng.uniform(-4, 10, (15, 2))])
    df = spark.createDataFrame([(k, f"p{k:04d}", x.tolist()) for k, x in enumerate(rows)], "k long, s string, x array<double>").repartition(3)
    want = at_once(rows, 8)
    got = {r[0]: r.label for r in density_clusters(df, name, "x", 8, block=70).collect()}
    assert [got[k if name == "k" else f"p{k:04d}"] for k in range(120)] == want.tolist() and len(set(want)) >= 4
    with pytest.raises(ValueError):
        cluster(df.limit(5), "k", "x", "density", least_size=8)


def test_density_clusters_of_a_cloud(spark):
    """One cloud cut into blocks that all touch: the labels of all distances, and few rows are near enough to another block's box."""
    from voxframe.kernels.cluster import density_clusters as at_once
    from voxframe.operators.grouping import density_clusters, from_box

    rows = np.random.default_rng(13).normal(size=(600, 3))
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(rows)], "k long, x array<double>")
    got = {r.k: r.label for r in density_clusters(df, "k", "x", 5, block=150).collect()}
    assert [got[k] for k in range(600)] == at_once(rows, 5).tolist()
    low, high = np.array([0.5, -0.25, 0.0]), np.array([1.0, 0.25, 0.5])
    boxed = df.withColumns({"low": F.array(*map(F.lit, low.tolist())), "high": F.array(*map(F.lit, high.tolist()))})
    near = {r.k for r in boxed.where(from_box(3) <= 0.3).collect()}
    assert near == set(np.flatnonzero(np.linalg.norm(np.maximum(0, np.maximum(low - rows, rows - high)), axis=1) <= 0.3).tolist()) and len(near) < 150


def test_few_blocks_are_compared(spark):
    """Of clustered rows, pairs of blocks that are near enough grow with the blocks, not with their square."""
    from voxframe.operators.grouping import ball_pairs, balls, on_a_curve
    from voxframe.scratch import in_ranges

    rng, near = np.random.default_rng(10), {}
    for n in (20, 80):
        rows = np.concatenate([rng.normal(c, 1.0, (n * 5, 3)) for c in rng.uniform(-200, 200, (20, 3))])
        df = on_a_curve(spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(rows)], "k long, x array<double>"))
        blocks = balls(in_ranges(df, ["z", "k"], n).withColumnRenamed("_p", "i")).cache()
        pairs = ball_pairs(blocks, n)
        near[n] = pairs.where("least <= 2").count()
        bounds = {(r.i, r.j): (r.least, r.most) for r in pairs.collect()}
        where = {r.k: r._p for r in in_ranges(df, ["z", "k"], n).collect()}
        at = rng.integers(0, len(rows), (400, 2))
        for a, b in at:
            if where[a] != where[b]:
                low, high = bounds[where[a], where[b]]
                assert low <= np.linalg.norm(rows[a] - rows[b]) <= high
    assert near[80] < 0.5 * 16 * max(near[20], 80) and near[80] < 0.25 * 80 * 79


def test_k_means_over_partitions(spark, monkeypatch):
    """A fixed point of plain k-means, and the blobs it should find, with first centres from a few rows only."""
    from voxframe.operators import grouping

    monkeypatch.setattr(grouping, "SEEDS", 60)
    rng = np.random.default_rng(8)
    rows = np.concatenate([rng.normal(c, 0.4, (300, 3)) for c in ((0, 0, 0), (6, 0, 0), (0, 6, 1))])
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(rows)], "k long, x array<double>").repartition(6)
    got = {r.k: r.label for r in grouping.cluster(df, "k", "x", "kmeans", k=3).collect()}
    labels = np.array([got[k] for k in range(900)])
    centres = np.array([rows[labels == c].mean(axis=0) for c in range(3)])
    assert np.array_equal(((rows[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1), labels)
    assert all((labels[i : i + 300] == labels[i]).mean() > 0.99 for i in (0, 300, 600)) and len(set(labels)) == 3
    assert np.array_equal(np.lexsort(centres.T[::-1]), [0, 1, 2])
    halves = df.withColumn("h", F.when(F.col("k") % 2 == 0, "A").otherwise("B"))
    assert grouping.cluster(halves, "k", "x", "kmeans", "h", k=3).count() == 900
    assert "SinglePartition" not in grouping.cluster(df, "k", "x", "kmeans", k=3)._jdf.queryExecution().executedPlan().toString()
    assert grouping.cluster(df.limit(0), "k", "x", "kmeans", k=3).count() == 0
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(5)], "k long, x array<double>")
    assert {r.label for r in grouping.cluster(same, "k", "x", "kmeans", k=3).collect()} == {0}


def test_review(spark):
    particles = spark.createDataFrame([(f"p{k}", "t") for k in range(4)], "particle_id string, tomogram_id string")
    ids = lambda *k: spark.createDataFrame([(f"p{i}",) for i in k], "particle_id string")
    review = Review([particles.select("particle_id").limit(0)])
    review.toggle(ids(0, 1))
    review.toggle(ids(1, 2))
    assert {r[0] for r in review.rejected.collect()} == {"p0", "p2"}
    review.undo()
    assert {r[0] for r in review.rejected.collect()} == {"p0", "p1"}
    review.redo()
    accepted, rejected = review.saved(particles)
    assert (accepted.count(), rejected.count()) == (2, 2)
    review.reject(particles.select("particle_id"))
    with pytest.raises(ValueError):
        review.saved(particles)


def test_a_long_review_has_a_short_plan(spark, tmp_path):
    """Random operations with undo and redo against sets in plain Python; the plan doesn't grow, and a review goes on from its folder."""
    rng, size = np.random.default_rng(3), 12
    frame = lambda ids: spark.createDataFrame([(int(i),) for i in ids], "id long")
    operators = lambda r: sum(line.lstrip(" :+-*()0123456789").split(" ")[0].isalpha() for line in r.rejected._jdf.queryExecution().sparkPlan().toString().splitlines())
    review, states, at = Review([frame([1, 2])], "id", f"{tmp_path}/log"), [{1, 2}], 0
    plain = operators(review)
    for k in range(20):
        what, ids = rng.choice(["toggle", "toggle", "reject", "reset", "put", "undo", "redo"]), set(rng.choice(size, 4).tolist())
        if what in ("undo", "redo"):
            getattr(review, what)()
            at = max(0, at - 1) if what == "undo" else min(len(states) - 1, at + 1)
        else:
            getattr(review, what)(frame([*ids, *ids]))
            now = states[at]
            states[at + 1 :] = [{"toggle": now ^ ids, "reject": now | ids, "reset": now - ids, "put": ids}[what]]
            at += 1
        if k % 8 == 7:
            review = Review([], "id", f"{tmp_path}/log")
        assert {r[0] for r in review.rejected.collect()} == states[at], (k, what)
    assert len(states) > 5 and review.n > 5 and operators(review) == plain
    review.toggle(spark.createDataFrame([(None,), (99,)], "id long"))
    assert {r[0] for r in review.rejected.collect()} == states[at] | {99}
    # the rest of an operation that failed doesn't count
    frame([7777]).withColumn("rejected", F.lit(True)).write.parquet(f"{tmp_path}/log/op={review.at + 1}")
    assert {r[0] for r in Review([], "id", f"{tmp_path}/log").rejected.collect()} == states[at] | {99}
    with pytest.raises(ValueError):
        Review([], "id", f"{tmp_path}/none")


def test_state(tmp_path):
    assert not sync(f"{tmp_path}/s", {"a": 1})
    assert sync(f"{tmp_path}/s", {"a": 1})
    assert not sync(f"{tmp_path}/s", {"a": 2})
    state = RunState(str(tmp_path))
    assert state.planned(["pick", "classify"]) == [("real", "pick"), ("decoy", "pick"), ("real", "classify"), ("decoy", "classify")]
    for stage, folder in (("pick", "pick"), ("classify", "classify_real")):
        state.mark("real", stage)
        sinks.put_provenance(f"{tmp_path}/{folder}", stage, "native", {}, {})
    assert RunState(str(tmp_path)).planned(["pick", "classify"]) == [("decoy", "pick"), ("decoy", "classify")]
    assert job_graph(["pick", "classify"])[("real", "classify")] == [("real", "pick")]
    assert sinks.folder_digest(f"{tmp_path}/none") == "absent"


def test_checksums_and_provenance(tmp_path):
    from voxframe.plans import state

    file, cache = tmp_path / "a", f"{tmp_path}/cache.json"
    file.write_text("one")
    first = state.checksums([str(file)], cache)
    (tmp_path / "cache.json").write_text(json.dumps({str(file): [state.file_signature(str(file)), "known"]}))
    assert state.checksums([str(file)], cache) == {str(file): "known"} != first
    file.write_text("other")
    assert state.checksums([str(file)], cache)[str(file)] == state.file_sha256(str(file))
    (tmp_path / "cache.json").write_text("{")
    assert state.checksums([str(file)], cache)[str(file)] == state.file_sha256(str(file))
    assert state.symmetry(str(tmp_path)) == "Cinf_z"
    sinks.put_provenance(str(tmp_path), "classify", "native", {"align": str(True)}, {})
    assert state.provenance(str(tmp_path))["stage"] == "classify" and state.symmetry(str(tmp_path)) == "C1"
    tree = state.half_tree(str(tmp_path), "c00")
    assert state.half_map(tree["A"], str(tmp_path), "c00", "A") is None
    (tmp_path / "c00_halfA_n3.mrc").write_text("")
    assert state.half_map(tree["A"], str(tmp_path), "c00", "A").endswith("c00_halfA_n3.mrc")
    (tmp_path / "c00/halfA").mkdir(parents=True)
    (tmp_path / "c00/halfA/final.mrc").write_text("")
    assert state.half_map(tree["A"], str(tmp_path), "c00", "A").endswith("final.mrc")


def test_archive(tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.json").write_text("[]")
    made = sinks.archive(f"{tmp_path}/raw")
    assert made.endswith("raw.tar.gz") and not (tmp_path / "raw").exists()
    import tarfile

    assert "raw/a.json" in tarfile.open(made).getnames()


def test_voxels_that_are_no_cubes_are_told(spark, data, tmp_path):
    import shutil
    import struct

    shutil.copytree(f"{data}/tomo", f"{tmp_path}/tomo")
    path = tmp_path / "tomo/t00.mrc"
    raw = bytearray(path.read_bytes())
    struct.pack_into("<f", raw, 48, SIDE * 11.0)
    path.write_bytes(raw)
    with pytest.warns(UserWarning, match="t00"):
        mrc.manifests(spark, f"{data}/seg", f"{tmp_path}/tomo")


def test_half_of_one_tomogram_is_one_half(spark):
    from voxframe.operators.windows import split_halves

    out = split_halves(spark.createDataFrame([("t", 5)], "g string, n long"), "g", "n", F.md5(F.col("g").cast("binary")))
    assert [r.half_set for r in out.collect()] == ["A"]


def test_arrivals(spark, data, tmp_path):
    from voxframe.streaming.arrivals import pick_arrivals

    (tmp_path / "seg").mkdir()
    for k in (0, 1):
        (tmp_path / "seg" / f"t{k:02d}_mask.mrc").write_bytes((data / "seg" / f"t{k:02d}_mask.mrc").read_bytes())
        pick_arrivals(spark, f"{tmp_path}/seg", f"{data}/tomo", f"{tmp_path}/out", lambda m: m, f"arrivals-{tmp_path.name}").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_whole_run(spark, data, tmp_path):
    from voxframe.operators.preview import slice_at, slices, thinned
    from voxframe.plans.run import Run, RunSettings

    atom = "HETATM%5d  C   LIG A   1    %8.3f%8.3f%8.3f  1.00  0.00           C\n"
    (tmp_path / "small.pdb").write_text(atom % (1, 0, 0, 0))
    (tmp_path / "large.pdb").write_text("".join(atom % (k, 8 * k, 0, 0) for k in range(8)))
    (tmp_path / "panel.yaml").write_text("candidates:\n- {name: small, structure_path: small.pdb}\n- {name: large, structure_path: large.pdb}\n")
    (tmp_path / "run.toml").write_text(
        f'[run]\nsegmentation_dir = "{data}/seg"\nraw_tomogram_dir = "{data}/tomo"\noutput_dir = "out"\n'
        "[decoy]\nmin_distance_from_real_angstrom = 60.0\n[stage.pick]\nwindows = [[20.0, 60.0]]\nseparation_angstrom = 80.0\ndistance_threshold = 5.0\n"
        '[stage.classify]\nmethod = "kmeans"\nbox_angstrom = 90.0\nn_clusters = 1\nn_components = 3\nstrict_halfset_independence = false\ninplane_angular_step_degrees = 90.0\ninplane_iterations = 1\n'
        '[stage.identify]\ncandidates = "panel.yaml"\nresolution = 20.0\nsearch = {turns = 1, tilts = [0], shifts = [0]}\n'
    )
    settings = RunSettings.from_file(str(tmp_path / "run.toml"))
    run = Run(spark, settings)
    assert [x for x in run.go() if x[0] == "real"] == [("real", s) for s in ("pick", "classify", "identify", "refine")]
    assert (tmp_path / "out/report.md").read_text().startswith("# Run report")
    assert "separation_sigma" in (tmp_path / "out/identify/decoy_control.json").read_text()
    assert Run(spark, settings).go() == []
    assert Run(spark, settings).go(start="refine") == [("real", "refine")]
    out = tmp_path / "out"
    assert records.read_particles(spark, f"{out}/pick/particle_set.json").count() == run.table("real", "pick", "particles").count()
    assert records.read_assignments(spark, f"{out}/classify_real/class_assignments.json").select("cluster_id").distinct().count() == 1
    assert records.read_identification(spark, f"{out}/identify/identification.json").first().cluster_id == "c00"
    assert records.read_particles(spark, f"{out}/decoy/decoy_particle_set.json").where("source_picker <> 'decoy-rejected-surface'").count() == 0
    # what is there of an unfinished stage isn't made again
    made = {p: p.stat().st_mtime_ns for p in (out / "pick/scored").rglob("*.parquet")}
    run.state.done["real"].pop("pick")
    run.pick_real()
    assert made == {p: p.stat().st_mtime_ns for p in (out / "pick/scored").rglob("*.parquet")}
    # the content of each tomogram, class and pair tells what is made anew
    again = Run(spark, settings)
    for stage in (again.pick_real, again.pick_decoy, lambda: again.classify("real"), again.identify):
        stage()
    made = {(track, name): c.made for (track, _, name), c in again.caches.items()}
    assert made == {(t, n): 0 for t, n in (("real", "scored"), ("decoy", "points"), ("real", "boxes"), ("real", "features"), ("real", "turned"), ("real", "scores_real"), ("real", "scores_decoy"))}
    (tmp_path / "panel.yaml").write_text((tmp_path / "panel.yaml").read_text() + "- {name: third, structure_path: small.pdb}\n")
    os.utime(f"{data}/tomo/t02.mrc")
    for stage in (again.pick_real, lambda: again.classify("real"), again.identify):
        stage()
    made = {name: c.made for (track, _, name), c in again.caches.items() if track == "real"}
    assert made == {"scored": 1, "boxes": 1, "features": 1, "turned": 0, "scores_real": 1, "scores_decoy": 1}
    names = [p.name for p in (out / "classify_real/averages").glob("*.mrc")]
    assert len({n.split("_n")[0] for n in names}) == len(names)
    for method, more in (("shifted", {"decoy_least_shift_angstrom": 60.0, "decoy_most_shift_angstrom": 140.0}), ("synthetic-noise", {"noise_count": 2, "noise_shape": (24, 24, 24)})):
        other = Run(spark, replace(settings, decoy_method=method, decoy_pick_distance_angstrom=20.0, decoy_distance_angstrom=20.0, **more))
        other.pick_decoy()
        found = other.table("decoy", "pick", "particles")
        assert found.count() and found.where(F.col("source_picker") != f"decoy-{method}").count() == 0
    noise = records.read_json(spark, f"{out}/decoy/decoy_manifests.json", records.MANIFEST).collect()
    assert len(noise) == 2 and all(r.is_decoy and mrc.read_volume(r.raw_tomogram_path).shape == (24, 24, 24) for r in noise)
    with pytest.raises(ValueError):
        replace(settings, decoy_method="synthetic-noise", noise_count=None)
    rolled = out / "refine"
    assert any("_rlnAngle" in p.read_text() or p.read_text() for p in rolled.rglob("particles.star"))
    angles = {r.particle_id: r.inplane_angle_degrees for r in run.table("real", "classify", "angles").collect()}
    assert angles and all(a % 90 == 0 for a in angles.values())
    path = f"{data}/tomo/t00.mrc"
    assert slice_at(path, most=16).shape == (16, 16) and thinned(np.zeros((8, 8, 8)), 4).shape == (4, 4, 4)
    assert slices(mrc.volumes(spark, f"{data}/tomo", voxels=False)).count() == 4


DOCUMENTED = """
[run]
segmentation_dir = "data/seg"
raw_tomogram_dir = "data/tomo"
output_dir = "."
voxel_size_angstrom = ""
backend = "local"
stop_after = ""
[decoy]
enabled = true
method = "rejected-surface"
n_decoys_per_tomogram = 50
min_distance_from_real_angstrom = 100.0
min_distance_from_picks_angstrom = 60.0
min_shift_angstrom = 200.0
max_shift_angstrom = 600.0
n_synthetic_tomograms = 3
n_workers = 1
synthetic_shape_voxels = ""
[plots]
enabled = true
format = "tiff"
[stage.pick]
pickers = ["maker-native"]
consensus_rule = "intersection"
distance_threshold = 15.0
half_set_seed = 0
n_workers = 1
keep_raw = false
backend = ""
[stage.classify]
method = "hdbscan"
min_cluster_size = 20
n_clusters = 5
n_components = 20
box_angstrom = 300.0
n_radial_bins = 12
strict_halfset_independence = true
inplane_alignment = true
inplane_angular_step_degrees = 10.0
inplane_iterations = 3
random_state = 0
n_workers = 1
[stage.identify]
candidates = "data/candidates.yaml"
resolution = 25.0
fitter = "native"
fetch_missing = false
n_workers = 1
backend = ""
[stage.refine]
tool = "relion"
class_id = "all"
iterations = 5
mask = ""
backend = ""
"""


def test_the_documented_settings(tmp_path):
    from voxframe.plans.run import RunSettings

    def loaded(text):
        (tmp_path / "run.toml").write_text(text)
        return RunSettings.from_file(str(tmp_path / "run.toml"))

    s = loaded(DOCUMENTED)
    assert (s.segmentations, s.out, s.candidates) == (f"{tmp_path}/data/seg", f"{tmp_path}", f"{tmp_path}/data/candidates.yaml")
    assert replace(s, decoy_count=None) == RunSettings(s.segmentations, s.tomograms, s.out, candidates=s.candidates, resolution=25.0)  # the file states the defaults
    assert s.decoy_count == 50 and s.stages == ("pick", "classify", "identify", "refine")
    least = loaded('[run]\nsegmentation_dir = "a"\nraw_tomogram_dir = "b"\noutput_dir = "c"\nstop_after = "classify"\n')
    assert least.stages == ("pick", "classify") and least.rule == "intersection" and least.strict and least.align and least.method == "density"
    assert loaded(DOCUMENTED.replace('stop_after = ""', 'stop_after = "pick"').replace("resolution = 25.0", "")).stages == ("pick",)
    assert loaded(DOCUMENTED.replace('synthetic_shape_voxels = ""', "synthetic_shape_voxels = [8, 9, 10]")).noise_shape == (8, 9, 10)
    for old, new in (("resolution = 25.0", ""), ("tool =", "tools ="), ("[plots]", "[plot]"), ('"intersection"', '"both"'), ("maker-native", "maker-other"), ('stop_after = ""', 'stop_after = "end"'), ("[stage.refine]", "[stage.refinement]"), ('segmentation_dir = "data/seg"', ""), ("max_shift_angstrom = 600.0", "max_shift_angstrom = 6.0")):
        with pytest.raises(ValueError):
            loaded(DOCUMENTED.replace(old, new))


def test_components_with_a_large_offset(spark, monkeypatch):
    """From sums of 40 parts, far from the origin, against numpy; and of tables without rows."""
    from voxframe.kernels.cluster import pca
    from voxframe.operators import grouping

    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 5)) * (5, 3, 2, 1, 0.5) + 1e6
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "k long, x array<double>").repartition(40)
    want = pca(x, 3)[0]
    got = {r.k: r.scores for r in grouping.reduce(df, "k", "x", 3).collect()}
    assert np.allclose([got[k] for k in range(400)], want, atol=1e-6)
    n, mean, square = grouping.products(df, "x")
    assert n == 400 and np.allclose(mean, x.mean(axis=0), rtol=1e-14) and np.allclose(square / n, np.cov(x.T, bias=True), rtol=1e-9)
    empty = grouping.reduce(df.limit(0), "k", "x", 3)
    assert empty.count() == 0 and empty.columns == ["k", "scores"]
    with pytest.raises(ValueError):
        grouping.reduce(df.limit(2), "k", "x", 3)


def test_nearest_of_rows_far_away(spark):
    from voxframe.operators.joins import nearest

    rng = np.random.default_rng(7)
    right = np.concatenate([rng.normal(0, 20, (300, 2)), rng.normal(500, 5, (40, 2))])
    left = np.concatenate([rng.normal(0, 20, (60, 2)), rng.uniform(-3000, 3000, (12, 2)), [[1e7, -3.0], [-1e7, 1e7]]])
    frame = lambda a, name: spark.createDataFrame([("a" if k % 5 else None, k, *map(float, v)) for k, v in enumerate(a)], f"g string, {name} long, x double, y double")
    for by, same in (([], lambda i, j: True), (["g"], lambda i, j: (i % 5 == 0) == (j % 5 == 0))):
        got = {r.i: (r.distance, r.nearest_j) for r in nearest(frame(left, "i"), frame(right, "j"), "i", ["x", "y"], ["j"], 4.0, by).collect()}
        for i, v in enumerate(left):
            d = {j: np.linalg.norm(w - v) for j, w in enumerate(right) if same(i, j)}
            best = min(d, key=lambda j: (d[j], j))
            assert np.isclose(got[i][0], d[best]) and (got[i][1] == best or np.isclose(d[got[i][1]], d[best], rtol=1e-12))
    assert nearest(frame(left, "i"), frame(right[:0], "j"), "i", ["x", "y"], ["j"], 4.0).count() == 0
