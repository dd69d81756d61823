import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxframe.kernels import cluster as K
from voxframe.kernels import signal as S
from voxframe.kernels import volume as V
from voxframe.operators import aggregates
from voxframe.operators.aggregates import decoy_control, mann_whitney_greater


def test_trilinear_is_exact_on_a_linear_field():
    z, y, x = np.indices((5, 6, 7)).astype(float)
    p = np.random.default_rng(0).uniform(0, 4, (50, 3))
    assert np.allclose(V.trilinear(z + 2 * y + 3 * x, p), p @ [1, 2, 3])
    assert V.trilinear(z, np.array([[-0.5, 0, 0]]), 7.0)[0] == 7.0
    assert V.trilinear(z, np.array([[9.0, 0, 0]]))[0] == 4.0


def test_quarter_turn():
    v = np.random.default_rng(1).random((7, 7, 7))
    turned = V.turn(v, 90)
    assert np.allclose(turned, np.rot90(v, 1, (0, 1))) or np.allclose(turned, np.rot90(v, -1, (0, 1)))
    assert np.array_equal(V.turn(v, 0), v)


def test_gaussian_keeps_the_sum():
    v = np.zeros((15, 15, 15))
    v[7, 7, 7] = 1
    assert np.isclose(V.gaussian(v, 1.5).sum(), 1)


def test_sphere_surface():
    g = np.indices((40, 40, 40)) - 19.5
    p, n = V.surface((np.sqrt((g**2).sum(axis=0)) < 12).astype(float))
    r = np.linalg.norm(p - 19.5, axis=1)
    assert abs(r.mean() - 12) < 0.5
    assert ((n * (p - 19.5)).sum(axis=1) / r > 0.7).all()
    with pytest.raises(ValueError):
        V.surface(np.zeros((4, 4, 4)))


def test_complete_linkage_by_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(20):
        p = rng.random((12, 2)) * 4
        labels = K.complete_linkage(p, 1.5)
        groups = [np.flatnonzero(labels == k) for k in np.unique(labels)]
        far = lambda a, b: max(np.linalg.norm(p[i] - p[j]) for i in a for j in b)
        assert all(far(g, g) < 1.5 for g in groups)
        assert all(far(a, b) >= 1.5 for a, b in itertools.combinations(groups, 2))
    assert len(set(K.complete_linkage(np.array([[0.0], [1.0], [2.0]]), 1.0))) == 3  # strictly below


def test_suppression():
    p, s = np.random.default_rng(3).random((60, 3)) * 10, np.random.default_rng(4).random(60)
    kept = K.suppress(p, s, 2.0)
    assert all(np.linalg.norm(p[i] - p[j]) > 2 for i, j in itertools.combinations(kept, 2))
    assert all(any(np.linalg.norm(p[i] - p[j]) <= 2 and s[j] >= s[i] for j in kept) for i in range(60))
    assert len(K.suppress(p, s, 0)) == 60


def test_surely_kept():
    """All that is kept where a tile has all rows; never more where some are missing."""
    rng = np.random.default_rng(10)
    p, s, d = rng.uniform(0, 12, (600, 2)), rng.integers(0, 6, 600), 2.0
    p, cell = (x[np.lexsort((np.arange(600), -s))] for x in (p, np.floor(p / (d / 2**0.5)).astype(int) + 4))
    names, own = np.unique(cell @ [100, 1], return_inverse=True)
    low, high = (np.array([f(p[own == c], axis=0) for c in range(len(names))])[own] for f in (np.min, np.max))
    want = K.suppress(p, -np.arange(600.0), d)
    decide = lambda some, more, wide: np.flatnonzero(some)[K.surely_kept(np.zeros(some.sum(), int), cell[some], p[some], low[some], high[some], more[some], wide, 2, d)]
    every = np.ones(600, bool)
    assert decide(every, ~every, 17).tolist() == want.tolist()
    rank = np.array([(own[:k] == own[k]).sum() for k in range(600)])
    first = decide(rank < 2, np.bincount(own)[own] > 2, 17)
    assert 0 < len(first) < len(want) and set(first) <= set(want)
    inside = (cell < 10).all(axis=1)
    part = decide(inside, ~every, 10)
    assert 0 < len(part) and set(part) <= set(want)


def blobs():
    rng = np.random.default_rng(5)
    return np.concatenate([rng.normal(c, 0.3, (40, 2)) for c in ((0, 0), (8, 0), (0, 8))])


def test_clusters_find_three_blobs():
    for labels in (K.density_clusters(blobs(), 10),):
        parts = [labels[k * 40 : (k + 1) * 40] for k in range(3)]
        tops = [np.bincount(p[p >= 0]).argmax() for p in parts]
        assert len(set(tops)) == 3 and all((p == t).mean() > 0.8 for p, t in zip(parts, tops, strict=True))
    with pytest.raises(ValueError):
        K.density_clusters(blobs()[:5], 10)


def test_pca():
    scores, axes, share = K.pca(np.random.default_rng(6).random((30, 6)), 3)
    assert np.allclose(axes @ axes.T, np.eye(3)) and np.allclose(scores.mean(axis=0), 0) and share.sum() <= 1


def test_greedy_match():
    assert K.greedy_match([(1.0, 0, 0), (0.5, 1, 0), (2.0, 0, 1)]) == {1: 0, 0: 1}


def test_features_do_not_change_with_a_turn():
    v = V.gaussian(np.random.default_rng(7).random((15, 15, 15)), 1.5) * V.soft_sphere(15)
    a, b = S.features(v), S.features(V.turn(v, 90))
    assert np.corrcoef(a, b)[0, 1] > 0.98
    assert not S.features(np.zeros((9, 9, 9))).any()


def test_alignment_finds_the_turn():
    v = np.zeros((15, 15, 15))
    v[11, 7, 7] = v[11, 8, 7] = 1
    v = V.gaussian(v, 1.0)
    assert S.best_roll(V.turn(v, 50), v) in (310.0,)


def test_fsc_of_equal_and_unequal_maps():
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=(24, 24, 24)), rng.normal(size=(24, 24, 24))
    mask = V.soft_sphere(24)
    same = S.half_map_fsc(a, a, mask, 3.0)
    assert np.allclose(same["fsc_unmasked"][1:], 1) and not same["crossed"]
    apart = S.half_map_fsc(a + 0.5, b + 0.5, mask, 3.0)
    assert apart["resolution"] > same["resolution"] and apart["crossed"]
    # where shell 0 is below the threshold, that of the finest shell
    opposed = S.half_map_fsc(a + 0.5, b - 0.5, mask, 3.0)
    assert opposed["fsc_masked"][0] < 0 and opposed["resolution"] == same["resolution"] and not opposed["crossed"]


def test_soft_sphere_falls_to_nothing_at_its_radius():
    mask, mid = V.soft_sphere(23), 11
    for k in range(12):
        t = (k - (0.8 * 23 / 2 - 5)) / 5
        want = 1.0 if t <= 0 else 0.0 if t >= 1 else 0.5 * (1 + np.cos(np.pi * t))
        assert np.isclose(mask[mid + k, mid, mid], want) and np.isclose(mask[mid, mid - k, mid], want)
    assert mask[mid + 10, mid, mid] == 0 and abs(mask[mid + 7, mid, mid] - 0.41) < 0.01


def test_shells_cut_the_radius():
    n = 8
    for at in np.ndindex(n, n, n):
        r = int(np.sqrt(sum(((k + n // 2) % n - n // 2) ** 2 for k in at)))
        assert S.shells(n)[at] == (r if r < n // 2 else -1)


def test_correlation_without_the_mask():
    m, r = np.array([1.0, 0.9, 0.5, 0.2, -0.5]), np.array([0.2, 0.5, 0.6, 1.0, -0.9])
    assert np.allclose(S.without_mask(m, r), [min(max((a - b) / max(1 - b, 1e-3), -1), 1, a) for a, b in zip(m, r, strict=True)])


def test_rings_stay_inside_the_box():
    assert np.allclose(S.cylindrical(np.ones((9, 9, 9)), 12, 16), 1)
    assert S.annulus(9)[8, 4] and not S.annulus(9)[0, 0] and not S.annulus(9)[4, 4]


def test_splat_shares_weights_among_corners():
    rng = np.random.default_rng(3)
    points, weights = rng.uniform(-2, 7, (60, 3)), rng.random(60)
    want = np.zeros((5, 5, 5))
    for p, w in zip(points, weights, strict=True):
        for v in np.ndindex(5, 5, 5):
            want[v] += w * np.prod(np.maximum(0, 1 - np.abs(p - v)))
    assert np.allclose(V.splat(points, weights, 5), want)


def test_slab_lies_flat():
    rng = np.random.default_rng(4)
    points = rng.normal(size=(400, 3)) * [2, 9, 5]
    spun = points @ np.linalg.qr(rng.normal(size=(3, 3)))[0]
    flat = V.principal_slab(spun, np.ones(400))
    assert (np.argsort(flat.std(axis=0)) == [2, 1, 0]).all() and np.allclose(flat.mean(axis=0), 0)
    assert np.allclose(np.linalg.norm(flat, axis=1), np.linalg.norm(spun - spun.mean(axis=0), axis=1))


def test_surface_is_interpolated():
    ramp = np.zeros((4, 4, 6))
    ramp[:, :, 3:] = [0.2, 0.6, 1.0]
    p, _ = V.surface(ramp, 0.5)
    assert np.allclose(p[:, 2], 3.75) and np.allclose(V.surface(ramp, 0.3)[0][:, 2], 3.25)


def test_fit_prefers_the_right_shape():
    points = np.array([[x, 0.0, 0.0] for x in np.linspace(-9, 9, 19)])
    own = V.simulate_density(points, np.ones(19), 13, 3.0, 8.0)
    dot = V.simulate_density(np.zeros((1, 3)), np.ones(1), 13, 3.0, 8.0)
    few = {"turns": 2, "tilts": (0,), "shifts": (0,)}
    assert V.fit_score(own, own, **few) > 0.99 > V.fit_score(own, dot, **few)


def test_fit_turns_a_candidate_upside_down_and_by_small_tilts():
    points = np.array([[x, y, 9.0] for x in np.linspace(-12, 12, 9) for y in np.linspace(-12, 12, 9)] + [[0.0, 0.0, z] for z in np.linspace(-12, 6, 9)])
    own = V.gaussian(V.splat(points / 3 + 7, np.ones(len(points)), 15), 1.0)
    few = {"tilts": (0,), "shifts": (-1, 0, 1), "absolute": False}
    assert V.fit_score(own[:, :, ::-1], own, **few) > 0.999
    assert V.fit_score(V.turn(own, 6, (1, 2)), own, turns=1, shifts=(0,), absolute=False) > 0.999


def test_rank_test_by_enumeration():
    rng = np.random.default_rng(9)
    for n, m in itertools.product(range(2, 5), repeat=2):
        x = rng.permutation(n + m).astype(float)
        real, fake = x[:n].tolist(), x[n:].tolist()
        u = sum(a > b for a in real for b in fake)
        every = [sum(a > b for a in c for b in range(n + m) if b not in c) for c in itertools.combinations(range(n + m), n)]
        assert np.isclose(mann_whitney_greater(real, fake), np.mean([v >= u for v in every]))


def test_decoy_control():
    assert decoy_control([0.9, 0.8, 0.85, 0.95], [0.1, 0.12, 0.11, 0.13])["passed"]
    assert not decoy_control([0.2], [0.1, 0.3, 0.2])["passed"]
    assert decoy_control([0.9], [0.1])["separation_sigma"] == np.inf
    assert not decoy_control([], [0.1])["passed"]


def test_medians_and_rank_sums_hold_no_group(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(g, float(v)) for g, n in (("a", 501), ("b", 40), ("c", 2), ("d", 1)) for v in rng.integers(0, 60, n)] + [("a", None), ("e", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    monkeypatch.setattr(aggregates, "IN_A_TASK", 0)
    monkeypatch.setattr(F, "median", None)  # its buffer has every value of a group
    for by in (["g"], []):
        got = {r["g"] if by else "": r for r in aggregates.centre_and_scale(df, "v", by).collect()}
        for name, r in got.items():
            x = np.array([v for g, v in rows if v is not None and (not by or g == name)])
            if not len(x):
                assert (r.centre, r.scale) == (None, 0)
                continue
            mad = np.median(np.abs(x - np.median(x)))
            assert r.centre == np.median(x) and np.isclose(r.scale, aggregates.MAD_SCALE * mad if mad > 0 else x.std())
        assert len(got) == (5 if by else 1)
    scored = df.where("v is not null").withColumn("d", F.col("g") != "a")
    out = aggregates.control_statistics(scored, "v", F.col("d"))
    real, fake = ([v for g, v in rows if v is not None and (g == "a") == own] for own in (True, False))
    assert out.first().u == sum((r > f) + 0.5 * (r == f) for r in real for f in fake)
    assert "windowspecdefinition(s#" not in out._jdf.queryExecution().analyzed().toString()


def test_many_candidates_score_as_one_by_one():
    rng = np.random.default_rng(14)
    reference, candidates = rng.normal(size=(4, 4, 4)), rng.normal(size=(30, 4, 4, 4))
    candidates[3], candidates[4] = 0, np.flip(reference, 2)
    want = [V.fit_score(reference, c, turns=1, tilts=(0,), shifts=(-1, 0, 1)) for c in candidates]
    assert np.allclose(V.fit_scores(reference, candidates, (-1, 0, 1)), want, atol=1e-9) and want[3] == 0 and want[4] > 0.999
    assert not V.fit_scores(np.ones((4, 4, 4)), candidates, (-1, 0, 1)).any()


def test_linkage_looks_at_few_places(monkeypatch):
    """Rows in one dense cloud: most groups find their partners in narrow cells."""
    from voxframe.kernels import cluster

    seen, own = [], cluster._Around.of

    def counted(self, place):
        found = own(self, place)
        seen.append(len(found))
        return found

    monkeypatch.setattr(cluster._Around, "of", counted)
    labels = cluster.complete_linkage(np.random.default_rng(16).normal(50, 25, (1500, 3)), 25.0)
    assert len(set(labels)) > 50 and np.median(seen) < 100
