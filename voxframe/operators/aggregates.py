"""Robust normalisation, class averages, digests, histograms and control statistics."""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import before_ranges, discard, in_ranges, written

MAD_SCALE = 1.4826


def modal_value(df: DataFrame, value: Column, position: Column, digits: int = 3) -> DataFrame:
    """One row at most: the most frequent rounded value, nulls dropped; of ties, the one met first."""
    rounded = df.select(F.round(value, digits).alias("value"), position.alias("_at")).where("value is not null")
    return rounded.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("_at")).orderBy(F.desc("n"), "_at").limit(1).select("value", "n")


def medians(df: DataFrame, value: Column, by: list[str], out: str) -> DataFrame:
    """by and the median, nulls dropped.

    Counts by value go into ranges of (group, value); the ranges' sums tell which one or two of them have a group's
    middle, and only those are added up value by value. So no task holds a group.
    """
    counts = df.select(*by, value.cast("double").alias("_v")).where("_v is not null").groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranged = in_ranges(counts, [*by, "_v"])
    earlier = lambda c, keys, order: F.coalesce(F.sum(c).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    has_middle = lambda before, n: (before <= F.floor(F.col("_n") / 2)) & (before + F.col(n) > F.floor((F.col("_n") - 1) / 2))
    # a row for each range that a group is in
    sums = ranged.groupBy(*by, "_p").agg(F.sum("_c").alias("_s"))
    starts = sums.withColumn("_before", earlier("_s", by, "_p")).withColumn("_n", F.sum("_s").over(Window.partitionBy(*by)))
    middle = ranged.join(starts.where(has_middle(F.col("_before"), "_s")), [*by, "_p"])
    middle = middle.withColumn("_at", F.col("_before") + earlier("_c", [*by, "_p"], "_v")).where(has_middle(F.col("_at"), "_c"))
    return middle.groupBy(*by).agg((0.5 * F.min("_v") + 0.5 * F.max("_v")).alias(out))


#: Rows of a group whose values a task may hold; in larger groups medians come from ranges.
IN_A_TASK = 1_000_000


def centre_and_scale(df: DataFrame, x: str, by: list[str]) -> DataFrame:
    """median and scale of x for each group: 1.4826 MAD, else the population deviation, else 0. Without groups, one row.

    Rows without a group (null) are one. The largest group's size decides whether a grouped median holds a group's values, or ranges of
    values are written and counted. One row a group comes out.
    """
    rows = df.select(F.struct(F.lit(0).alias("_0"), *by).alias("_all"), F.col(x).cast("double").alias("_x"))  # a struct equals another with the same nulls
    off, spread = F.abs(F.col("_x") - F.col("centre")), F.stddev_pop("_x").alias("_std")
    if (rows.groupBy("_all").count().agg(F.max("count")).first()[0] or 0) <= IN_A_TASK:
        centre = rows.groupBy("_all").agg(spread, F.median("_x").alias("centre"))
        mad = _back(rows, centre, by).groupBy("_all").agg(F.first("centre").alias("centre"), F.first("_std").alias("_std"), F.median(off).alias("_mad"))
    else:
        std = written(rows.groupBy("_all").agg(spread), "spreads")
        centre = written(std.join(medians(rows, F.col("_x"), ["_all"], "centre"), "_all", "left"), "centres")
        mad = written(centre.join(medians(_back(rows, centre, by), off, ["_all"], "_mad"), "_all", "left"), "scales")
        discard(std, centre)
    scale = F.when(F.col("_mad") > 0, MAD_SCALE * F.col("_mad")).otherwise(F.coalesce("_std", F.lit(0.0)))
    return mad.select(*(F.col(f"_all.{c}").alias(c) for c in by), "centre", scale.alias("scale"))


def _back(rows: DataFrame, centre: DataFrame, by: list[str]) -> DataFrame:
    """rows with their group's statistics; without groups there is one key, so its row has to be sent to the others."""
    return rows.join(centre if by else F.broadcast(centre), "_all")


def _with_statistics(df: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    """df with its group's centre and scale; nulls are a group."""
    if not by:
        return df.crossJoin(F.broadcast(stats))
    keyed = stats.select(F.struct(*by).alias("_all"), "centre", "scale")
    return df.withColumn("_all", F.struct(*by)).join(keyed, "_all", "left").drop("_all")


def robust_normalise(df: DataFrame, x: str, by: list[str] | None = None, out: str = "z") -> DataFrame:
    """(x - median) / scale of each group; 0 where the scale is 0. All rows stay; those without a group are one.

    The statistics of the groups go back by a join; a window would hold a group in one task.
    """
    by = by or []
    joined = _with_statistics(df, centre_and_scale(df, x, by), by)
    return joined.withColumn(out, F.when(F.col("scale") == 0, F.lit(0.0)).otherwise((F.col(x) - F.col("centre")) / F.col("scale"))).drop("centre", "scale")


def normalise_by_vesicle(df: DataFrame, x: str, group: str, out: str = "z", by: list[str] | None = None) -> DataFrame:
    """Each group by its own estimate; rows without one (empty or null) by that of all rows (of their tomogram), and flagged `fell_back`."""
    by = by or []
    named = F.coalesce(F.col(group), F.lit("")) != ""
    own = centre_and_scale(df.where(named), x, [*by, group]).select(F.struct(*by, group).alias("_own"), F.col("centre").alias("_c"), F.col("scale").alias("_s"))
    joined = _with_statistics(df.withColumn("_own", F.struct(*by, group)).join(own, "_own", "left"), centre_and_scale(df, x, by), by)
    centre = F.when(named, F.col("_c")).otherwise(F.col("centre"))
    scale = F.when(named, F.col("_s")).otherwise(F.col("scale"))
    z = F.when(scale == 0, F.lit(0.0)).otherwise((F.col(x) - centre) / scale)
    return joined.withColumn(out, z).withColumn("fell_back", ~named).drop("_own", "_c", "_s", "centre", "scale")


def normalise_locally(points: DataFrame, x: str, xyz: list[str], radius: float, least: int, key: str = "idx", by: list[str] | None = None, out: str = "z") -> DataFrame:
    """By median and MAD of the neighbours within radius, itself included; with fewer than `least`, or with no spread, by all rows' (of
    the row's own group)."""
    from .joins import within

    by = by or []
    slim = points.select(*by, key, *xyz, x)
    near = within(slim, slim, xyz, radius, by).select(F.struct(*(F.col(f"l.{k}").alias(k) for k in [*by, key])).alias("_id"), F.col(f"r.{x}").alias("v"))
    own = near.groupBy("_id").agg(F.count(F.lit(1)).alias("n"), F.median("v").alias("m"))
    spread = near.join(own, "_id").groupBy("_id", "n", "m").agg((MAD_SCALE * F.median(F.abs(F.col("v") - F.col("m")))).alias("s"))
    joined = _with_statistics(points.withColumn("_id", F.struct(*by, key)).join(spread, "_id", "left"), centre_and_scale(points, x, by), by)
    scale = F.when(F.col("scale") == 0, F.lit(1.0)).otherwise(F.col("scale"))
    few = F.coalesce(F.col("n") < least, F.lit(True))
    z = F.when(few, (F.col(x) - F.col("centre")) / scale).otherwise((F.col(x) - F.col("m")) / F.when(F.col("s") > 0, F.col("s")).otherwise(scale))
    return joined.withColumn(out, z).withColumn("fell_back", few).drop("_id", "n", "m", "s", "centre", "scale")


def elementwise_mean(df: DataFrame, by: list[str], array: str) -> DataFrame:
    """n and mean array of each group; elements are summed apart, so a group's arrays are never gathered."""
    each = df.select(*by, F.posexplode(array).alias("pos", "v")).groupBy(*by, "pos").agg(F.avg(F.col("v").cast("double")).alias("m"), F.count(F.lit(1)).alias("n"))
    return each.groupBy(*by).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("a")).withColumn("mean", F.transform("a", lambda s: s["m"])).drop("a")


def joined_moments(a: tuple, b: tuple) -> tuple:
    """Number, mean and sum of squares about the mean of two sets together."""
    n, apart = a[0] + b[0], b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + apart * apart * (a[0] * b[0] / n)


def moments(df: DataFrame, group: str, array: str) -> DataFrame:
    """group, n, m, q: number, mean and sum of squares about it of each place of the arrays.

    Tasks join their own rows first, batch by batch, so a row for each task and group is all that moves. Sums of squares
    alone would lose small deviations.
    """
    kind = df.schema[group].dataType.simpleString()

    def own(batches):
        have: dict = {}
        for rows in batches:
            for name, some in rows.groupby(group, dropna=False):
                x = np.stack(some[array].to_numpy()).astype(float)
                now = len(x), x.mean(axis=0), ((x - x.mean(axis=0)) ** 2).sum(axis=0)
                name = None if pd.isna(name) else name
                have[name] = joined_moments(have[name], now) if name in have else now
        yield pd.DataFrame([(g, n, m.tolist(), q.tolist()) for g, (n, m, q) in have.items()], columns=[group, "n", "m", "q"])

    def add(key, rows: pd.DataFrame) -> pd.DataFrame:
        parts = [(r.n, np.array(r.m), np.array(r.q)) for r in rows.itertuples()]
        n, m, q = functools.reduce(joined_moments, parts)
        return pd.DataFrame([(key[0], n, m.tolist(), q.tolist())], columns=[group, "n", "m", "q"])

    form = f"{group} {kind}, n long, m array<double>, q array<double>"
    return df.select(group, array).mapInPandas(own, form).groupBy(group).applyInPandas(add, form)


def whole_moments(own: DataFrame, group: str) -> tuple[int, np.ndarray, np.ndarray] | None:
    """Number, mean and sum of squares of all groups together, from a row for each; none without rows.

    Tasks add up their own rows first; one row a task comes to the driver.
    """

    def add(batches):
        have = None
        for rows in batches:
            for r in rows.itertuples():
                now = r.n, np.array(r.m), np.array(r.q)
                have = joined_moments(have, now) if have else now
        if have:
            yield pd.DataFrame([(have[0], have[1].tolist(), have[2].tolist())], columns=["n", "m", "q"])

    parts = own.select("n", "m", "q").mapInPandas(add, "n long, m array<double>, q array<double>").collect()
    return functools.reduce(joined_moments, [(r.n, np.array(r.m), np.array(r.q)) for r in parts]) if parts else None


def class_averages(df: DataFrame, array: str, cluster: str = "cluster_id") -> DataFrame:
    return elementwise_mean(df.where(F.col(cluster) != "noise"), [cluster], array)


def directory_digest(df: DataFrame, name: Column, digest: Column, by: list[str]) -> DataFrame:
    """sha256 over the sorted lines name:digest of each group, and how many there are."""
    line = F.concat(name, F.lit(":"), digest)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_files"), F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n").cast("binary"), 256).alias("digest"))


def closed_histogram(df: DataFrame, value: Column, width: float, bins: int) -> DataFrame:
    """bin, count, percent; the last bin takes its upper end too. Empty bins aren't listed."""
    out = df.where(value.isNotNull()).groupBy(F.least(F.floor(value / width), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return out.crossJoin(F.broadcast(out.agg(F.sum("n").alias("_all")))).withColumn("percent", 100.0 * F.col("n") / F.col("_all")).drop("_all")


def angle_report(df: DataFrame, value: Column, width: float = 15.0, bins: int = 6) -> tuple[DataFrame, DataFrame]:
    """One row with median and mean of the known angles, and their histogram."""
    known = df.select(F.lit(0).alias("_all"), value.cast("double").alias("_angle")).where("_angle is not null")
    mean = known.groupBy("_all").agg(F.avg("_angle").alias("mean"), F.count(F.lit(1)).alias("n"))
    row = mean.join(medians(known, F.col("_angle"), ["_all"], "median"), "_all").select("n", "median", "mean")
    return row, closed_histogram(known, F.col("_angle"), width, bins)


def paired_histogram(df: DataFrame, score: str, decoy: Column, bins: int = 15) -> DataFrame:
    """bin, low, high, n_real, n_decoy over the common range of both sides' scores; the last bin has its upper end too.

    Without spread all scores are in the first bin. Bins without a score have zeros.
    """
    marked = df.select(F.col(score).cast("double").alias("s"), decoy.alias("d")).where("s is not null")
    ends = F.broadcast(marked.agg(F.min("s").alias("_low"), F.max("s").alias("_high")))
    share = F.when(F.col("_high") > F.col("_low"), (F.col("s") - F.col("_low")) / (F.col("_high") - F.col("_low"))).otherwise(0.0)
    at = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int").alias("bin")
    counted = marked.crossJoin(ends).groupBy(at).agg(F.count_if(~F.col("d")).alias("n_real"), F.count_if(F.col("d")).alias("n_decoy"))
    edge = lambda k: F.col("_low") + (F.col("_high") - F.col("_low")) * k / bins
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(ends.where("_low is not null"))
    return every.join(counted, "bin", "left").select("bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high"), F.coalesce("n_real", F.lit(0)).alias("n_real"), F.coalesce("n_decoy", F.lit(0)).alias("n_decoy"))


def control_statistics(df: DataFrame, score: str, decoy: Column) -> DataFrame:
    """One row: best of both sides, the decoys' mean and sample deviation, separation, and the rank sum U of the real ones.

    Midranks come from counts by distinct score, added up in ranges of the score.
    """
    marked = df.select(F.col(score).alias("s"), decoy.alias("d"))
    best = marked.agg(
        F.max(F.when(~F.col("d"), F.col("s"))).alias("real_best"), F.max(F.when(F.col("d"), F.col("s"))).alias("decoy_best"),
        F.avg(F.when(F.col("d"), F.col("s"))).alias("decoy_mean"), F.stddev_samp(F.when(F.col("d"), F.col("s"))).alias("decoy_std"),
        F.count_if(~F.col("d")).alias("n_real"), F.count_if(F.col("d")).alias("n_decoy"),
    )
    by_score = marked.groupBy("s").agg(F.count_if(~F.col("d")).alias("real"), F.count_if(F.col("d")).alias("fake"))
    ranged = in_ranges(by_score, ["s"])
    earlier = lambda c, keys, order: F.coalesce(F.sum(c).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = ranged.withColumn("_below", earlier("fake", ["_p"], "s")).groupBy("_p").agg(F.sum(F.col("real") * (F.col("_below") + F.col("fake") / 2)).alias("_u"), F.sum("real").alias("_real"), F.sum("fake").alias("_fake"))
    own = written(own, "rank_sums")  # a row for each range
    u = own.join(before_ranges(own, "_fake")[0], "_p").agg(F.sum(F.col("_u") + F.col("_real") * F.col("_before")).alias("u"))
    separation = F.when(F.coalesce("decoy_std", F.lit(0.0)) == 0, F.lit(float("inf"))).otherwise((F.col("real_best") - F.col("decoy_mean")) / F.col("decoy_std"))
    return best.crossJoin(u).withColumn("separation", separation)


def mann_whitney_greater(real: list[float], decoy: list[float]) -> float:
    """One-sided p: exact for a small side without ties, else normal with corrections for ties and continuity."""
    n, m = len(real), len(decoy)
    both = sorted([*real, *decoy])
    counts = {v: both.count(v) for v in set(both)}
    u = sum((r > d) + 0.5 * (r == d) for r in real for d in decoy)
    if min(n, m) <= 8 and max(counts.values()) == 1:
        ways = {0: {0: 1}}  # number chosen -> U -> ways
        for rank in range(n + m):
            nxt: dict[int, dict[int, int]] = {k: dict(v) for k, v in ways.items()}
            for k, sums in ways.items():
                if k < n:
                    for s, w in sums.items():
                        nxt.setdefault(k + 1, {})
                        nxt[k + 1][s + rank - k] = nxt[k + 1].get(s + rank - k, 0) + w
            ways = nxt
        return sum(w for s, w in ways[n].items() if s >= u) / math.comb(n + m, n)
    ties = sum(t**3 - t for t in counts.values()) / ((n + m) * (n + m - 1))
    sd = math.sqrt(n * m / 12 * (n + m + 1 - ties))
    return 1.0 if sd == 0 else 0.5 * math.erfc((u - n * m / 2 - 0.5) / sd / math.sqrt(2))


def decoy_control(real: list[float], decoy: list[float], least_sigma: float = 2.0, alpha: float = 0.05) -> dict:
    """Verdict on best scores: separation from the decoys, and a rank test where it could be significant at all."""
    if not real or not decoy:
        return {"passed": False, "reason": "scores are missing", "real_best": max(real, default=math.nan), "decoy_best": max(decoy, default=math.nan), "separation_sigma": math.nan, "mann_whitney_p": math.nan}
    mean = sum(decoy) / len(decoy)
    std = math.sqrt(sum((x - mean) ** 2 for x in decoy) / (len(decoy) - 1)) if len(decoy) > 1 else 0.0
    sigma = math.inf if std == 0 else (max(real) - mean) / std
    p = mann_whitney_greater(real, decoy) if len(real) >= 2 and len(decoy) >= 2 else math.nan
    out = {"real_best": max(real), "decoy_best": max(decoy), "separation_sigma": sigma, "mann_whitney_p": p}
    if sigma < least_sigma:
        return out | {"passed": False, "reason": f"the best score is {sigma:.2f} deviations above the decoys"}
    if p == p and 1 / math.comb(len(real) + len(decoy), len(real)) <= alpha < p:
        return out | {"passed": False, "reason": f"the rank test gives p = {p:.3f}"}
    return out | {"passed": True, "reason": "the scores stand apart from the decoys"}


def row_standardise(array: Column) -> Column:
    """Population z-scores of one array; a flat one gives zeros."""
    n = F.size(array)
    mean = F.aggregate(array, F.lit(0.0), lambda a, x: a + x.cast("double")) / n
    var = F.aggregate(array, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")) / n - mean * mean
    std = F.when(var <= 1e-12, F.lit(1.0)).otherwise(F.sqrt(var))
    return F.transform(array, lambda x: (x.cast("double") - mean) / std)


def column_standardise(df: DataFrame, key: str, array: str, group: str, least: int = 50) -> DataFrame:
    """key and z (array): by the column's own statistics within groups of `least` members or more, else over all rows."""
    own = written(moments(df, group, array), "moments")
    whole = whole_moments(own, group)
    if not whole:
        return df.select(key, F.col(array).cast("array<double>").alias("z"))
    n, mean, q = whole
    spread = lambda m, q, n: F.zip_with(m, q, lambda a, b: F.struct(a.alias("m"), F.sqrt(b / n).alias("s")))
    whole = spread(F.array(*map(F.lit, mean.tolist())), F.array(*map(F.lit, q.tolist())), F.lit(n))
    large = own.where(F.col("n") >= least).select(F.col(group).alias("_g"), spread("m", "q", F.col("n")).alias("_of"))
    joined = df.join(large, F.col(group).eqNullSafe(F.col("_g")), "left").withColumn("_of", F.coalesce("_of", whole))
    z = F.zip_with(array, "_of", lambda v, of: (v.cast("double") - of["m"]) / F.when(of["s"] == 0, F.lit(1.0)).otherwise(of["s"]))
    return joined.select(key, z.alias("z"))


def mean_confidence(df: DataFrame, by: list[str], confidence: str) -> DataFrame:
    """by and the mean of the known confidences; null where none is known."""
    return df.groupBy(*by).agg(F.avg(confidence).alias("confidence"))


def power_normalise(array: Column) -> Column:
    norm = F.sqrt(F.aggregate(array, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.transform(array, lambda x: F.when(norm == 0, F.lit(0.0)).otherwise(x.cast("double") / norm))


def bump(n: int, width: float = 0.25) -> list[float]:
    """A Gaussian in the middle of n samples."""
    return [math.exp(-0.5 * (((i - (n - 1) / 2) / (n * width)) ** 2)) for i in range(n)]


def window_profile(low: float, high: float, samples: int, width: float | None = None) -> list[float]:
    """A Gaussian about a window's middle at the samples' offsets; the width is a quarter of the window unless given."""
    sigma = width or (high - low) / 4 or 1.0
    return [math.exp(-0.5 * ((low + (high - low) * i / (samples - 1) - (low + high) / 2) / sigma) ** 2) for i in range(samples)]


def profile_correlation(profile: Column, shape: list[float]) -> Column:
    """Pearson correlation with a fixed profile; 0 for a flat one. At least three samples."""
    if len(shape) < 3:
        raise ValueError("a profile needs three samples")
    mean = sum(shape) / len(shape)
    off = [x - mean for x in shape]
    norm = math.sqrt(sum(x * x for x in off))
    weights = F.array(*(F.lit(x) for x in off))
    centre = F.aggregate(profile, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(profile)
    dot = F.aggregate(F.zip_with(profile, weights, lambda x, w: x.cast("double") * w), F.lit(0.0), lambda a, x: a + x)
    var = F.aggregate(profile, F.lit(0.0), lambda a, x: a + (x.cast("double") - centre) * (x.cast("double") - centre))
    return F.when((var <= 1e-24) | F.lit(norm == 0), F.lit(0.0)).otherwise(dot / (F.sqrt(var) * norm))
