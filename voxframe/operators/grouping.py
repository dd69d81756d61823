"""Downsampling, suppression, reconciliation, reduction and clustering."""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..kernels import cluster as K
from ..scratch import discard, in_ranges, written
from .joins import within
from .windows import nearest_attributes, representatives


def both_faces(df: DataFrame, normal: list[str]) -> DataFrame:
    """Each point with its normal and the opposite one, as side and n_<axis>."""
    sided = df.withColumn("side", F.explode(F.array(F.lit(1), F.lit(-1))))
    return sided.select("*", *((F.col(c) * F.col("side")).alias(f"n_{c}") for c in normal))


def downsample(df: DataFrame, xyz: list[str], spacing: float, order: str, by: list[str] | None = None) -> DataFrame:
    """The row of lowest order in each cell; a partial minimum goes before the shuffle."""
    if spacing <= 0:
        raise ValueError("spacing must be positive")
    cell = [F.floor(F.col(c) / spacing).alias(f"_{c}") for c in xyz]
    keys = [*(by or []), *cell]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), order).alias("_r")).select("_r.*")


#: Suppression: best rows of a cell that a round looks at, cells of a tile's side and of the rim around it, rows that a task has of the tiles (about), rows
#: of a cell that are looked up together.
FRONT, TILE, RIM, DEALT, TOGETHER = 32, 16, 4, 50_000, 20_000
#: Cells that far out are one.
FURTHEST = float(1 << 50)


def suppress(df: DataFrame, by: list[str], xyz: list[str], score: str, order: str, distance: float) -> DataFrame:
    """Greedy non-maximum suppression within groups, best score first (lowest order of ties, rows without a score last), inclusive distance.

    Rounds over cells so small that one keeps a row at most or so, without pairs of rows. In a round the best rows of each cell go to
    the tiles around it, tasks find which of them are kept whatever the others are (`kernels.cluster.surely_kept`), and all rows
    near one of these go. The best row left is always found, and chains of rows that hang on each other as far as they stay in a tile with its
    rim; the tiles of the next round lie half a tile further. Rows without a place are near to none. Rows without a group are one.
    """
    if distance <= 0:
        return df
    names, at = [f"_c{k}" for k in range(len(xyz))], [f"_x{k}" for k in range(len(xyz))]
    side, reach, cell = distance / len(xyz) ** 0.5, int(len(xyz) ** 0.5 * (1 + 1e-6)) + 1, ["_g", *names]
    rows = written(df.withColumn("_id", F.monotonically_increasing_id()), "rows")
    placed = functools.reduce(Column.__and__, (F.coalesce(F.abs(F.col(c).cast("double")) < math.inf, F.lit(False)) for c in xyz))
    slim = rows.where(placed).select("_id", F.struct(F.lit(0), *by).alias("_g"), F.col(score).alias("_s"), F.col(order).alias("_o"), *(F.col(c).cast("double").alias(x) for c, x in zip(xyz, at, strict=True)))
    open_rows = written(slim.withColumns({c: F.floor(F.least(F.greatest(F.col(x) / side, F.lit(-FURTHEST)), F.lit(FURTHEST))) for c, x in zip(names, at, strict=True)}), "open")
    kept = [rows.where(~placed).select("_id")]
    while True:
        boxes = written(open_rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"), *(f(x).alias(f"{n}{x}") for x in at for n, f in (("low", F.min), ("high", F.max)))), "boxes")
        total, fullest, front = boxes.agg(F.sum("_n"), F.max("_n"), F.sum(F.least("_n", F.lit(FRONT)))).first()
        if not total:
            break
        sure = written(_sure(open_rows, boxes, names, at, distance, reach, TILE // 2 * (len(kept) % 2), front), "sure")
        kept.append(sure)
        rest = written(_far_from_kept(open_rows, open_rows.join(sure, "_id", "left_semi"), names, at, distance, reach, total, fullest), "open")
        discard(boxes, open_rows)
        open_rows = rest
    all_kept = written(functools.reduce(DataFrame.unionByName, kept), "kept")
    discard(boxes, open_rows, *kept)
    return rows.join(all_kept, "_id", "left_semi").select(*df.columns)


def _sure(rows: DataFrame, boxes: DataFrame, names: list[str], at: list[str], distance: float, reach: int, shift: int, front: int) -> DataFrame:
    """_id of rows that are kept for certain (some more than once): the best of each cell (front rows of all), dealt by tiles with what lies around them."""
    best, rim = [F.col("_s").desc_nulls_last(), F.col("_o").asc_nulls_last(), F.col("_id")], max(RIM, reach)
    wide, corners = TILE + 2 * rim, [f"{n}{x}" for n in ("low", "high") for x in at]
    fronts = rows.withColumn("_r", F.row_number().over(Window.partitionBy("_g", *names).orderBy(*best))).where(F.col("_r") <= FRONT).drop("_r")
    tiled = fronts.join(boxes.withColumn("_more", F.col("_n") > FRONT).drop("_n"), ["_g", *names])
    tiles = [f"_t{c}" for c in names]
    for c, t in zip(names, tiles, strict=True):
        low, high = (F.floor((F.col(c) + (shift + r)) / TILE) for r in (-rim, rim))
        tiled = tiled.withColumn(t, F.explode(F.sequence(low, high))).withColumn(c, F.col(c) + (shift + rim) - F.col(t) * TILE)
    spark = rows.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(front * (wide / TILE) ** len(names) / DEALT))
    # a stated number of partitions, which adaptive execution leaves alone
    dealt = tiled.repartition(parts, "_g", *tiles).withColumn("_r", F.row_number().over(Window.partitionBy("_g", *tiles).orderBy(*best)))

    def decide(batches):
        some = [b for b in batches if len(b)]
        if some:
            r = pd.concat(some)
            numbers = lambda columns: r[columns].to_numpy()
            low, high = (numbers([f"{n}{x}" for x in at]) for n in ("low", "high"))
            found = K.surely_kept(np.cumsum(r["_r"].to_numpy() == 1), numbers(names), numbers(at), low, high, r["_more"].to_numpy(), wide, reach, distance)
            yield pd.DataFrame({"_id": r["_id"].to_numpy()[found]})

    return dealt.select("_id", "_r", "_more", *names, *at, *corners).mapInPandas(decide, "_id long")


def _far_from_kept(rows: DataFrame, kept: DataFrame, names: list[str], at: list[str], distance: float, reach: int, total: int, fullest: int) -> DataFrame:
    """Rows with none of the kept ones within the distance: each looks at those of the cells around its own, as a list, so no row is joined twice.

    A cell with far more rows than others has its list copied, so that its rows go to several tasks.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = math.ceil(fullest / max(TOGETHER, total / partitions))
    for c in names:
        kept = kept.withColumn(c, F.explode(F.sequence(F.col(c) - reach, F.col(c) + reach)))
    lists = kept.groupBy("_g", *names).agg(F.collect_set(F.struct(*at)).alias("_near")).withColumn("_p", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))
    near = F.exists("_near", lambda k: sum(((F.col(x) - k[x]) * (F.col(x) - k[x]) for x in at), F.lit(0.0)) <= distance * distance)
    joined = rows.withColumn("_p", F.col("_id") % copies).join(lists, ["_g", *names, "_p"], "left")
    return joined.where(~F.coalesce(near, F.lit(False))).select(*rows.columns)


def consensus(df: DataFrame, by: list[str], picker: str, confidence: str, rule: str, n_pickers: int) -> DataFrame:
    """Groups of picks under a rule: union takes any, intersection needs all n_pickers."""
    if rule not in ("union", "intersection"):
        raise ValueError(f"unknown rule {rule}")
    out = df.groupBy(*by).agg(F.countDistinct(picker).alias("n_pickers"), F.array_join(F.array_sort(F.collect_set(picker)), "+").alias("sources"), F.avg(confidence).alias("confidence"))
    return out.where(F.col("n_pickers") >= (1 if rule == "union" else n_pickers))


def near_parts(df: DataFrame, by: list[str], xyz: list[str], threshold: float) -> DataFrame:
    """_cell and part: which parts of a group's rows no gap of the threshold runs through.

    Rows are counted as cells so small that those in one are nearer than the threshold, each with the box around its rows;
    cells are linked where their boxes are near enough. So no pairs of rows are made, however many share a place. A part may hold
    rows that are further apart than the threshold, never the other way round.
    """
    side = threshold / len(xyz) ** 0.5 * (1 - 1e-9)
    boxes = df.groupBy(small_cell(by, xyz, threshold).alias("_cell")).agg(*(f(c).alias(f"{n}_{c}") for c in xyz for f, n in ((F.min, "low"), (F.max, "high"))))
    boxes = written(boxes, "cells")
    # no further cell than this has rows near enough
    reach = math.ceil(len(xyz) ** 0.5)
    to = boxes.select(*(F.col(c).alias(f"l_{c}") for c in boxes.columns))
    for c in xyz:
        to = to.withColumn(f"_{c}", F.explode(F.sequence(F.col(f"l__cell._{c}") - reach, F.col(f"l__cell._{c}") + reach)))
    to = to.withColumn("_at", F.struct(*(F.col(f"l__cell.{c}").alias(c) for c in by), *(f"_{c}" for c in xyz))).drop(*(f"_{c}" for c in xyz))
    gap = [F.greatest(F.lit(0.0), F.col(f"low_{c}") - F.col(f"l_high_{c}"), F.col(f"l_low_{c}") - F.col(f"high_{c}")) for c in xyz]
    near = to.join(boxes, F.col("_at") == F.col("_cell")).where((F.col("_at") != F.col("l__cell")) & (sum((g * g for g in gap), F.lit(0.0)) < threshold * threshold))
    edges = written(near.select(F.col("l__cell").alias("a"), F.col("_cell").alias("b")), "edges")
    return least_reachable(edges, boxes.select(F.col("_cell").alias("a"))).select(F.col("a").alias("_cell"), F.col("least").alias("part"))


def small_cell(by: list[str], xyz: list[str], threshold: float) -> Column:
    """The cell of a row, its group with it."""
    side = threshold / len(xyz) ** 0.5 * (1 - 1e-9)
    return F.struct(*by, *(F.floor(F.col(c) / side).cast("long").alias(f"_{c}") for c in xyz))


def complete_linkage(df: DataFrame, by: list[str], xyz: list[str], order: list[str], threshold: float) -> DataFrame:
    """The by columns, order and group_id of each row: complete-linkage groups whose diameter stays under the threshold.

    by and order tell rows apart. No such group reaches over a gap of the threshold, so rows are dealt by their parts, and a task links one
    part at a time; a part of one row needs none. group_id is the least order of a group, as a struct.
    """
    own = [f"_g_{c}" for c in order]
    celled = df.select(*by, *xyz, *order, small_cell(by, xyz, threshold).alias("_cell"))
    dealt = celled.join(near_parts(df, by, xyz, threshold), "_cell").drop("_cell").withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("part")))

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order).reset_index(drop=True)
        first = rows[order].iloc[K.complete_linkage(rows[xyz].to_numpy(float), threshold)].reset_index(drop=True)
        return rows[[*by, *order]].assign(**{g: first[c] for g, c in zip(own, order, strict=True)})

    form = T.StructType([*(df.schema[c] for c in [*by, *order]), *(T.StructField(g, df.schema[c].dataType) for g, c in zip(own, order, strict=True))])
    linked = dealt.where("_n > 1").groupBy("part").applyInPandas(link, form)
    alone = dealt.where("_n = 1").select(*by, *order, *(F.col(c).alias(g) for g, c in zip(own, order, strict=True)))
    return linked.unionByName(alone).select(*by, *order, F.struct(*(F.col(g).alias(c) for g, c in zip(own, order, strict=True))).alias("group_id"))


def reconcile(picks: DataFrame, threshold: float, rule: str, n_pickers: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Complete-linkage groups of each tomogram's picks: the mean place of each picker's representative, and the carried
    columns of the representative nearest to it.

    picks: tomogram_id, picker, idx (which tells a picker's picks of a tomogram apart), x, y, z, confidence. A pick
    without a tomogram belongs to the tomogram of those. group_id is the first picker and idx of a group.
    """
    xyz, group, key = ["x", "y", "z"], ["tomogram_id", "group_id"], ["tomogram_id", "picker", "idx"]
    slim = picks.select(*key, *xyz, "confidence", *carry)
    groups = complete_linkage(slim, ["tomogram_id"], xyz, ["picker", "idx"], threshold)
    named = groups.select(*(F.col(c).alias(f"_{c}") for c in key), "group_id")
    linked = slim.join(named, functools.reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key))).drop(*(f"_{c}" for c in key))
    # a struct equals another where both lack a tomogram
    best = written(representatives(linked.withColumn("_g", F.struct("tomogram_id", "group_id")), ["_g"], "picker", xyz, "idx"), "representatives")
    out = consensus(best, ["_g"], "picker", "confidence", rule, n_pickers)
    placed = nearest_attributes(best, ["_g"], xyz, "picker", ["picker", *carry]).drop("n", "picker")
    joined = out.join(placed, "_g")
    return joined.select("_g.*", *(F.col(f"centre_{c}").alias(c) for c in xyz), "sources", "confidence", F.col("n_pickers").cast("int").alias("n_pickers"), *carry)


def least_reachable(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """a and least, the smallest node reachable, of each node (a); edges (a, b) go both ways and are written.

    Least labels spread over the edges, and each round jumps to the label's own label; tables are cut in between.
    """
    labels = written(nodes.select("a", F.col("a").alias("c")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("c").alias("n"))
        step = labels.join(near, "a", "left").select("a", F.least("c", F.coalesce("n", "c")).alias("c"), F.col("c").alias("was"))
        jumped = step.join(labels.select(F.col("a").alias("c"), F.col("c").alias("j")), "c").select("a", F.least("c", "j").alias("c"), "was")
        jumped = written(jumped, "labels")
        labels = jumped.select("a", "c")
        if not jumped.where("c <> was").limit(1).count():
            return labels.withColumnRenamed("c", "least")


def single_linkage(df: DataFrame, by: list[str], xyz: list[str], key: str, distance: float) -> DataFrame:
    """key, component: the smallest key reachable over gaps below the distance (strictly)."""
    slim = df.select(*by, *xyz, key)
    pairs = within(slim, slim, xyz, distance, by).where(F.col("distance2") < distance * distance)
    edges = written(pairs.select(F.col(f"l.{key}").alias("a"), F.col(f"r.{key}").alias("b")).where("a <> b"), "edges")
    found = least_reachable(edges, df.select(F.col(key).alias("a")))
    return found.select(F.col("a").alias(key), F.col("least").alias("component"))


def centroid_pairs(means: DataFrame, half: str, label: str) -> DataFrame:
    """label_a, label_b, distance of all class means of the two halves (a few dozen rows)."""
    a = means.where(F.col(half) == 0).select(F.col(label).alias("label_a"), F.col("mean").alias("_a"))
    b = means.where(F.col(half) == 1).select(F.col(label).alias("label_b"), F.col("mean").alias("_b"))
    square = F.aggregate(F.zip_with("_a", "_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    return a.crossJoin(F.broadcast(b)).select("label_a", "label_b", F.sqrt(square).alias("distance"))


def match_halves(means: DataFrame, half: str, label: str) -> DataFrame:
    """label_b, label_a of the greedy one-to-one match; as many rows as there are classes."""
    pairs = [(r.distance, r.label_b, r.label_a) for r in centroid_pairs(means, half, label).collect()]
    return means.sparkSession.createDataFrame(sorted(K.greedy_match(pairs).items()), "label_b int, label_a int")


#: Parts' sums that a task adds up.
FAN = 8


def joined_products(a: tuple, b: tuple) -> tuple:
    """Number, mean and products about the mean of two sets together."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    n, apart = a[0] + b[0], b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def products(df: DataFrame, array: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, mean, and the sum of products about it.

    Each task takes its rows once, in centred blocks, and gives one row with its matrix; FAN of these at a time are added up
    in tasks until FAN are left. So no element of a matrix is a row, and no large numbers cancel.
    """

    def packed(part: int, sums: tuple) -> pd.DataFrame:
        n, mean, square = sums
        return pd.DataFrame({"part": [part], "n": [n], "mean": [mean.tobytes()], "square": [square.tobytes()]})

    def unpacked(r) -> tuple:
        mean = np.frombuffer(r.mean)
        return r.n, mean, np.frombuffer(r.square).reshape(len(mean), len(mean))

    def own(batches):
        sums = (0, np.zeros(0), np.zeros((0, 0)))
        for rows in batches:
            if len(rows):
                x = np.stack(rows[array].to_numpy()).astype(float)
                sums = joined_products(sums, (len(x), x.mean(axis=0), (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))))
        if sums[0]:
            yield packed(TaskContext.get().partitionId(), sums)

    def add(key, rows: pd.DataFrame) -> pd.DataFrame:
        return packed(int(key[0]), functools.reduce(joined_products, map(unpacked, rows.sort_values("part").itertuples())))

    form = "part long, n long, mean binary, square binary"
    parts = written(df.select(array).mapInPandas(own, form), "products")
    while parts.count() > FAN:
        # by rank, as empty partitions leave gaps
        ranked = parts.join(parts.select("part", (F.row_number().over(Window.orderBy("part")) - 1).alias("_r")), "part")
        parts = written(ranked.withColumn("_to", F.floor(F.col("_r") / FAN)).drop("_r").groupBy("_to").applyInPandas(add, form), "products")
    return functools.reduce(joined_products, (unpacked(r) for r in parts.orderBy("part").collect()), (0, np.zeros(0), np.zeros((0, 0))))


def reduce(df: DataFrame, key: str, array: str, k: int) -> DataFrame:
    """key and scores: centred principal components. An empty table gives no rows; one or two rows are an error.

    The input is read twice, for its products and to project it; only the covariance comes to the driver.
    """
    form = f"{key} {df.schema[key].dataType.simpleString()}, scores array<double>"
    n, mean, square = products(df, array)
    if not n:
        return df.sparkSession.createDataFrame([], form)
    k = min(k, n - 1, len(mean))
    if k < 2:
        raise ValueError("two components at least need three rows")
    values, axes = np.linalg.eigh(square / n)
    axes = axes[:, np.argsort(-values)[:k]]
    axes *= np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(k)])

    def project(batches):
        for rows in batches:
            x = np.stack(rows[array].to_numpy()).astype(float) - mean if len(rows) else np.zeros((0, len(mean)))
            yield pd.DataFrame({key: rows[key], "scores": list(x @ axes)})

    return df.select(key, array).mapInPandas(project, form)


#: Rows that the first centres of k-means are drawn from.
SEEDS = 4096


def k_means(df: DataFrame, key: str, array: str, k: int, seed: int = 0, starts: int = 10, rounds: int = 100) -> DataFrame:
    """key and label of the best of several starts; labels are numbered by their centres' order.

    All starts go through the rows together: each round, tasks add up the rows of each centre, and only these sums
    come together. First centres are drawn far apart from at most SEEDS rows, those of least hash, and settle there; so
    few rounds over all rows are left.
    """
    rows = written(df.select(F.col(key), F.col(array).cast("array<double>").alias("x")), "rows")
    few = np.array([r.x for r in rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(SEEDS).select("x").collect()])
    if not len(few):
        return rows.select(key, F.lit(0).alias("label"))
    k, rng, spark = min(k, len(few)), np.random.default_rng(seed), df.sparkSession
    centres = np.stack([K.settled(few, K.apart(few, k, rng), rounds) for _ in range(starts)])
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(centres)

        def add(batches, shared=shared):
            sums, counts, cost = np.zeros(shared.value.shape), np.zeros(shared.value.shape[:2]), np.zeros(starts)
            for batch in batches:
                for x in np.array_split(np.stack(batch["x"].to_numpy()), -(-len(batch) // 1024)) if len(batch) else []:
                    square = ((x[None, :, None] - shared.value[:, None]) ** 2).sum(axis=3)
                    cost += square.min(axis=2).sum(axis=1)
                    for s, own in enumerate(square.argmin(axis=2)):
                        np.add.at(sums[s], own, x)
                        counts[s] += np.bincount(own, minlength=k)
            yield pd.DataFrame({"v": [np.concatenate([sums.ravel(), counts.ravel(), cost]).tolist()]})

        parts = rows.select("x").mapInPandas(add, "v array<double>").select(F.posexplode("v").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
        total = np.array([r.v for r in parts.orderBy("i").collect()])
        sums, counts, cost = np.split(total, np.cumsum([centres.size, starts * k]))
        counts = counts.reshape(starts, k, 1)
        moved = np.where(counts > 0, sums.reshape(centres.shape) / np.maximum(counts, 1), centres)
        done, centres = np.allclose(moved, centres), moved
        if done:
            break
    best = centres[int(np.argmin(cost))]
    best = best[np.lexsort(best.T[::-1])]

    def label(batches):
        for batch in batches:
            x = np.stack(batch["x"].to_numpy()) if len(batch) else np.zeros((0, best.shape[1]))
            yield pd.DataFrame({key: batch[key], "label": ((x[:, None] - best[None]) ** 2).sum(axis=2).argmin(axis=1).astype("int32")})

    return rows.mapInPandas(label, f"{key} {df.schema[key].dataType.simpleString()}, label int")


#: Rows of a block; a task compares two blocks at a time.
BLOCK = 4096
#: Bits of a row's place on the curve that blocks are cut from, and how many of its values have a part in it.
CURVE_BITS, CURVE_VALUES = 56, 8


def on_a_curve(rows: DataFrame) -> DataFrame:
    """rows (k, x) with z, their place on a curve that keeps near rows near: the bits of their first values in turn."""

    def extremes(batches):
        low, high = None, None
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy())[:, :CURVE_VALUES]
                low, high = (x.min(0) if low is None else np.minimum(low, x.min(0))), (x.max(0) if high is None else np.maximum(high, x.max(0)))
        if low is not None:
            yield pd.DataFrame({"low": [low.tolist()], "high": [high.tolist()]})

    found = rows.select("x").mapInPandas(extremes, "low array<double>, high array<double>").collect()  # a row for each task
    low, high = np.min([r.low for r in found], axis=0), np.max([r.high for r in found], axis=0)
    bits = CURVE_BITS // len(low)

    def place(batches):
        for batch in batches:
            x = np.stack(batch["x"].to_numpy())[:, : len(low)] if len(batch) else np.zeros((0, len(low)))
            cell = np.minimum((x - low) / np.where(high > low, high - low, 1.0) * (1 << bits), (1 << bits) - 1).astype(np.int64)
            z = np.zeros(len(x), np.int64)
            for bit in reversed(range(bits)):
                for d in range(len(low)):
                    z = z << 1 | cell[:, d] >> bit & 1
            yield batch.assign(z=z)

    return rows.mapInPandas(place, f"k {rows.schema['k'].dataType.simpleString()}, x array<double>, z long")


def balls(rows: DataFrame) -> DataFrame:
    """i, centre, radius of each block of rows (i, x)."""

    def around(key, own: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(own["x"].to_numpy())
        centre = x.mean(axis=0)
        return pd.DataFrame({"i": [key[0]], "centre": [centre.tolist()], "radius": [float(np.sqrt(((x - centre) ** 2).sum(axis=1).max()))]})

    return rows.select("i", "x").groupBy("i").applyInPandas(around, "i int, centre array<double>, radius double")


def ball_pairs(blocks: DataFrame, count: int) -> DataFrame:
    """i and j of all pairs of different blocks, with the least and the most that rows of the two can be apart."""
    one = blocks.select("i", F.col("centre").alias("_a"), F.col("radius").alias("_r"), F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("j")).where("i <> j")
    both = one.join(blocks.select(F.col("i").alias("j"), F.col("centre").alias("_b"), F.col("radius").alias("_s")), "j")
    apart = F.sqrt(F.aggregate(F.zip_with("_a", "_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    return both.select("i", "j", F.greatest(F.lit(0.0), (apart - F.col("_r") - F.col("_s")) * (1 - 1e-9) - 1e-12).alias("least"), ((apart + F.col("_r") + F.col("_s")) * (1 + 1e-9) + 1e-12).alias("most"))


def from_box(width: int) -> Column:
    """The least that a row (x) can be from rows in the box from low to high."""
    gap = [F.greatest(F.lit(0.0), F.col("low")[d] - F.col("x")[d], F.col("x")[d] - F.col("high")[d]) for d in range(width)]
    return F.sqrt(sum((g * g for g in gap), F.lit(0.0))) * (1 - 1e-9) - 1e-12


def density_clusters(df: DataFrame, key: str, array: str, least_size: int, block: int | None = None) -> DataFrame:
    """key and label of density clusters by excess of mass; -1 is noise. Keys are unique.

    Blocks are stretches of a curve through the rows, each with a ball around it. Core distances and, in rounds, each
    component's nearest row of another one come first from the blocks themselves; these are bounds, and a pair of blocks is
    compared only if their balls are near enough to beat them, and of such a pair only the rows that are near enough to the box around the others. The
    largest component doesn't look, as the others find it. Only the least edges leave a task. So no task holds more than two blocks, what is
    compared between blocks are their rims, and rounds halve the components until one spanning tree is left. Its edges, three values
    a row, are condensed in one task.
    """
    n = df.count()
    if n < least_size:
        raise ValueError("fewer rows than the least cluster size")
    kind, count = df.schema[key].dataType.simpleString(), max(1, -(-n // (block or BLOCK)))
    rows = on_a_curve(df.select(F.col(key).alias("k"), F.col(array).cast("array<double>").alias("x")))
    rows, near = in_ranges(rows, ["z", "k"], count).withColumnRenamed("_p", "i").drop("z"), min(max(least_size - 1, 1), n - 1)
    ball = written(balls(rows), "balls")
    apart, width, tasks = ball_pairs(ball, count), len(ball.select("centre").first()[0]), 4 * df.sparkSession.sparkContext.defaultParallelism

    def box(state: DataFrame, *others: Column) -> DataFrame:
        """i with the box around its rows as low and high."""
        return state.groupBy("i").agg(*(F.array(*(f(F.col("x")[d]) for d in range(width))).alias(name) for f, name in ((F.min, "low"), (F.max, "high"))), *others)

    def inside_blocks(state: DataFrame, function, form: str) -> DataFrame:
        return state.repartition(max(1, min(count, tasks)), "i").groupBy("i").applyInPandas(lambda own: function(own, own), form)

    def compared(searching: DataFrame, state: DataFrame, pairs: DataFrame, function, form: str) -> DataFrame:
        """function(searching rows of i, rows of j) of the pairs; of both, only the rows that are no further from the other's box than a
        searching row's bound."""
        mine, theirs = box(searching, F.max("bound").alias("most")), box(state).withColumnRenamed("i", "j")
        one = searching.join(pairs.join(theirs, "j"), "i").where(from_box(width) <= F.col("bound")).select("i", "j", *(c for c in searching.columns if c != "i"))
        two = state.withColumnRenamed("i", "j").join(pairs.join(mine, "i"), "j").where(from_box(width) <= F.col("most")).select("i", "j", *(c for c in state.columns if c != "i"))
        return one.repartition(tasks, "i", "j").groupBy("i", "j").cogroup(two.repartition(tasks, "i", "j").groupBy("i", "j")).applyInPandas(function, form)

    def slices(one: pd.DataFrame, two: pd.DataFrame):
        """Rows of the one side, a few at a time, and their distances to all of the other."""
        y = np.stack(two["x"].to_numpy()).T if len(two) else None
        for at in range(0, len(one) if len(two) else 0, 64):
            x = np.stack(one["x"].to_numpy()[at : at + 64]).T
            yield slice(at, at + 64), np.sqrt(sum((x[d][:, None] - y[d][None]) ** 2 for d in range(width)))

    def nearest(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        parts = [(k, np.sort(np.partition(d, min(near, d.shape[1] - 1), axis=1)[:, : near + 1], axis=1)) for k, d in slices(one, two)]
        return pd.DataFrame([(key, own.tolist()) for at, d in parts for key, own in zip(one["k"].to_numpy()[at], d, strict=True)], columns=["k", "d"])

    form = f"k {kind}, d array<double>"
    inside = written(inside_blocks(rows, nearest, form), "inside")
    # the furthest that a row may have to look; one with few rows in its block looks everywhere
    searching = written(rows.join(inside, "k").withColumn("bound", F.when(F.size("d") > near, F.col("d")[near]).otherwise(F.lit(float("inf")))).drop("d"), "searching")
    close = apart.join(searching.groupBy("i").agg(F.max("bound").alias("reach")), "i").where("least <= reach").select("i", "j")
    lists = inside.unionByName(compared(searching, rows, written(close, "close"), nearest, form)) if count > 1 else inside
    core = lists.groupBy("k").agg(F.array_sort(F.flatten(F.collect_list("d")))[near].alias("core"))
    rows = written(rows.join(core, "k"), "cores")
    discard(inside, searching)

    def outside(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        """Of each component of the one side, the least (reach, lesser key, greater key) to a row of another component."""
        two = two.sort_values("k")
        _, own = np.unique(np.concatenate([one["c"].to_numpy(), two["c"].to_numpy()]), return_inverse=True)
        left, right, edges = own[: len(one)], own[len(one) :], []
        for at, d in slices(one, two):
            reach = np.maximum(d, np.maximum(one["core"].to_numpy()[at, None], two["core"].to_numpy()[None]))
            reach[left[at, None] == right[None]] = np.inf
            to = reach.argmin(axis=1)  # of equals the least key, which makes the least edge
            w, c, k, j = reach[np.arange(len(to)), to], one["c"].to_numpy()[at], one["k"].to_numpy()[at], two["k"].to_numpy()[to]
            edges += [(*e[:2], *sorted(e[2:])) for e, any_ in zip(zip(c.tolist(), w.tolist(), k.tolist(), j.tolist(), strict=True), np.isfinite(w), strict=True) if any_]
        best: dict = {}
        for c, *edge in edges:
            best[c] = min(best.get(c, edge), edge)
        return pd.DataFrame([(c, *edge) for c, edge in best.items()], columns=["c", "w", "a", "b"])

    labels, tree, form = rows.select("k", F.col("k").alias("c")), None, f"c {kind}, w double, a {kind}, b {kind}"
    while True:
        # the largest component is found by the others
        largest = labels.groupBy("c").count().orderBy(F.desc("count"), "c").first()
        if largest["count"] == n:
            break
        state = written(rows.join(labels, "k"), "state")
        own = written(inside_blocks(state, lambda one, two, c=largest.c: outside(one[one["c"] != c], two), form), "inside")
        found = own
        if count > 1:
            # what a component's best edge is at most: one inside a block, else one between two blocks that aren't both all its own
            some = state.groupBy("i").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.min("core").alias("least_core"), F.max("core").alias("most_core"))
            pairs = apart.join(some.withColumnsRenamed({"c0": "ci", "c1": "di", "least_core": "li", "most_core": "mi"}), "i")
            pairs = pairs.join(some.withColumnsRenamed({"i": "j", "c0": "cj", "c1": "dj", "least_core": "lj", "most_core": "mj"}), "j").where("not (ci = di and cj = dj and ci = cj)")
            pairs = written(pairs.select("i", "j", "ci", "di", F.greatest("least", "li", "lj").alias("least"), F.greatest("most", "mi", "mj").alias("most")), "pairs")
            between = pairs.where("ci = di").groupBy(F.col("ci").alias("c")).agg(F.min("most").alias("w"))
            bound = own.select("c", "w").unionByName(between).groupBy("c").agg(F.min("w").alias("bound"))
            searching = state.where(F.col("c") != F.lit(largest.c)).join(bound, "c", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
            searching = written(searching.where("core <= bound"), "searching")
            needed = pairs.join(searching.groupBy("i").agg(F.max("bound").alias("reach")), "i").where("least <= reach").select("i", "j")
            found = own.unionByName(compared(searching, state, written(needed, "needed"), outside, form))
        found = written(found.groupBy("c").agg(F.min(F.struct("w", "a", "b")).alias("e")).select("e.*").distinct(), "edges")
        discard(state, own, *([pairs, searching] if count > 1 else []))
        tree = found if tree is None else tree.unionByName(found)
        ends = found.join(labels.select(F.col("k").alias("a"), F.col("c").alias("ca")), "a").join(labels.select(F.col("k").alias("b"), F.col("c").alias("cb")), "b")
        ends = ends.select(F.explode(F.array(F.struct(F.col("ca").alias("a"), F.col("cb").alias("b")), F.struct(F.col("cb").alias("a"), F.col("ca").alias("b")))).alias("e")).select("e.*")
        merged = least_reachable(written(ends, "ends"), labels.select(F.col("c").alias("a")).distinct())
        labels = written(labels.join(merged, F.col("c") == F.col("a")).select("k", F.col("least").alias("c")), "labels")
    if tree is None:  # one row
        return rows.select(F.col("k").alias(key), F.lit(-1).alias("label"))

    def condense(edges: pd.DataFrame) -> pd.DataFrame:
        names, at = np.unique(np.concatenate([edges["a"], edges["b"]]), return_inverse=True)
        half = len(edges)
        found = K.tree_clusters(len(names), list(zip(edges["w"], at[:half].tolist(), at[half:].tolist(), strict=True)), least_size)
        return pd.DataFrame({key: names, "label": found.astype("int32")})

    return tree.withColumn("_tree", F.lit("")).groupBy("_tree").applyInPandas(condense, f"{key} {kind}, label int")


def cluster(df: DataFrame, key: str, array: str, method: str, by: str | None = None, k: int = 8, least_size: int = 10, seed: int = 0) -> DataFrame:
    """key, label of each half (or of all rows): kmeans, or density clusters with -1 for noise."""
    if method not in ("kmeans", "density"):
        raise ValueError(f"unknown method {method}")
    parts = [df.where(F.col(by) == r[0]) for r in df.select(by).distinct().orderBy(by).collect()] if by else [df]
    found = [k_means(part, key, array, k, seed) if method == "kmeans" else density_clusters(part, key, array, least_size) for part in parts]
    return functools.reduce(DataFrame.unionByName, found)


def centroids(df: DataFrame, labels: DataFrame, key: str, array: str) -> DataFrame:
    from .aggregates import elementwise_mean

    return elementwise_mean(df.join(labels.where("label >= 0"), key), ["label"], array)


def first_in_group(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
