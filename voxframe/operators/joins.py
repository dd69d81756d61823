"""Prefix, spatial and bookkeeping joins."""

from __future__ import annotations

import functools
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import discard, written


def longest_prefix(left: DataFrame, name: str, prefixes: DataFrame, prefix: str) -> DataFrame:
    """Left join of each name to the longest of the prefixes that begins it; an exact match is the longest.

    Each distinct name meets the prefixes by equality on its own beginnings, whose lengths are those that
    occur among the prefixes, so neither side is scanned for each row of the other.
    """
    lengths = F.broadcast(prefixes.agg(F.array_sort(F.collect_set(F.length(prefix))).alias("_lengths")))
    names = left.select(name).distinct()
    cut = names.crossJoin(lengths).withColumn("_n", F.explode("_lengths")).where(F.length(name) >= F.col("_n"))
    found = cut.withColumn("_start", F.expr(f"substring({name}, 1, _n)")).join(prefixes.withColumnRenamed(prefix, "_prefix"), F.col("_start") == F.col("_prefix"))
    others = [c for c in prefixes.columns if c != prefix]
    best = found.groupBy(F.col(name).alias("_name")).agg(F.max_by(F.struct(F.col("_prefix").alias(prefix), *others), "_n").alias("_best"))
    return left.join(best, F.col(name) == F.col("_name"), "left").select(*left.columns, *(F.col(f"_best.{c}").alias(c) for c in [prefix, *others]))


def cells(position: list[Column], size: float) -> list[Column]:
    return [F.floor(p / size).cast("long") for p in position]


def _celled(df: DataFrame, xyz: list[str], size: float, spread: bool) -> DataFrame:
    own = cells([F.col(c) for c in xyz], size)
    if not spread:
        return df.withColumn("_cell", F.struct(*(c.alias(f"c{k}") for k, c in enumerate(own))))
    near = [F.struct(*((c + d).alias(f"c{k}") for k, (c, d) in enumerate(zip(own, step, strict=True)))) for step in product((-1, 0, 1), repeat=len(xyz))]
    return df.withColumn("_cell", F.explode(F.array(*near)))


def _square(a: list[Column], b: list[Column]) -> Column:
    return sum(((p - q) * (p - q) for p, q in zip(a, b, strict=True)), F.lit(0.0))


def within(left: DataFrame, right: DataFrame, xyz: list[str], radius: float, by: list[str] | None = None) -> DataFrame:
    """Pairs at most radius apart, as structs l and r with distance2: a join by grid cells of the radius' size.

    The smaller side should be right: its rows are sent to the cells around their own. Rows without a group (null) are a
    group of their own.
    """
    group = F.struct(F.lit(0), *(by or [])).alias("_k")  # a struct equals another that has nulls in the same places
    one = _celled(left, xyz, radius, False).select("_cell", group, F.struct(*left.columns).alias("l"))
    two = _celled(right, xyz, radius, True).select("_cell", group, F.struct(*right.columns).alias("r"))
    square = _square([F.col(f"l.{c}") for c in xyz], [F.col(f"r.{c}") for c in xyz])
    return one.join(two, ["_cell", "_k"]).withColumn("distance2", square).where(F.col("distance2") <= radius * radius).select("l", "r", "distance2")


def far_from(left: DataFrame, right: DataFrame, xyz: list[str], distance: float, by: list[str] | None = None) -> DataFrame:
    """Rows of left whose nearest row of right is at least distance away, also if there is none.

    A row that shares a cell with any of right, so small that rows in one are nearer than the distance, goes by that cell alone; so what
    meets rows of right one by one are those at the rims of dense places.
    """
    by = by or []
    side = distance / len(xyz) ** 0.5 * (1 - 1e-9)
    small = {f"_s_{c}": F.when(F.abs(c) < 1e6 * side, F.floor(F.col(c) / side)) for c in xyz}
    taken = right.select(*(F.col(k).alias(f"_k_{k}") for k in by), *(c.alias(f"_t{n}") for n, c in small.items())).distinct()
    same = [F.col(n) == F.col(f"_t{n}") for n in small] + [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in by]
    left = left.withColumns(small).join(taken, functools.reduce(Column.__and__, same), "left_anti").drop(*small)
    one = _celled(left, xyz, distance, False)
    two = _celled(right.select(*by, *xyz), xyz, distance, True).select(F.col("_cell").alias("_c"), *(F.col(k).alias(f"_k_{k}") for k in by), *(F.col(c).alias(f"_r_{c}") for c in xyz))
    on = (F.col("_cell") == F.col("_c")) & (_square([F.col(c) for c in xyz], [F.col(f"_r_{c}") for c in xyz]) < distance * distance)
    for k in by:
        on &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return one.join(two, on, "left_anti").drop("_cell")


def _boxed(cells: DataFrame, names: list[str], xyz: list[str]) -> DataFrame:
    """Cells twice as wide: _g, the cell's numbers, and the box around what is in them."""
    up = [F.floor(F.col(c) / 2).cast("long").alias(c) for c in names]
    return cells.groupBy("_g", *up).agg(*(f(f"{n}_{c}").alias(f"{n}_{c}") for c in xyz for n, f in (("low", F.min), ("high", F.max))))


def _far_nearest(rest: DataFrame, right: DataFrame, xyz: list[str], radius: float, best: Column) -> DataFrame:
    """_id and _n of the rows (_id, _g, xyz), down through nested grids over right.

    Cells of the radius' size, each twice as wide as those below it, have the box around their rows. A row goes from the widest cells
    to those in them, and leaves out a cell whose box is further away than the furthest corner of another. So it meets
    the rows of the few narrowest cells that may hold its nearest, wherever it lies.
    """
    names = [f"_c{k}" for k in range(len(xyz))]
    own = right.select("_g", *(c.alias(n) for c, n in zip(cells([F.col(f"r.{c}") for c in xyz], radius), names, strict=True)), "r")
    narrow = own.groupBy("_g", *names).agg(*(f(f"r.{c}").alias(f"{n}_{c}") for c in xyz for n, f in (("low", F.min), ("high", F.max))))
    levels = [written(narrow, "level")]
    widest = levels[0].agg(*(F.greatest(F.abs(F.max(c)), F.abs(F.min(c))) for c in names)).first()
    for _ in range(max((int(x or 0) for x in widest), default=0).bit_length()):  # then -1 and 0 are left on each axis
        levels.append(written(_boxed(levels[-1], names, xyz), "level"))
    near = [F.greatest(F.lit(0.0), F.col(f"low_{c}") - F.col(c), F.col(c) - F.col(f"high_{c}")) for c in xyz]
    far = [F.greatest(F.col(f"high_{c}") - F.col(c), F.col(c) - F.col(f"low_{c}")) for c in xyz]
    least, most = (sum((x * x for x in d), F.lit(0.0)) for d in (near, far))
    open_cells = rest.join(levels[-1], "_g")
    for level in [*levels[-2::-1], None]:
        bounds = open_cells.select("_id", "_g", *xyz, *names, least.alias("_least"), F.min(most).over(Window.partitionBy("_id")).alias("_most"))
        kept = written(bounds.where(F.col("_least") <= F.col("_most") * (1 + 1e-12)).select("_id", "_g", *xyz, *names), "open")
        if level is not None:
            inner = level.withColumns({f"_up{c}": F.floor(F.col(c) / 2).cast("long") for c in names})
            kept = kept.withColumnsRenamed({c: f"_up{c}" for c in names})
            open_cells = kept.join(inner, ["_g", *(f"_up{c}" for c in names)])
    pairs = kept.join(own, ["_g", *names]).withColumn("distance2", _square([F.col(c) for c in xyz], [F.col(f"r.{c}") for c in xyz]))
    found = written(pairs.groupBy("_id").agg(best.alias("_n")), "nearest")
    discard(*levels)
    return found


#: Different places that a cell may have at most, and how often cells are halved for that.
CROWD, HALVINGS = 32, 12


def uncrowded_side(right: DataFrame, xyz: list[str], radius: float) -> float:
    """The radius, or so small a part of it that no group's cell of that side has more than CROWD of right (_g, xyz), whose places differ."""
    side = radius
    for _ in range(HALVINGS):
        fullest = right.groupBy("_g", *(c.alias(f"_c{k}") for k, c in enumerate(cells([F.col(c) for c in xyz], side)))).count().agg(F.max("count")).first()[0]
        if (fullest or 0) <= CROWD:
            break
        side /= 2
    return side


def nearest(left: DataFrame, right: DataFrame, key: str, xyz: list[str], carry: list[str], radius: float, by: list[str] | None = None) -> DataFrame:
    """left with the nearest row of right: distance and carried columns; rows whose group has none are left out.

    Cells are as wide as the radius, or less where right is crowded, so a row meets few others however dense right is. Rows that find none
    that near look for it in nested grids, so one that is far from all meets few others, too. key tells rows of a group apart.
    """
    by = by or []
    best = F.min_by(F.struct(F.sqrt("distance2").alias("distance"), *(F.col(f"r.{c}").alias(f"nearest_{c}") for c in carry)), F.struct("distance2", *(F.col(f"r.{c}") for c in carry)))
    group = F.struct(F.lit(0), *by)
    ids = left.withColumn("_id", F.struct(*by, key)).withColumn("_g", group)
    # of the rows in one place only the first can be the nearest
    place = list(dict.fromkeys([*by, *xyz]))
    others = [c for c in dict.fromkeys(carry) if c not in place]
    first = [F.min(F.struct(*others)).alias("_f")] if others else [F.first(F.lit(0)).alias("_f")]
    right = written(right.groupBy(*place).agg(*first).select(*place, *(F.col(f"_f.{c}").alias(c) for c in others)), "places")
    side = uncrowded_side(right.withColumn("_g", group), xyz, radius)
    close = within(ids.select("_id", *by, *xyz), right, xyz, side, by)
    found = written(close.groupBy(F.col("l._id").alias("_id")).agg(best.alias("_n")), "nearest")
    rest = written(ids.join(found, "_id", "left_anti").select("_id", "_g", *xyz), "rest")
    if rest.limit(1).count():
        sided = right.select(group.alias("_g"), F.struct(*dict.fromkeys([*xyz, *carry])).alias("r"))
        found = found.unionByName(_far_nearest(rest, sided, xyz, side, best))
    return ids.join(found, "_id").select(*left.columns, "_n.*")


def with_paths(particles: DataFrame, manifests: DataFrame, key: str = "tomogram_id") -> DataFrame:
    """Every particle with what is known of its volume; nulls where nothing is."""
    return particles.join(manifests, key, "left")


def members_by_half(particles: DataFrame, assignments: DataFrame, cluster: str, key: str = "particle_id") -> DataFrame:
    """Particles of one class; an error unless both halves have some."""
    found = particles.join(assignments.where(F.col("cluster_id") == cluster), key, "left_semi")
    if {r[0] for r in found.select("half_set").distinct().collect()} != {"A", "B"}:
        raise ValueError(f"class {cluster} needs members in both halves")
    return found


def with_roll(particles: DataFrame, angles: DataFrame, key: str = "particle_id") -> DataFrame:
    """Orientation turned about its normal where an in-plane angle is known."""
    from ..functions.geometry import roll_about_normal

    joined = particles.join(angles.select(key, F.col("inplane_angle_degrees").alias("_roll")), key, "left")
    turned = F.when(F.col("_roll").isNotNull(), roll_about_normal(F.col("orientation"), F.col("_roll"))).otherwise(F.col("orientation"))
    return joined.withColumn("orientation", turned).drop("_roll")


def all_candidates(classes: DataFrame, panel: DataFrame) -> DataFrame:
    """Every class with every candidate of the panel, which is a short list by nature."""
    return classes.crossJoin(F.broadcast(panel))


def split_accepted(particles: DataFrame, rejected: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    return particles.join(rejected, key, "left_anti"), particles.join(rejected, key, "left_semi")


def pending(work: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Work units that aren't finished."""
    return work.join(done, key, "left_anti")


def density(counts: DataFrame, areas: DataFrame, key: str) -> DataFrame:
    """Counts and areas of either side, missing ones 0, and the count per 1000 of area (0 without area)."""
    both = counts.join(areas, key, "full").select(key, F.coalesce("n_picks", F.lit(0)).cast("long").alias("n_picks"), F.coalesce("area", F.lit(0.0)).alias("area"))
    return both.withColumn("per_1000", F.when(F.col("area") == 0, F.lit(0.0)).otherwise(F.col("n_picks") / F.col("area") * 1000))


def remapped(labels: DataFrame, mapping: DataFrame) -> DataFrame:
    """label_b becomes the label it was matched to, or stays."""
    return labels.join(F.broadcast(mapping), "label_b", "left").withColumn("label", F.coalesce("label_a", "label_b")).drop("label_a")


def first_reference(files: DataFrame) -> DataFrame:
    """One path for each class and half: the first by name; both halves of a class must differ."""
    out = files.groupBy("class_id", "half_set").agg(F.min("path").alias("path"))
    same = out.groupBy("class_id", "path").count().where("count > 1")
    if same.limit(1).count():
        raise ValueError("both halves of a class have the same reference")
    return out


def labels_for(manifests: DataFrame, labels: DataFrame) -> DataFrame:
    """Label file of each tomogram: <id>_labelled first, else the first stem that begins with the id, else none.

    Stems meet the ids by equality on their own beginnings, of the lengths that ids have.
    """
    lengths = F.broadcast(manifests.agg(F.array_sort(F.collect_set(F.length("tomogram_id"))).alias("_lengths")))
    cut = labels.crossJoin(lengths).withColumn("_n", F.explode("_lengths")).where(F.length("stem") >= F.col("_n")).withColumn("_id", F.expr("substring(stem, 1, _n)"))
    rank = F.struct((F.col("stem") != F.concat("_id", F.lit("_labelled"))).cast("int"), F.col("stem"))
    best = cut.join(manifests.select("tomogram_id").distinct(), F.col("_id") == F.col("tomogram_id"), "left_semi").groupBy("_id").agg(F.min_by(F.struct(*labels.columns), rank).alias("_label"))
    return manifests.join(best, F.col("tomogram_id") == F.col("_id"), "left").select(*manifests.columns, *(F.col(f"_label.{c}").alias(c) for c in labels.columns))
