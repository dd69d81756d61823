"""Near-duplicate groups: one-permutation MinHash with optimal densification, banded buckets, star edges.

1. Each text becomes its set of word-shingle hashes; texts with equal sets are one class from here on, under
   their smallest doc_id. One permutation's hash range is cut into bins, a bin keeps its least hash, and an empty
   bin takes the value of the first full bin in a random order of its own. Bands of bins name buckets.
2. In each bucket every member gets one candidate edge, to the bucket's smallest id: a star, as many edges as
   members. Edges are confirmed on the full sets and joined into components.
3. A star can miss a link between two members of which neither is near the centre. Buckets that still hold several
   components become stars about other members, drawn by a hash of their own, with edges to the other components, as long as
   that finds links, for a few rounds. Again there are as many edges as members.
4. All members of buckets that hold several components even then go through an exact join: shingles are ordered by rarity, and
   two sets that are near enough must share one among the first few of each, how few depending on both sizes, and
   far enough from each one's end for the overlap that is needed.
   For texts that are too far from a common origin these few are mostly their own edits, so groups of far
   copies don't meet pair by pair. Only pairs across components are confirmed.

With 32 bands of 6 bins, two texts at similarity 0.85 miss all buckets with a chance of about 3e-7, at 0.8 of 6e-5.
More and shorter bands miss fewer, but also gather texts that are further apart. Without the stars of step 3 the exact join had
310,294 rows on a table with a large group of near copies.

The exact join's worst case: texts that share many rare shingles and are yet not near enough, so that they stay in
components of their own, meet pair by pair in step 4; as many pairs as there are such neighbours. A shingle that very
many of them have is dealt out over several tasks.

Rows: null and empty texts, and texts without words, have no shingles and are alone. A repeated row gets the same
result each time; a doc_id names one text. Rows with a null doc_id are left out of the links, with a null
component, and kept. An empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import discard
from ._common import if_small, mapped, materialise
from ._textnp import buffers, mix, shingles, words

BANDS, ROWS = 32, 6
SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"
#: Sizes of sets are classed by powers of this for the exact join.
STEP = 1.05
#: Members of one shingle's join, or of one star, that go to one key.
DEALT = 256
#: Rounds of stars about other members.
TURNS = 3


@lru_cache(maxsize=4)
def _layout(bands: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = bands * rows
    edges = np.array([(k << 64) // bins for k in range(bins)], dtype=np.uint64)
    orders = np.argsort(np.random.default_rng(20).random((bins, bins)), axis=1)
    return edges, orders, mix(np.arange(rows, dtype=np.uint64), 17) | np.uint64(1)


def band_keys(own: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Bucket keys of a sorted array of distinct hashes, which isn't empty."""
    edges, orders, factors = _layout(bands, rows)
    at = np.searchsorted(own, edges)
    full = np.append(at[1:], len(own)) > at
    values = own[np.minimum(at, len(own) - 1)]
    if not full.all():
        source = orders[np.arange(len(edges)), np.argmax(full[orders], axis=1)]
        values = np.where(full, values, values[source])
    return mix((values.reshape(bands, rows) * factors).sum(axis=1, dtype=np.uint64), 19).view(np.int64)


def _sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    data, offsets = buffers(texts)
    hashes, _, at = words(data, offsets)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield shingles(hashes[a:b], width)


def signatures(docs: DataFrame, width: int, key: str, column: str, bands: int, rows: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                sizes, a, b, keys = [], [], [], []
                for own in _sets(batch.column(1), width):
                    sizes.append(len(own))
                    a.append(int(mix(own, 23).sum(dtype=np.uint64).view(np.int64)) if len(own) else 0)
                    b.append(int(mix(own, 29).sum(dtype=np.uint64).view(np.int64)) if len(own) else 0)
                    keys.append(band_keys(own, bands, rows) if len(own) else np.zeros(0, np.int64))
                ends = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), lists], ["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return mapped(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(column).alias("text")), sign, SIGNATURE)


def full_sets(docs: DataFrame, width: int, key: str, column: str) -> DataFrame:
    """id and the whole set of each row."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                own = [x.view(np.int64) for x in _sets(batch.column(1), width)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(own)))], ["id", "own"])

    return mapped(docs.select(F.col(key).cast("long").alias("id"), F.col(column).alias("text")), collect, "id long, own array<long>")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those with 100 * intersection >= percent * union on the full sets.

    Each pair brings the set of b, which few pairs have, to that of a. An `a` of many pairs, as a large star's centre, is
    dealt out: DEALT of its pairs on average go to a key of their own, with a copy of the one set of a. So no key grows with a star, and the
    centre's set moves once for so many members.
    """
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / DEALT).cast("int").alias("deals")).where("deals > 1")
    many = materialise(many.withColumnRenamed("a", "_many"), "many")
    small = if_small(many)
    deals = F.coalesce("deals", F.lit(1))
    left = sets.join(small, F.col("id") == F.col("_many"), "left").select(F.col("id").alias("a"), F.explode(F.sequence(F.lit(0), deals - 1)).alias("deal"), F.col("own").alias("own_a"))
    right = sets.select(F.col("id").alias("b"), F.col("own").alias("own_b"))
    placed = pairs.join(small, F.col("a") == F.col("_many"), "left").select("a", "b", F.pmod(F.xxhash64("b"), deals).cast("int").alias("deal"))
    both = F.size(F.array_intersect("own_a", "own_b"))
    possible = placed.join(right, "b").join(left, ["a", "deal"]).where(
        (100 * F.least(F.size("own_a"), F.size("own_b")) >= percent * F.greatest(F.size("own_a"), F.size("own_b")))
    )
    out = materialise(possible.where(100 * both >= percent * (F.size("own_a") + F.size("own_b") - both)).select("a", "b"), "links")
    discard(many)
    return out


def components(edges: DataFrame) -> DataFrame:
    """id and component (smallest id reachable) of each id on an edge (a, b).

    Alternates two steps until nothing changes: every node hands its neighbourhood's least to its larger neighbours,
    then to its smaller ones. Each step shuffles the edges once and writes them to the shared folder.
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        # large star: of each node, the larger neighbours point to the least of neighbourhood and node
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialise(large, "large")
        # small star: the smaller neighbours and the node itself point to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        small = materialise(small, "small")
        sums = [x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for x in (now, small)]
        discard(now, large)
        now = small
        if sums[0] == sums[1]:
            break
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def joined_up(placed: DataFrame, links: DataFrame) -> DataFrame:
    """id and component once more links (a, b) are known; ids in placed (id, component) are their own component if they aren't there.

    Only the graph of components is gone through, which has an edge for each link between two of them.
    """
    ends = links
    for side in "ab":
        ends = ends.join(placed.select(F.col("id").alias(side), F.col("component").alias(f"_{side}")), side, "left").withColumn(f"_{side}", F.coalesce(f"_{side}", side))
    ends = materialise(ends, "ends")
    onto = components(ends.select(F.col("_a").alias("a"), F.col("_b").alias("b"))).select(F.col("id").alias("_from"), F.col("component").alias("_to"))
    every = placed.unionByName(ends.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("_a").alias("component")), F.struct(F.col("b").alias("id"), F.col("_b").alias("component")))).alias("e")).select("e.*")).distinct()
    out = materialise(every.join(onto, F.col("component") == F.col("_from"), "left").select("id", F.coalesce("_to", "component").alias("component")), "components")
    discard(ends)
    return out


def rare_prefix_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Exact candidates (a, b) across components among members (id, component), by prefixes of rare shingles."""
    own = materialise(sets.join(members, "id"), "members")
    each = own.select("id", F.explode("own").alias("shingle"))
    seen = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("times"))
    ordered = (
        each.join(seen, "shingle")
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("times", "shingle"))).alias("ordered"))
        .join(own.select("id", "component"), "id")
    )
    n = F.size("ordered")
    least = F.ceil(n * F.lit(percent) / 100)
    klass = lambda x: F.floor(F.log(x.cast("double")) / F.lit(float(np.log(STEP))) + 1e-9)
    spread = ordered.select(
        "id", "component", "ordered", n.alias("n"), least.alias("least"), klass(n).alias("own_class"),
        F.explode(F.sequence(klass(least), klass(F.floor(n * 100 / F.lit(percent))))).alias("other_class"),
    )
    # the smallest partner in that class asks for the smallest overlap, so for the longest prefix
    smallest = F.greatest("least", F.ceil(F.pow(F.lit(STEP), F.col("other_class") - F.lit(1e-6))))
    overlap = F.ceil(F.lit(percent) * (F.col("n") + smallest) / F.lit(100 + percent) - F.lit(1e-9))
    prefix = F.least("n", F.greatest(F.lit(1), F.col("n") - overlap + 1)).cast("int")
    keys = spread.select(
        "id", "component",
        F.least("own_class", "other_class").alias("low"), F.greatest("own_class", "other_class").alias("high"), "own_class", "n",
        F.posexplode(F.transform(F.slice("ordered", F.lit(1), prefix), lambda x: x["shingle"])).alias("place", "shingle"),
    )
    keys = materialise(keys, "prefixes")
    at = ["low", "high", "shingle"]
    mixed = keys.groupBy(*at).agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.ceil(F.count(F.lit(1)) / DEALT).cast("int").alias("deals")).where("c0 <> c1")
    keys = keys.join(mixed.select(*at, "deals"), at)
    # a shingle that many have is dealt out: one side's members by their id, the other's to each part
    one = keys.withColumn("deal", F.pmod(F.xxhash64("id"), F.col("deals")).cast("int")).alias("x")
    two = keys.withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).alias("y")
    on = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in [*at, "deal"]]
    crossed = (F.col("x.component") != F.col("y.component")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.own_class") + F.col("y.own_class") == F.col("x.low") + F.col("x.high"))
    # at the first shingle that two sets share, what follows it in each bounds the overlap
    rest = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    enough = F.lit(100 + percent) * rest >= F.lit(percent) * (F.col("x.n") + F.col("y.n"))
    return one.join(two, [*on, crossed, enough]).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, key: str = "doc_id", column: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; links at 100 * intersection >= percent * union."""
    signed = materialise(signatures(docs, width, key, column, bands, rows), "signatures")
    found = signed.where("doc_id is not null and n_shingles > 0")
    classes = found.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("id"), F.min_by("bands", "doc_id").alias("bands"))
    classes = materialise(classes, "classes")
    keyed = classes.select("id", F.posexplode("bands").alias("band", "bucket"))
    stars = keyed.groupBy("band", "bucket").agg(F.min("id").alias("centre"), F.max("id").alias("other")).where("centre <> other").select("band", "bucket", "centre")
    members = materialise(keyed.join(stars, ["band", "bucket"]), "buckets")
    candidates = materialise(members.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct(), "stars")
    wanted = candidates.select(F.col("a").alias("id")).unionByName(candidates.select(F.col("b").alias("id"))).distinct()
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(column).alias("text"))
    picked = texts.join(if_small(materialise(wanted, "wanted")), "id", "left_semi")
    sets = materialise(full_sets(picked, width, "id", "text").groupBy("id").agg(F.first("own").alias("own")), "sets")
    links = confirm(candidates, sets, percent)
    final = materialise(components(links), "components")
    in_bucket = ["band", "bucket"]
    for turn in range(TURNS):
        placed = members.join(final, "id", "left").select("id", *in_bucket, F.coalesce("component", "id").alias("component"))
        drawn = F.struct(F.xxhash64(F.lit(turn), "id", "band"), "id")
        others = placed.groupBy(*in_bucket).agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.min_by(F.struct("id", "component"), drawn).alias("o")).where("c0 <> c1")
        others = others.select(*in_bucket, F.col("o.id").alias("a"), F.col("o.component").alias("_c"))
        again = materialise(placed.join(others, in_bucket).where("component <> _c").select("a", F.col("id").alias("b")).distinct(), "stars")
        more = confirm(again, sets, percent)
        found_some = more.limit(1).count()
        if found_some:
            final = joined_up(final, more)
        discard(again, more)
        if not found_some:
            break
    placed = members.join(final, "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_buckets = placed.groupBy(*in_bucket).agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1").select(*in_bucket)
    rest = materialise(placed.join(open_buckets, in_bucket).select("id", "component").distinct(), "rest")
    last = materialise(rare_prefix_pairs(rest, sets, percent), "pairs")
    final = joined_up(final, confirm(last, sets, percent))
    discard(members, candidates, sets, links, rest, last)
    named = classes.join(final, "id", "left").select("set_a", "set_b", F.col("n_shingles").alias("size"), F.coalesce("component", "id").alias("component"))
    s, n = signed.alias("s"), named.alias("n")
    same = (F.col("s.set_a") == F.col("n.set_a")) & (F.col("s.set_b") == F.col("n.set_b")) & (F.col("s.n_shingles") == F.col("n.size"))
    out = s.join(n, same, "left").select("s.doc_id", "s.n_shingles", F.when(F.col("s.doc_id").isNotNull(), F.coalesce("n.component", "s.doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
