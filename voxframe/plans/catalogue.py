"""Queries of the engine over the shared tables, with the SQL that gives the same rows.

Embeddings serve as positions (their first three values) and as small volumes, labels as groups, events as scored picks, orders and line
items as work units. Doubles are rounded to six places on both sides.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as X
from ..kernels import signal as S
from ..kernels import volume as V
from ..operators import aggregates as A
from ..operators import decoys as D
from ..operators import filters as P
from ..operators import grouping as C
from ..operators import joins as J
from ..operators import review as R
from ..operators import windows as W

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL if there is one."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column | str) -> Column:
    return F.round(c, 6) + F.lit(0.0)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, x, y, z: positions spread around 50 by the first three values."""
    e = table(spark, sf_dir, "embeddings")
    at = lambda k: (F.col("embedding")[k].cast("double") * 200 + 50).alias("xyz"[k])
    return e.select("vec_id", "label", at(0), at(1), at(2))


POINTS = "select vec_id, label, embedding[1]::double * 200 + 50 as x, embedding[2]::double * 200 + 50 as y, embedding[3]::double * 200 + 50 as z from embeddings"
NORMALS = "select vec_id, embedding[1]::double as x, embedding[2]::double as y, embedding[3]::double as z from embeddings"


def normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", *(F.col("embedding")[k].cast("double").alias("xyz"[k]) for k in range(3)))


# scalar functions


@query(f"""
with v as ({NORMALS}), n as (select vec_id, x / sqrt(x*x+y*y+z*z) as x, y / sqrt(x*x+y*y+z*z) as y, z / sqrt(x*x+y*y+z*z) as z from v)
select vec_id, round((1+z)/sqrt((1+z)*(1+z)+x*x+y*y), 6) + 0.0 as w, round(-y/sqrt((1+z)*(1+z)+x*x+y*y), 6) + 0.0 as qx,
    round(x/sqrt((1+z)*(1+z)+x*x+y*y), 6) + 0.0 as qy, 0.0::double as qz from n
""")
def fn2_quaternion_from_normal(spark, sf_dir):
    q = normals(spark, sf_dir).withColumn("q", G.quaternion_from_normal(*map(F.col, "xyz")))
    return q.select("vec_id", r6("q.w").alias("w"), r6("q.x").alias("qx"), r6("q.y").alias("qy"), r6("q.z").alias("qz"))


@query(f"""
with v as ({NORMALS}), n as (select vec_id, x / sqrt(x*x+y*y+z*z) as x, y / sqrt(x*x+y*y+z*z) as y, z / sqrt(x*x+y*y+z*z) as z from v),
q as (select vec_id, (1+z)/sqrt((1+z)*(1+z)+x*x+y*y) as w, -y/sqrt((1+z)*(1+z)+x*x+y*y) as x, x/sqrt((1+z)*(1+z)+x*x+y*y) as y, radians((vec_id % 360)::double)/2 as h from n),
p as (select vec_id, w*cos(h) as w, x*cos(h)+y*sin(h) as x, y*cos(h)-x*sin(h) as y, w*sin(h) as z from q)
select vec_id, round(w/sqrt(w*w+x*x+y*y+z*z), 6) + 0.0 as w, round(x/sqrt(w*w+x*x+y*y+z*z), 6) + 0.0 as qx,
    round(y/sqrt(w*w+x*x+y*y+z*z), 6) + 0.0 as qy, round(z/sqrt(w*w+x*x+y*y+z*z), 6) + 0.0 as qz from p
""")
def fn3_roll_about_normal(spark, sf_dir):
    q = normals(spark, sf_dir).withColumn("q", G.quaternion_from_normal(*map(F.col, "xyz")))
    p = q.withColumn("p", G.roll_about_normal(F.col("q"), (F.col("vec_id") % 360).cast("double")))
    return p.select("vec_id", r6("p.w").alias("w"), r6("p.x").alias("qx"), r6("p.y").alias("qy"), r6("p.z").alias("qz"))


@query(f"""
with v as ({NORMALS}), n as (select vec_id, x / sqrt(x*x+y*y+z*z) as x, y / sqrt(x*x+y*y+z*z) as y, z / sqrt(x*x+y*y+z*z) as z from v)
select vec_id, round(x, 5) + 0.0 as m02, round(y, 5) + 0.0 as m12, round(z, 5) + 0.0 as m22 from n
""")
def fn4_rotation_matrix(spark, sf_dir):
    """The matrix takes +z to the normal, so its last column is the normal."""
    q = normals(spark, sf_dir).withColumn("m", G.rotation_rows(G.quaternion_from_normal(*map(F.col, "xyz"))))
    return q.select("vec_id", *((F.round(F.col("m")[k], 5) + F.lit(0.0)).alias(n) for k, n in ((2, "m02"), (5, "m12"), (8, "m22"))))


@query(f"""
with v as ({NORMALS}), n as (select vec_id, x / sqrt(x*x+y*y+z*z) as x, y / sqrt(x*x+y*y+z*z) as y, z / sqrt(x*x+y*y+z*z) as z from v)
select vec_id, round(degrees(acos(least(greatest(z, -1), 1))), 5) + 0.0 as tilt, round(degrees(atan2(y, x)), 5) + 0.0 as psi from n
""")
def fn5_tilt_psi(spark, sf_dir):
    q = normals(spark, sf_dir).withColumn("t", G.tilt_psi(G.quaternion_from_normal(*map(F.col, "xyz"))))
    return q.select("vec_id", (F.round("t.tilt", 5) + F.lit(0.0)).alias("tilt"), (F.round("t.psi", 5) + F.lit(0.0)).alias("psi"))


@query(f"with v as ({NORMALS}) select vec_id, round(degrees(asin(least(abs(z)/sqrt(x*x+y*y+z*z), 1))), 6) + 0.0 as angle from v")
def fn6_beam_angle(spark, sf_dir):
    return normals(spark, sf_dir).select("vec_id", r6(G.beam_angle(*map(F.col, "xyz"))).alias("angle"))


@query("select doc_id, printf('p%06d', row_number() over (order by lang, doc_id) - 1) as particle_id from documents")
def fn12_numbered(spark, sf_dir):
    return X.numbered(table(spark, sf_dir, "documents").select("doc_id", "lang"), "p", [F.col("lang"), F.col("doc_id")]).select("doc_id", "particle_id")


@query("select l_orderkey, l_linenumber, l_partkey, printf('p%06d', row_number() over (order by l_partkey, l_orderkey, l_linenumber) - 1) as particle_id from lineitem")
def fn12_numbered_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return X.numbered(lines, "p", [F.col(c) for c in ("l_partkey", "l_orderkey", "l_linenumber")])


@query("select vec_id, case when label % 5 = 0 then 'noise' else printf('c%02d', label) end as cluster_id from embeddings")
def fn11_cluster_name(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", X.cluster_name(F.when(F.col("label") % 5 == 0, F.lit(-1)).otherwise(F.col("label"))).alias("cluster_id"))


@query("select vec_id, case when label > 0 then printf('t%d:v%04d', vec_id % 7, label) else '' end as vesicle_id from embeddings")
def fn10_vesicle_name(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", X.vesicle_name(F.format_string("t%d", F.col("vec_id") % 7), F.col("label")).alias("vesicle_id"))


@query("select user_id, string_agg(distinct event_type, '+' order by event_type) as sources from events group by user_id")
def fn17_joined_sources(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(X.joined_sources(F.col("event_type")).alias("sources"))


@query("select event_id, nullif(trim(event_type), '') as kind, json_extract(props, '$.k')::bigint as k from events")
def fn19_blank_and_json(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", X.blank_to_null(F.col("event_type")).alias("kind"), X.json_option(F.col("props"), "k bigint")["k"].alias("k"))


@query("select p_partkey, regexp_extract(p_name, '^(c[0-9]+)', 1) as class_id, regexp_replace(p_type, '[^\\w.-]', '_', 'g') as file_name, starts_with(p_brand, 'decoy-') as decoy from part")
def fn20_names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", X.class_of_file(F.col("p_name")).alias("class_id"), X.safe_file_name(F.col("p_type")).alias("file_name"), X.is_decoy(F.col("p_brand")).alias("decoy"))


@query("select doc_id, array_to_string(list_filter(list_transform(string_split(lang || ' , ' || source || ',,', ','), lambda x: trim(x)), lambda x: x <> ''), ';') as items from documents")
def fn21_comma_list(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.array_join(X.comma_list(F.concat("lang", F.lit(" , "), "source", F.lit(",,"))), ";").alias("items"))


@query("select doc_id, sha256(text) as digest from documents")
def fn23_sha256(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.sha256(F.col("text")).alias("digest"))


# filters


@query(f"select vec_id from ({POINTS}) where x between 12 and 87 and y between 12 and 87 and z between 12 and 87")
def flt1_inside_margin(spark, sf_dir):
    return points(spark, sf_dir).where(P.inside_margin([F.col(c) for c in "xyz"], [100, 100, 100], 12)).select("vec_id")


@query("""
with m as (select median(l_quantity) as c from lineitem), s as (select c, 1.4826 * median(abs(l_quantity - c)) as s from lineitem, m group by c)
select l_returnflag, count(*) filter (where (l_quantity - c) / s >= 0.5 + sqrt(2 * ln(2))) as accepted, count(*) filter (where (l_quantity - c) / s < 0.5 + sqrt(2 * ln(2))) as rejected
from lineitem, s group by l_returnflag
""")
def flt2_threshold(spark, sf_dir):
    z = A.robust_normalise(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity"), "l_quantity")
    ok = P.accepted(F.col("z"), G.effective_threshold(0.5, 2))
    return z.groupBy("l_returnflag").agg(F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"))


@query(f"select vec_id from ({POINTS}) where x between 11*sqrt(3) and 100-11*sqrt(3) and y between 11*sqrt(3) and 100-11*sqrt(3) and z between 11*sqrt(3) and 100-11*sqrt(3)")
def flt4_box_fits(spark, sf_dir):
    return points(spark, sf_dir).where(P.box_fits([F.col(c) for c in "xyz"], [100.0] * 3, 23)).select("vec_id")


@query(f"select label, count(*) filter (where vec_id % 3 <> 0 and x between 20 and 80) as kept, count(*) filter (where not (vec_id % 3 <> 0 and x between 20 and 80)) as skipped from ({POINTS}) group by label")
def flt5_kept_and_skipped(spark, sf_dir):
    kept, skipped = P.kept_and_skipped(points(spark, sf_dir), (F.col("vec_id") % 3 != 0) & F.col("x").between(20, 80))
    both = kept.select("label", F.lit(1).alias("k")).unionByName(skipped.select("label", F.lit(0).alias("k")))
    return both.groupBy("label").agg(F.sum("k").alias("kept"), F.sum(1 - F.col("k")).alias("skipped"))


@query("select event_id from events where event_type = 'x' or value is null or value <= 40")
def flt6_beam_angle(spark, sf_dir):
    return table(spark, sf_dir, "events").where((F.col("event_type") == "x") | P.under_angle(F.col("value"), 40)).select("event_id")


@query(f"select vec_id from ({POINTS}) where abs(z - 50) <= 6")
def flt7_slab(spark, sf_dir):
    return points(spark, sf_dir).where(P.in_slab(F.col("z"), 50, 6)).select("vec_id")


@query("select vec_id from embeddings where len(list_filter(embedding, lambda x: x <> 0)) > 0 and label <> 3")
def flt8_not_degenerate(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").where(P.not_degenerate(F.col("embedding")) & (F.col("label") != 3)).select("vec_id")


@query(f"""select vec_id from ({POINTS}) where
    ((((30 > y) <> (70 > y)) and x < (70.0-40.0)*(y-30.0)/(70.0-30.0)+40.0)::int + (((70 > y) <> (50 > y)) and x < (30.0-70.0)*(y-70.0)/(50.0-70.0)+70.0)::int
    + (((50 > y) <> (30 > y)) and x < (40.0-30.0)*(y-50.0)/(30.0-50.0)+30.0)::int) % 2 = 1""")
def flt11_lasso(spark, sf_dir):
    return points(spark, sf_dir).where(P.in_polygon(F.col("x"), F.col("y"), [(40, 30), (70, 70), (30, 50)])).select("vec_id")


@query("select count(distinct toxic) as n_flags, count(distinct toxic) = 1 as pure from labels")
def flt16_purity(spark, sf_dir):
    return P.is_pure(table(spark, sf_dir, "labels"), F.col("toxic"))


@query("select count(*) filter (where toxic = 0) as real_count, count(*) filter (where toxic = 1) as decoy_count, count(*) filter (where toxic = 1) >= 0.5 * count(*) filter (where toxic = 0) as enough from labels")
def flt17_comparable(spark, sf_dir):
    t = table(spark, sf_dir, "labels")
    return P.comparable(t.where("toxic = 0"), t.where("toxic = 1"))


@query("""
select vec_id, round(x, 3) + 0.0 as x, round(y, 3) + 0.0 as y, round(z, 3) + 0.0 as z, e as element, case e when 'C' then 6.0 when 'N' then 7.0 when 'FE' then 26.0 when 'CL' then 17.0 else 6.0 end::double as weight
from (select *, case label % 5 when 0 then 'C' when 1 then 'N' when 2 then 'FE' when 3 then 'CL' else 'X' end as e from (""" + POINTS + """)) where label <> 9
""")
def src13_fixed_width(spark, sf_dir):
    """Lines of fixed columns made from positions; one label's records are of another kind, and elements stand in either of two places."""
    from ..sources.records import atoms

    p = points(spark, sf_dir)
    kind = F.element_at(F.array(*map(F.lit, ("C", "N", "Fe", "cl", "X"))), (F.col("label") % 5 + 1).cast("int"))
    named = F.when(F.length(kind) == 1, F.lit("  ")).otherwise(F.lpad(kind, 2, " "))
    record = F.when(F.col("label") == 9, "REMARK").when(F.col("label") % 2 == 0, "ATOM  ").otherwise("HETATM")
    line = F.concat(record, F.format_string("%5d %-4s LIG A%4d    %8.3f%8.3f%8.3f  1.00  0.00          ", F.col("vec_id") % 99999, kind, F.col("label"), "x", "y", "z"), named)
    found = atoms(p.select("vec_id", line.alias("value")))
    return found.select("vec_id", *((F.round(c, 3) + F.lit(0.0)).alias(c) for c in "xyz"), "element", "weight")


# joins

PREFIXES = ["ECONOMY", "ECONOMY ANODIZED", "LARGE", "LARGE B", "MEDIUM", "PROMO", "PROMO P", "S", "STANDARD", "STANDARD POLISHED TIN", "type", "type1", "Type", "TYPE"]


@query(f"""
with p as (select unnest({PREFIXES!r}) as prefix), m as (
    select p_partkey, p_type, prefix, row_number() over (partition by p_partkey order by length(prefix) desc) as r from part left join p on starts_with(p_type, prefix))
select p_partkey, p_type, prefix from m where r = 1
""")
def join1_longest_prefix(spark, sf_dir):
    prefixes = spark.createDataFrame([(x,) for x in PREFIXES], "prefix string")
    return J.longest_prefix(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_type", prefixes, "prefix")


@query("select o_orderkey, c_name is null as missing, coalesce(c_mktsegment, 'none') as segment from orders left join customer on o_custkey = c_custkey and c_acctbal > 0")
def join2_left_outer(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")), table(spark, sf_dir, "customer").where("c_acctbal > 0")
    return J.with_paths(o, c, "c_custkey").select("o_orderkey", F.col("c_name").isNull().alias("missing"), F.coalesce("c_mktsegment", F.lit("none")).alias("segment"))


@query(f"with p as ({POINTS}) select vec_id from p a where label <> 0 and not exists (select 1 from p b where b.label = 0 and (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z) < 100)")
def join5_far_from(spark, sf_dir):
    p = points(spark, sf_dir)
    return J.far_from(p.where("label <> 0"), p.where("label = 0"), ["x", "y", "z"], 10.0).select("vec_id")


@query(f"with p as ({POINTS}) select a.vec_id, count(*) as n from p a join p b on (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z) <= 16 group by a.vec_id")
def join6_within(spark, sf_dir):
    p = points(spark, sf_dir)
    return J.within(p, p, ["x", "y", "z"], 4.0).groupBy(F.col("l.vec_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("n"))


@query(f"with p as ({POINTS}) select a.vec_id, round(min(sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z))), 6) + 0.0 as distance from p a, p b where a.label <> 0 and b.label = 0 group by a.vec_id")
def join7_nearest(spark, sf_dir):
    p = points(spark, sf_dir)
    return J.nearest(p.where("label <> 0"), p.where("label = 0"), "vec_id", ["x", "y", "z"], ["vec_id"], 8.0).select("vec_id", r6("distance").alias("distance"))


@query(f"""
with p as ({POINTS}), l as (select vec_id, case when vec_id % 40 = 1 then -1e4 * vec_id else x end as x, y, case when vec_id % 40 = 2 then 1e5 else z end as z, vec_id % 2 as half from p where label <> 0), r as (select *, vec_id % 2 as half from p where label = 0)
select l.vec_id, round(min(sqrt((l.x-r.x)*(l.x-r.x)+(l.y-r.y)*(l.y-r.y)+(l.z-r.z)*(l.z-r.z))), 5) + 0.0 as distance from l join r using (half) group by l.vec_id
""")
def join7_nearest_far(spark, sf_dir):
    """Some rows lie far from all others."""
    p = points(spark, sf_dir).withColumn("half", F.col("vec_id") % 2)
    moved = p.where("label <> 0").withColumn("x", F.when(F.col("vec_id") % 40 == 1, -1e4 * F.col("vec_id")).otherwise(F.col("x"))).withColumn("z", F.when(F.col("vec_id") % 40 == 2, F.lit(1e5)).otherwise(F.col("z")))
    found = J.nearest(moved, p.where("label = 0"), "vec_id", ["x", "y", "z"], ["vec_id"], 8.0, ["half"])
    return found.select("vec_id", (F.round("distance", 5) + F.lit(0.0)).alias("distance"))


@query("select case when o_custkey % 2 = 0 then 'A' else 'B' end as half_set, count(*) as n from orders where exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R') group by 1")
def join8_members_by_half(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("particle_id"), F.when(F.col("o_custkey") % 2 == 0, "A").otherwise("B").alias("half_set"))
    a = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("particle_id"), F.col("l_returnflag").alias("cluster_id"))
    return J.members_by_half(o, a, "R").groupBy("half_set").agg(F.count(F.lit(1)).alias("n"))


@query("select n_name, r_name from nation, region")
def join10_all_candidates(spark, sf_dir):
    return J.all_candidates(table(spark, sf_dir, "nation").select("n_name"), table(spark, sf_dir, "region").select("r_name"))


@query("""
with c as (select label, vec_id % 2 as h, generate_subscripts(embedding, 1) as k, unnest(embedding)::double as v from embeddings),
m as (select label, h, k, avg(v) as v from c group by all)
select a.label as label_a, b.label as label_b, round(sqrt(sum((a.v-b.v)*(a.v-b.v))), 6) + 0.0 as distance from m a join m b on a.k = b.k where a.h = 0 and b.h = 1 group by all
""")
def join11_centroid_pairs(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("half", F.col("vec_id") % 2)
    return C.centroid_pairs(A.elementwise_mean(e, ["half", "label"], "embedding"), "half", "label").select("label_a", "label_b", r6("distance").alias("distance"))


@query("""
with o as (select o_custkey as k, count(*) as n from orders where o_orderpriority like '1%' or o_orderpriority like '2%' group by 1), c as (select c_custkey as k, abs(c_acctbal) as area from customer where c_mktsegment <> 'BUILDING')
select coalesce(o.k, c.k) as k, coalesce(n, 0) as n_picks, round(coalesce(area, 0), 6) + 0.0 as area, round(case when coalesce(area, 0) = 0 then 0 else coalesce(n, 0) / area * 1000 end, 6) + 0.0 as per_1000 from o full join c on o.k = c.k
""")
def join12_density(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderpriority like '1%' or o_orderpriority like '2%'").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n_picks"))
    c = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("k"), F.abs("c_acctbal").alias("area"))
    return J.density(o, c, "k").select("k", "n_picks", r6("area").alias("area"), r6("per_1000").alias("per_1000"))


@query("select vec_id, case label when 1 then 4 when 2 then 7 else label end as label from embeddings")
def join13_remapped(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("label_b"))
    return J.remapped(e, spark.createDataFrame([(1, 4), (2, 7)], "label_b int, label_a int")).select("vec_id", "label")


@query("select (select count(*) from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity > 49)) as accepted, (select count(*) from orders where exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity > 49)) as rejected")
def join15_accepted_rejected(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    bad = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_orderkey").alias("o_orderkey"))
    accepted, rejected = J.split_accepted(o, bad, "o_orderkey")
    return accepted.agg(F.count(F.lit(1)).alias("accepted")).crossJoin(rejected.agg(F.count(F.lit(1)).alias("rejected")))


@query("select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_linestatus = 'F')")
def join17_pending(spark, sf_dir):
    done = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.pending(table(spark, sf_dir, "orders").select("o_orderkey"), done, ["o_orderkey"])


# aggregates


@query("select value, n from (select round(p_retailprice, 1) as value, count(*) as n, min(p_partkey) as first_at from part group by 1 order by n desc, first_at limit 1)")
def agg1_modal_value(spark, sf_dir):
    return A.modal_value(table(spark, sf_dir, "part"), F.col("p_retailprice"), F.col("p_partkey"), 1)


@query("""
with m as (select l_returnflag as f, median(l_extendedprice) as c from lineitem group by 1), s as (select f, c, 1.4826 * median(abs(l_extendedprice - c)) as s from lineitem join m on f = l_returnflag group by f, c)
select l_orderkey, l_linenumber, round((l_extendedprice - c) / s, 6) + 0.0 as z from lineitem join s on f = l_returnflag
""")
def agg2_robust_normalise(spark, sf_dir):
    z = A.robust_normalise(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"), "l_extendedprice", ["l_returnflag"])
    return z.select("l_orderkey", "l_linenumber", r6("z").alias("z"))


@query("""
with e as (select event_id, value as v, case when user_id % 5 > 0 then event_type end as g from events),
m as (select g, median(v) as c from e group by g), s as (select m.g, c, 1.4826 * median(abs(v - c)) as s from e join m on m.g is not distinct from e.g group by m.g, c)
select event_id, round((v - c) / s, 6) + 0.0 as z from e join s on s.g is not distinct from e.g
""")
def agg2_robust_normalise_nulls(spark, sf_dir):
    """Rows without a group are one group."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("value").alias("v"), F.when(F.col("user_id") % 5 > 0, F.col("event_type")).alias("g"))
    return A.robust_normalise(e, "v", ["g"]).select("event_id", r6("z").alias("z"))


@query(f"""
with p as (select *, x + 2 * y as v from ({POINTS})), near as (select a.vec_id as i, a.label, b.v from p a join p b on a.label = b.label and (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z) <= 225),
own as (select i, count(*) as n, median(v) as m from near group by i), mad as (select near.i, n, m, 1.4826 * median(abs(v - m)) as s from near join own on own.i = near.i group by near.i, n, m),
g as (select label, median(v) as c from p group by label), gs as (select label, c, 1.4826 * median(abs(v - c)) as s from p join g using (label) group by label, c)
select vec_id, round(case when n < 5 then (v - c) / gs.s else (v - m) / case when mad.s > 0 then mad.s else gs.s end end, 6) + 0.0 as z, n < 5 as fell_back from p join mad on i = vec_id join gs using (label)
""")
def agg3_normalise_in_groups(spark, sf_dir):
    """Neighbours and fallback of the row's own group."""
    p = points(spark, sf_dir).withColumn("v", F.col("x") + 2 * F.col("y"))
    return A.normalise_locally(p, "v", ["x", "y", "z"], 15.0, 5, "vec_id", ["label"], out="score").select("vec_id", r6("score").alias("z"), "fell_back")


@query(f"""
with p as (select *, x + 2 * y as v from ({POINTS})), near as (select a.vec_id as i, b.v from p a join p b on (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z) <= 36),
own as (select i, count(*) as n, median(v) as m from near group by i), mad as (select near.i, n, m, 1.4826 * median(abs(v - m)) as s from near join own on own.i = near.i group by near.i, n, m),
g as (select median(v) as c from p), gs as (select c, 1.4826 * median(abs(v - c)) as s from p, g group by c)
select vec_id, round(case when n < 5 then (v - c) / gs.s else (v - m) / case when mad.s > 0 then mad.s else gs.s end end, 6) + 0.0 as z, n < 5 as fell_back from p join mad on i = vec_id, gs
""")
def agg3_normalise_locally(spark, sf_dir):
    p = points(spark, sf_dir).withColumn("v", F.col("x") + 2 * F.col("y"))
    return A.normalise_locally(p, "v", ["x", "y", "z"], 6.0, 5, "vec_id", out="score").select("vec_id", r6("score").alias("z"), "fell_back")


@query("""
with e as (select event_id, value as v, case when user_id % 4 = 0 then '' else event_type end as g from events),
m as (select g, median(v) as c from e where g <> '' group by g), s as (select m.g, c, 1.4826 * median(abs(v - c)) as s from e join m on m.g = e.g group by m.g, c),
wm as (select median(v) as c from e), ws as (select c, 1.4826 * median(abs(v - c)) as s from e, wm group by c)
select event_id, round(case when e.g = '' then (v - ws.c) / ws.s else (v - s.c) / s.s end, 6) + 0.0 as z, e.g = '' as fell_back from e left join s on s.g = e.g, ws
""")
def agg4_normalise_by_vesicle(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.col("value").alias("v"), F.when(F.col("user_id") % 4 == 0, "").otherwise(F.col("event_type")).alias("g"))
    return A.normalise_by_vesicle(e, "v", "g").select("event_id", r6("z").alias("z"), "fell_back")


@query("with e as (select label, generate_subscripts(embedding, 1) - 1 as pos, unnest(embedding)::double as v from embeddings where label <> 0) select label, pos::int as pos, count(*) as n, round(avg(v), 6) + 0.0 as mean from e group by label, pos")
def agg7_class_average(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("cluster_id", F.when(F.col("label") == 0, "noise").otherwise(F.col("label").cast("string")))
    m = A.class_averages(e, "embedding")
    return m.select(F.col("cluster_id").cast("int").alias("label"), "n", F.posexplode("mean").alias("pos", "m")).select("label", "pos", "n", r6("m").alias("mean"))


@query("select least(floor(abs(value) / 15), 5)::int as bin, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 6) + 0.0 as percent from events where value is not null group by 1")
def agg12_closed_histogram(spark, sf_dir):
    return A.closed_histogram(table(spark, sf_dir, "events"), F.abs("value"), 15, 6).select("bin", "n", r6("percent").alias("percent"))


@query("select count(value) as n, round(median(abs(value)), 6) + 0.0 as median, round(avg(abs(value)), 6) + 0.0 as mean from events")
def agg12_angle_report(spark, sf_dir):
    row, _ = A.angle_report(table(spark, sf_dir, "events"), F.abs("value"))
    return row.select("n", r6("median").alias("median"), r6("mean").alias("mean"))


@query("""
with e as (select value as s, event_type in ('click', 'view') as d from events where value is not null), m as (select min(s) as lo, max(s) as hi from e),
c as (select least(floor((s - lo) / (hi - lo) * 15), 14)::int as bin, count(*) filter (where not d) as n_real, count(*) filter (where d) as n_decoy from e, m group by 1)
select b.bin::int as bin, round(lo + (hi - lo) * b.bin / 15, 6) + 0.0 as low, round(lo + (hi - lo) * (b.bin + 1) / 15, 6) + 0.0 as high, coalesce(n_real, 0) as n_real, coalesce(n_decoy, 0) as n_decoy from (select unnest(range(15)) as bin) b cross join m left join c on c.bin = b.bin
""")
def review_histogram(spark, sf_dir):
    h = A.paired_histogram(table(spark, sf_dir, "events"), "value", F.col("event_type").isin("click", "view"))
    return h.select("bin", r6("low").alias("low"), r6("high").alias("high"), "n_real", "n_decoy")


@query("""
select o_orderpriority as cluster_id, round(max(o_totalprice) filter (where o_orderstatus = 'F'), 6) + 0.0 as f, round(max(o_totalprice) filter (where o_orderstatus = 'O'), 6) + 0.0 as o from orders group by 1
""")
def review_score_matrix(spark, sf_dir):
    scores = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("cluster_id"), F.col("o_orderstatus").alias("candidate_protein"), F.col("o_totalprice").alias("fit_score"))
    return R.score_matrix(scores, ["F", "O"]).select("cluster_id", r6("F").alias("f"), r6("O").alias("o"))


@query("""
with e as (select value as s, event_type in ('click', 'view') as d from events), b as (
    select max(s) filter (where not d) as real_best, max(s) filter (where d) as decoy_best, avg(s) filter (where d) as m, stddev_samp(s) filter (where d) as sd, count(*) filter (where not d) as n_real, count(*) filter (where d) as n_decoy from e),
c as (select s, count(*) filter (where not d) as r, count(*) filter (where d) as f from e group by s), w as (select r, f, coalesce(sum(f) over (order by s rows between unbounded preceding and 1 preceding), 0) as below from c)
select round(real_best, 6) + 0.0 as real_best, round(decoy_best, 6) + 0.0 as decoy_best, n_real, n_decoy, round(case when coalesce(sd, 0) = 0 then 'inf'::double else (real_best - m) / sd end, 6) + 0.0 as separation, (select sum(r * (below + f / 2))::double from w) as u from b
""")
def agg13_control_statistics(spark, sf_dir):
    s = A.control_statistics(table(spark, sf_dir, "events"), "value", F.col("event_type").isin("click", "view"))
    return s.select(r6("real_best").alias("real_best"), r6("decoy_best").alias("decoy_best"), "n_real", "n_decoy", r6("separation").alias("separation"), F.col("u").cast("double").alias("u"))


@query("select lang, doc_id // 500 as folder, count(*) as n_files, sha256(string_agg(doc_id::varchar || ':' || sha256(text), chr(10) order by doc_id::varchar || ':' || sha256(text))) as digest from documents group by all")
def agg15_directory_digest(spark, sf_dir):
    """Folders of some hundred files each: a folder's lines are digested in one row."""
    d = table(spark, sf_dir, "documents").withColumn("folder", F.floor(F.col("doc_id") / 500).cast("bigint"))
    return A.directory_digest(d, F.col("doc_id").cast("string"), X.sha256(F.col("text")), ["lang", "folder"])


@query("""
with e as (select vec_id, generate_subscripts(embedding, 1) - 1 as pos, unnest(embedding)::double as v from embeddings), s as (select vec_id, avg(v) as m, stddev_pop(v) as sd from e group by vec_id)
select e.vec_id, pos::int as pos, round((v - m) / case when sd < 1e-6 then 1 else sd end, 5) + 0.0 as z from e join s on s.vec_id = e.vec_id
""")
def agg21_row_standardise(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(A.row_standardise(F.col("embedding"))).alias("pos", "z"))
    return e.select("vec_id", "pos", (F.round("z", 5) + F.lit(0.0)).alias("z"))


@query("""
with e as (select vec_id, label, generate_subscripts(embedding, 1) - 1 as pos, unnest(embedding)::double as v from embeddings), w as (select pos, avg(v) as m, stddev_pop(v) as s from e group by pos), g as (select label, pos, count(*) as n, avg(v) as m, stddev_pop(v) as s from e group by all)
select vec_id, e.pos::int as pos, round(case when n >= 50 then (v - g.m) / case when g.s = 0 then 1 else g.s end else (v - w.m) / case when w.s = 0 then 1 else w.s end end, 5) + 0.0 as z from e join w on w.pos = e.pos join g on g.pos = e.pos and g.label = e.label
""")
def agg22_column_standardise(spark, sf_dir):
    z = A.column_standardise(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label").select("vec_id", F.posexplode("z").alias("pos", "z"))
    return z.select("vec_id", "pos", (F.round("z", 5) + F.lit(0.0)).alias("z"))


@query("with e as (select vec_id, generate_subscripts(embedding, 1) - 1 as pos, unnest(embedding)::double as v from embeddings), s as (select vec_id, sqrt(sum(v * v)) as n from e group by 1) select e.vec_id, pos::int as pos, round(case when n = 0 then 0 else v / n end, 6) + 0.0 as v from e join s on s.vec_id = e.vec_id")
def agg23_power_normalise(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(A.power_normalise(F.col("embedding"))).alias("pos", "v"))
    return e.select("vec_id", "pos", r6("v").alias("v"))


@query("with e as (select vec_id, generate_subscripts(embedding, 1) - 1 as i, unnest(embedding)::double as v from embeddings), s as (select vec_id, v, exp(-0.5 * ((i - 31.5) / 16.0) * ((i - 31.5) / 16.0)) as g from e) select vec_id, round(corr(v, g), 6) + 0.0 as r from s group by vec_id")
def agg24_profile_correlation(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", r6(A.profile_correlation(F.col("embedding"), A.bump(64))).alias("r"))


@query("select count(*) filter (where value < 20) as below, count(*) filter (where value between 20 and 60) as visible, count(*) filter (where value > 60) as above from events")
def agg18_z_diagram(spark, sf_dir):
    return R.z_diagram(table(spark, sf_dir, "events"), F.col("value"), 40, 20)


# windows, ranking, halves


@query("select l_orderkey, l_linenumber, round(l_extendedprice, 6) + 0.0 as score from (select *, row_number() over (partition by l_orderkey order by l_extendedprice desc, l_linenumber) as r from lineitem) where r = 1")
def win1_best_window(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return W.best_of(li, ["l_orderkey"], "l_extendedprice", "l_linenumber").select("l_orderkey", "l_linenumber", r6("l_extendedprice").alias("score"))


@query("""
with s as (select c_nationkey, c_mktsegment, sum(o_totalprice) as score from orders join customer on o_custkey = c_custkey group by all),
r as (select *, row_number() over (partition by c_nationkey order by score desc, c_mktsegment) as n, score - lead(score) over (partition by c_nationkey order by score desc, c_mktsegment) as gap from s)
select c_nationkey, c_mktsegment, round(score, 2) + 0.0 as score, round(gap, 2) + 0.0 as gap from r where n = 1
""")
def win2_rank_candidates(spark, sf_dir):
    """Flagship: the best market segment of each nation by order value, and how far the next one is behind."""
    o, c = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice"), table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    s = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey", "c_mktsegment").agg(F.sum("o_totalprice").alias("score"))
    out = W.rank_with_gap(s, ["c_nationkey"], "score", "c_mktsegment")
    return out.select("c_nationkey", "c_mktsegment", (F.round("score", 2) + F.lit(0.0)).alias("score"), (F.round("gap", 2) + F.lit(0.0)).alias("gap"))


@query(f"""
with p as (select *, vec_id % 3 as picker from ({POINTS})), m as (select label, picker, avg(x) as mx, avg(y) as my, avg(z) as mz from p group by all),
r as (select p.label, p.picker, vec_id, row_number() over (partition by p.label, p.picker order by (x-mx)*(x-mx)+(y-my)*(y-my)+(z-mz)*(z-mz), vec_id) as n from p join m on m.label = p.label and m.picker = p.picker)
select label, picker, vec_id from r where n = 1
""")
def win3_representatives(spark, sf_dir):
    p = points(spark, sf_dir).withColumn("picker", F.col("vec_id") % 3)
    return W.representatives(p, ["label"], "picker", ["x", "y", "z"], "vec_id").select("label", "picker", "vec_id")


@query(f"""
with p as ({POINTS}), m as (select label, avg(x) as mx, avg(y) as my, avg(z) as mz, count(*) as n from p group by label),
r as (select p.label, n, mx, vec_id, row_number() over (partition by p.label order by (x-mx)*(x-mx)+(y-my)*(y-my)+(z-mz)*(z-mz), vec_id) as k from p join m on m.label = p.label)
select label, n, round(mx, 6) + 0.0 as centre_x, vec_id from r where k = 1
""")
def win4_nearest_attributes(spark, sf_dir):
    return W.nearest_attributes(points(spark, sf_dir), ["label"], ["x", "y", "z"], "vec_id", ["vec_id"]).select("label", "n", r6("centre_x").alias("centre_x"), "vec_id")


@query("""
with c as (select o_custkey, count(*) as n from orders group by 1), t as (select sum(n) as t from c), r as (select o_custkey, n, coalesce(sum(n) over (order by md5(o_custkey::varchar), o_custkey rows between unbounded preceding and 1 preceding), 0) as before from c)
select o_custkey, n, case when before < (t + 1) // 2 then 'A' else 'B' end as half_set from r, t
""")
def win5_half_set_split(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return W.split_halves(counts, "o_custkey", "n", F.md5(F.col("o_custkey").cast("string").cast("binary"))).select("o_custkey", "n", "half_set")


@query("""
with e as (select label, generate_subscripts(embedding, 1) - 1 as shell, unnest(embedding)::double as v from embeddings), m as (select label, shell, abs(avg(v)) as v from e group by all),
f as (select label, nullif(min(shell) filter (where v < 0.02), 0) as first_one, max(shell) as last_one from m group by label)
select label, coalesce(first_one, last_one)::int as crossing, first_one is not null as crossed from f
""")
def win6_crossing(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("shell", "v"))
    m = e.groupBy("label", "shell").agg(F.abs(F.avg(F.col("v").cast("double"))).alias("v"))
    return W.crossing(m, ["label"], "shell", "v", 0.02)


@query("""
with l as (select *, row_number() over (partition by l_returnflag order by l_extendedprice, l_orderkey * 10 + l_linenumber) as r from lineitem), k as (select *, row_number() over (partition by l_returnflag order by md5((l_orderkey * 10 + l_linenumber)::varchar), l_orderkey * 10 + l_linenumber) as q from l where r <= 100)
select l_returnflag, l_orderkey, l_linenumber from k where q <= 20
""")
def top1_decoy_pool(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("i"))
    return W.lowest_pool(li, ["l_returnflag"], "l_extendedprice", "i", 20, F.md5(F.col("i").cast("string").cast("binary"))).select("l_returnflag", "l_orderkey", "l_linenumber")


# sets and groups

CONSENSUS = "with e as (select user_id, round_even(value / 10, 0)::int as cell, event_type, value from events) select user_id, cell, count(distinct event_type) as n_pickers, string_agg(distinct event_type, '+' order by event_type) as sources, round(avg(value), 6) + 0.0 as confidence from e group by user_id, cell having count(distinct event_type) >= {k}"


def _consensus(spark, sf_dir, rule):
    e = table(spark, sf_dir, "events").withColumn("cell", F.expr("cast(rint(value / 10) as int)"))
    out = C.consensus(e, ["user_id", "cell"], "event_type", "value", rule, 3)
    return out.select("user_id", "cell", "n_pickers", "sources", r6("confidence").alias("confidence"))


@query(CONSENSUS.format(k=1))
def set1_consensus_union(spark, sf_dir):
    return _consensus(spark, sf_dir, "union")


@query(CONSENSUS.format(k=3))
def set1_consensus_intersection(spark, sf_dir):
    return _consensus(spark, sf_dir, "intersection")


@query("(select o_orderkey from orders where o_orderpriority like '1%' union select o_orderkey from orders where o_totalprice > 200000) except select o_orderkey from orders where o_orderstatus = 'F'")
def set4_rejected_sets(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    some = lambda condition: o.where(condition).select("o_orderkey")
    return R.toggled(some("o_orderpriority like '1%'"), some("o_totalprice > 200000"), some("o_orderstatus = 'F'"))


@query("""
with start as (select o_orderkey as id, 0 as op, true as r from orders where o_orderpriority like '1%'),
first as (select id, 1 as op, r from (select o_orderkey as id, not o_orderpriority like '1%' as r from orders where o_totalprice > 200000)),
kept as (select o_orderkey as id, 2 as op, true as r from orders where o_orderkey % 3 = 0),
back as (select o_orderkey as id, 3 as op, false as r from orders where o_orderstatus = 'F'),
before as (select id, max_by(r, op) as r from (from start union all from first union all from kept union all from back) group by id),
last as (select o_orderkey as id, 4 as op, not coalesce(r, false) as r from orders left join before on id = o_orderkey where o_orderdate >= date '1997-01-01')
select id as o_orderkey from (from start union all from first union all from kept union all from back union all from last) group by id having max_by(r, op)
""")
def set4_review_history(spark, sf_dir):
    """Toggled, rejected, undone, done again, reset, taken back and replaced: a review's log over the orders."""
    o = table(spark, sf_dir, "orders")
    some = lambda condition: o.where(condition).select("o_orderkey")
    review = R.Review([some("o_orderpriority like '1%'")], "o_orderkey")
    review.toggle(some("o_totalprice > 200000"))
    review.reject(some("o_orderkey % 3 = 0"))
    review.undo()
    review.redo()
    review.reset(some("o_orderstatus = 'O'"))
    review.undo()
    review.reset(some("o_orderstatus = 'F'"))
    review.toggle(some("o_orderdate >= date '1997-01-01'"))
    return review.rejected


@query(f"with p as ({POINTS}) select vec_id, side::int as side, round(x * side, 6) + 0.0 as nx from p, (select unnest([1, -1]) as side)")
def set2_both_faces(spark, sf_dir):
    return C.both_faces(points(spark, sf_dir), ["x"]).select("vec_id", "side", r6("n_x").alias("nx"))


@query(f"select vec_id from (select vec_id, row_number() over (partition by floor(x / 8), floor(y / 8), floor(z / 8) order by vec_id) as r from ({POINTS})) where r = 1")
def grp1_downsample(spark, sf_dir):
    return C.downsample(points(spark, sf_dir), ["x", "y", "z"], 8.0, "vec_id").select("vec_id")


GREEDY = """
with recursive p as ({points}), o as (select *, row_number() over (order by score desc, vec_id) as n from p),
b as (select x.n, list(y.n) as earlier from o x join o y on y.n < x.n and {same} and (x.x-y.x)*(x.x-y.x)+(x.y-y.y)*(x.y-y.y)+(x.z-y.z)*(x.z-y.z) <= {square} group by x.n),
s as (select o.n, coalesce(b.earlier, []::bigint[]) as earlier from o left join b on b.n = o.n),
g(n, kept) as (select 0::bigint, []::bigint[] union all select s.n, case when len(list_intersect(g.kept, s.earlier)) = 0 then list_append(g.kept, s.n) else g.kept end from g join s on s.n = g.n + 1)
select vec_id, label, round(score, 6) + 0.0 as score from o where n in (select unnest(kept) from g where n = (select max(n) from g))
"""



@query(GREEDY.format(points=f"select *, x + y as score from ({POINTS})", same="x.label = y.label", square=36))
def grp2_suppress(spark, sf_dir):
    p = points(spark, sf_dir).withColumn("score", F.col("x") + F.col("y"))
    return C.suppress(p, ["label"], ["x", "y", "z"], "score", "vec_id", 6.0).select("vec_id", "label", r6("score").alias("score"))


@query(GREEDY.replace("select vec_id, label, round", "select idx, label, round").format(points=f"select vec_id // 10 * 100 + label as vec_id, vec_id // 10 as idx, label, x, y, z, x + y as score from ({POINTS}) qualify row_number() over (partition by label, vec_id // 10 order by vec_id) = 1", same="x.label = y.label", square=36))
def grp2_suppress_repeated(spark, sf_dir):
    """The same numbers in every group."""
    p = points(spark, sf_dir).groupBy("label", F.floor(F.col("vec_id") / 10).alias("idx")).agg(F.min_by(F.struct("x", "y", "z"), "vec_id").alias("p")).select("label", "idx", "p.*")
    p = p.withColumn("score", F.col("x") + F.col("y"))
    return C.suppress(p, ["label"], ["x", "y", "z"], "score", "idx", 6.0).select("idx", "label", r6("score").alias("score"))


@query(GREEDY.format(points=f"select *, floor(x / 20) as score from ({POINTS})", same="true", square=81))
def grp2_suppress_distributed(spark, sf_dir):
    """Without groups, and with many equal scores."""
    p = points(spark, sf_dir).withColumn("score", F.floor(F.col("x") / 20).cast("double"))
    return C.suppress(p, [], ["x", "y", "z"], "score", "vec_id", 9.0).select("vec_id", "label", r6("score").alias("score"))


# Complete linkage in SQL: of each tomogram, the nearest two groups whose rows are all near enough become one, again and again.
LINKED = """
with recursive pick as ({picks}),
p as (select *, row_number() over (partition by tomogram_id order by picker, idx) as n from pick),
d as (select a.tomogram_id, a.n as i, b.n as j, (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z) as d2 from p a join p b on a.tomogram_id is not distinct from b.tomogram_id and a.n < b.n),
g(tomogram_id, step, own) as (
    select tomogram_id, 0, list(n order by n) from p group by tomogram_id
    union all
    select t, step + 1, list_transform(own, lambda k: case when k = least.b then least.a else k end)
    from (select g.tomogram_id as t, step, own, (select min({{'w': w, 'a': a, 'b': b}}) from (
        select least(own[i], own[j]) as a, greatest(own[i], own[j]) as b, count(*) filter (where d2 < {square}) as c, max(d2) as w
        from d where d.tomogram_id is not distinct from g.tomogram_id and own[i] <> own[j] group by 1, 2) as pairs
        where w < {square}) as least from g) as s where least is not null
),
last as (select tomogram_id, own from g qualify row_number() over (partition by tomogram_id order by step desc) = 1),
member as (select p.*, own[n] as first_n from p join last on p.tomogram_id is not distinct from last.tomogram_id),
about as (select tomogram_id, first_n, picker, avg(x) as mx, avg(y) as my, avg(z) as mz from member group by all),
best as (select member.* from member join about on member.tomogram_id is not distinct from about.tomogram_id and member.first_n = about.first_n and member.picker = about.picker
    qualify row_number() over (partition by member.tomogram_id, member.first_n, member.picker order by (x-mx)*(x-mx)+(y-my)*(y-my)+(z-mz)*(z-mz), idx) = 1),
grouped as (select tomogram_id, first_n, avg(x) as cx, avg(y) as cy, avg(z) as cz, string_agg(picker, '+' order by picker) as sources, avg(confidence) as confidence, count(*)::int as n_pickers from best group by all),
nearest as (select best.*, cx, cy, cz, sources, grouped.confidence as known, n_pickers from best join grouped on best.tomogram_id is not distinct from grouped.tomogram_id and best.first_n = grouped.first_n
    qualify row_number() over (partition by best.tomogram_id, best.first_n order by (x-cx)*(x-cx)+(y-cy)*(y-cy)+(z-cz)*(z-cz), picker) = 1)
select r.tomogram_id, f.picker as first_picker, f.idx as first_idx, round(cx, 6) + 0.0 as x, round(cy, 6) + 0.0 as y, round(cz, 6) + 0.0 as z, sources, round(known, 6) + 0.0 as confidence, n_pickers{carried}
from nearest r join p f on f.tomogram_id is not distinct from r.tomogram_id and f.n = r.first_n where n_pickers >= {least}
"""


def _reconciled(found: DataFrame, *carried: str) -> DataFrame:
    return found.select("tomogram_id", F.col("group_id.picker").alias("first_picker"), F.col("group_id.idx").alias("first_idx"), *(r6(c).alias(c) for c in "xyz"), "sources", r6("confidence").alias("confidence"), "n_pickers", *carried)


@query(LINKED.format(picks=f"select label::varchar as tomogram_id, vec_id as idx, x, y, z, 'p' || vec_id % 2 as picker, x / 100 as confidence from ({POINTS})", square=144, least=1, carried=""))
def grp3_reconcile(spark, sf_dir):
    p = points(spark, sf_dir).select(F.col("label").cast("string").alias("tomogram_id"), F.col("vec_id").alias("idx"), "x", "y", "z", F.format_string("p%d", F.col("vec_id") % 2).alias("picker"), (F.col("x") / 100).alias("confidence"))
    return _reconciled(C.reconcile(p, 12.0, "union", 2))


@query(LINKED.format(
    picks=f"select case when label > 0 then label::varchar end as tomogram_id, vec_id // 3 as idx, x, y, z, 'p' || vec_id % 3 as picker, case when vec_id % 4 > 0 then x / 100 end as confidence, 'v' || vec_id % 7 as vesicle_id, vec_id as row_id from ({POINTS})",
    square=625, least=2, carried=", r.vesicle_id, r.row_id",
))
def grp4_consensus(spark, sf_dir):
    """Three pickers that number their picks alike, unknown confidences and tomograms, and what the nearest representative carries."""
    p = points(spark, sf_dir).select(
        F.when(F.col("label") > 0, F.col("label").cast("string")).alias("tomogram_id"), F.floor(F.col("vec_id") / 3).alias("idx"), "x", "y", "z", F.format_string("p%d", F.col("vec_id") % 3).alias("picker"),
        F.when(F.col("vec_id") % 4 > 0, F.col("x") / 100).alias("confidence"), F.format_string("v%d", F.col("vec_id") % 7).alias("vesicle_id"), F.col("vec_id").alias("row_id"),
    )
    return _reconciled(C.reconcile(p, 25.0, "intersection", 2, ("vesicle_id", "row_id")), "vesicle_id", "row_id")


@query("""
with recursive c as (select label, vec_id % 2 as h, generate_subscripts(embedding, 1) as k, unnest(embedding)::double as v from embeddings), m as (select label, h, k, avg(v) as v from c group by all),
d as (select a.label as a, b.label as b, sqrt(sum((a.v-b.v)*(a.v-b.v))) as distance from m a join m b on a.k = b.k where a.h = 0 and b.h = 1 group by all),
o as (select a, b, row_number() over (order by distance, b, a) as n from d),
g(n, left_of, right_of) as (select 0::bigint, []::int[], []::int[] union all
    select o.n, case when free then list_append(left_of, o.a) else left_of end, case when free then list_append(right_of, o.b) else right_of end
    from (select g.*, o.*, not list_contains(g.left_of, o.a) and not list_contains(g.right_of, o.b) as free from g join o on o.n = g.n + 1) as s(gn, left_of, right_of, a, b, n, free), lateral (select s.n, s.a, s.b) as o(n, a, b))
select unnest(right_of) as label_b, unnest(left_of) as label_a from g where n = (select max(n) from g)
""")
def grp5_greedy_match(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("half", F.col("vec_id") % 2)
    return C.match_halves(A.elementwise_mean(e, ["half", "label"], "embedding"), "half", "label")


@query()
def grp6_pca(spark, sf_dir):
    return C.reduce(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 3)


@query()
def grp8_k_means(spark, sf_dir):
    return C.cluster(C.reduce(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 3), "vec_id", "scores", "kmeans", k=4)


@query()
def grp7_density_clusters(spark, sf_dir):
    reduced = C.reduce(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 3).withColumn("half", F.when(F.col("vec_id") % 2 == 0, "A").otherwise("B"))
    return C.cluster(reduced, "vec_id", "scores", "density", by="half", least_size=5)


@query(f"""
with recursive p as ({POINTS}), e as (select a.vec_id as a, b.vec_id as b from p a join p b on a.label = b.label and (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z) < 25),
w(a, r) as (select vec_id, vec_id from p union select e.a, w.r from w join e on e.b = w.a)
select a as vec_id, min(r) as component from w group by a
""")
def grp16_single_linkage(spark, sf_dir):
    return C.single_linkage(points(spark, sf_dir), ["label"], ["x", "y", "z"], "vec_id", 5.0)


# decoys


def hash_sql(part: int, *of: str) -> str:
    """decoys.hashed with seed 0 in SQL."""
    return f"('0x' || substr(md5(concat_ws(':', '0', {', '.join(of)})), {1 + 8 * part}, 8))::bigint / 4294967296.0"


@query(f"""
with p as (select label::varchar as tomogram_id, vec_id as idx, x, y, z, x + y as score, vec_id % 3 = 0 as taken from ({POINTS})),
wanted as (select tomogram_id, greatest(1, round_even(count(*) filter (where taken and vec_id_even) * 0.25, 0))::bigint as n from (select *, idx % 2 = 0 as vec_id_even from p) group by 1),
apart as (select * from p where score < 100 and not exists (select 1 from p r where r.taken and r.idx % 2 = 0 and r.tomogram_id = p.tomogram_id and (r.x-p.x)*(r.x-p.x)+(r.y-p.y)*(r.y-p.y)+(r.z-p.z)*(r.z-p.z) < 100)),
pool as (select apart.*, n from apart join wanted using (tomogram_id) qualify row_number() over (partition by tomogram_id order by score, idx) <= 5 * n),
drawn as (select * from pool qualify row_number() over (partition by tomogram_id order by {hash_sql(0, "tomogram_id", "idx::varchar")}, idx) <= n)
select tomogram_id, idx, round(score, 6) + 0.0 as score from drawn
""")
def dec2_rejected_surface(spark, sf_dir):
    """Each tomogram gives a quarter as many decoys as it has real picks."""
    p = points(spark, sf_dir).select(F.col("label").cast("string").alias("tomogram_id"), F.col("vec_id").alias("idx"), "x", "y", "z", (F.col("x") + F.col("y")).alias("score"))
    found = D.from_rejected(p, p.where("idx % 6 = 0"), 100.0, 10.0, ratio=0.25)
    return found.select("tomogram_id", "idx", r6("score").alias("score"))


@query(f"""
with p as (select label::varchar as tomogram_id, vec_id, x, y, z from ({POINTS})), pick as (select * from p where vec_id % 4 = 0), surface as (select *, z - y as nx, x as ny, y as nz from p where vec_id % 4 = 1),
tried as (select pick.*, k, 2 * {hash_sql(0, "vec_id::varchar", "k::varchar")} - 1 as rise, 2 * pi() * {hash_sql(1, "vec_id::varchar", "k::varchar")} as turn, 8 + 22 * {hash_sql(2, "vec_id::varchar", "k::varchar")} as length from pick, range(200) t(k)),
place as (select tomogram_id, vec_id, k, x + sqrt(1 - rise * rise) * length * cos(turn) as x, y + sqrt(1 - rise * rise) * length * sin(turn) as y, z + rise * length as z from tried),
inside as (select place.* from place where x >= 0 and y >= 0 and z >= 0 and x <= 89 + tomogram_id::int and y <= 99 and z <= 109),
good as (select * from inside c where not exists (select 1 from pick r where r.tomogram_id = c.tomogram_id and (r.x-c.x)*(r.x-c.x)+(r.y-c.y)*(r.y-c.y)+(r.z-c.z)*(r.z-c.z) < 144)
    and not exists (select 1 from surface r where r.tomogram_id = c.tomogram_id and (r.x-c.x)*(r.x-c.x)+(r.y-c.y)*(r.y-c.y)+(r.z-c.z)*(r.z-c.z) < 100)),
first_one as (select * from good qualify row_number() over (partition by vec_id order by k) = 1),
near as (select f.*, s.nx, s.ny, s.nz from first_one f join surface s using (tomogram_id) qualify row_number() over (partition by f.vec_id order by (s.x-f.x)*(s.x-f.x)+(s.y-f.y)*(s.y-f.y)+(s.z-f.z)*(s.z-f.z)) = 1)
select tomogram_id, vec_id, round(x, 5) + 0.0 as x, round(y, 5) + 0.0 as y, round(z, 5) + 0.0 as z, round(nx, 5) + 0.0 as nx, round(ny, 5) + 0.0 as ny, round(nz, 5) + 0.0 as nz from near
""")
def dec3_shifted(spark, sf_dir):
    """Each tomogram has a shape of its own."""
    p = points(spark, sf_dir).withColumn("tomogram_id", F.col("label").cast("string"))
    surface = p.where("vec_id % 4 = 1").select("tomogram_id", "x", "y", "z", (F.col("z") - F.col("y")).alias("nx"), F.col("x").alias("ny"), F.col("y").alias("nz"))
    shapes = p.select("tomogram_id", F.lit(110).alias("nz"), F.lit(100).alias("ny"), (F.col("label") + 90).alias("nx")).distinct()
    found = D.shifted(p.where("vec_id % 4 = 0").select("tomogram_id", "vec_id", "x", "y", "z"), surface, shapes, "vec_id", 8.0, 30.0, 10.0, 12.0)
    return found.select("tomogram_id", "vec_id", *((F.round(c, 5) + F.lit(0.0)).alias(c) for c in ("x", "y", "z", "nx", "ny", "nz")))


# bookkeeping joins, listings and checks


@query("""
with m as (select 't' || lpad(n_nationkey::varchar, 2, '0') as tomogram_id, n_nationkey as k from nation), l as (select tomogram_id || case k % 3 when 0 then '_labelled' else '_a' end as stem from m where k % 4 <> 3 union all select tomogram_id || '_0' from m where k % 3 = 0),
r as (select tomogram_id, stem, row_number() over (partition by tomogram_id order by (stem <> tomogram_id || '_labelled')::int, stem) as n from m left join l on starts_with(stem, tomogram_id))
select tomogram_id, stem from r where n = 1
""")
def join4_labels_for(spark, sf_dir):
    m = table(spark, sf_dir, "nation").select(F.format_string("t%02d", "n_nationkey").alias("tomogram_id"), F.col("n_nationkey").alias("k"))
    some = m.where("k % 4 <> 3").select(F.concat("tomogram_id", F.when(F.col("k") % 3 == 0, "_labelled").otherwise("_a")).alias("stem"))
    stems = some.unionByName(m.where("k % 3 = 0").select(F.concat("tomogram_id", F.lit("_0")).alias("stem")))
    return J.labels_for(m.select("tomogram_id"), stems)


@query(f"""
with v as ({NORMALS}), n as (select vec_id, x / sqrt(x*x+y*y+z*z) as x, y / sqrt(x*x+y*y+z*z) as y, z / sqrt(x*x+y*y+z*z) as z from v),
q as (select vec_id, (1+z)/sqrt((1+z)*(1+z)+x*x+y*y) as w, -y/sqrt((1+z)*(1+z)+x*x+y*y) as x, x/sqrt((1+z)*(1+z)+x*x+y*y) as y, radians((vec_id % 90)::double)/2 as h from n)
select vec_id, round(case when vec_id % 3 = 0 then w else w*cos(h) end, 6) + 0.0 as w, round(case when vec_id % 3 = 0 then 0 else w*sin(h) end, 6) + 0.0 as qz from q
""")
def join9_with_roll(spark, sf_dir):
    p = normals(spark, sf_dir).withColumn("orientation", G.quaternion_from_normal(*map(F.col, "xyz")))
    angles = p.where("vec_id % 3 <> 0").select("vec_id", (F.col("vec_id") % 90).cast("double").alias("inplane_angle_degrees"))
    return J.with_roll(p, angles, "vec_id").select("vec_id", r6("orientation.w").alias("w"), r6("orientation.z").alias("qz"))


@query("select o_orderpriority as class_id, case when o_custkey % 2 = 0 then 'A' else 'B' end as half_set, min(o_orderpriority || '_' || (o_custkey % 2)::varchar || '_' || o_orderkey::varchar) as path from orders group by 1, 2")
def join14_first_reference(spark, sf_dir):
    half = F.when(F.col("o_custkey") % 2 == 0, "A").otherwise("B").alias("half_set")
    path = F.concat_ws("_", "o_orderpriority", (F.col("o_custkey") % 2).cast("string"), F.col("o_orderkey").cast("string")).alias("path")
    return J.first_reference(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("class_id"), half, path))


@query("select c_mktsegment, count(*) filter (where o_custkey is not null) as matched, count(*) filter (where o_custkey is null) as missing from customer left join (select distinct o_custkey from orders where o_totalprice > 400000) on o_custkey = c_custkey group by c_mktsegment")
def join16_matched_and_missing(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    found, missing = P.kept_and_skipped(table(spark, sf_dir, "customer").join(o.distinct().withColumn("hit", F.lit(True)), "c_custkey", "left"), F.col("hit"))
    both = found.select("c_mktsegment", F.lit(1).alias("k")).unionByName(missing.select("c_mktsegment", F.lit(0).alias("k")))
    return both.groupBy("c_mktsegment").agg(F.sum("k").alias("matched"), F.sum(1 - F.col("k")).alias("missing"))


@query("select count(*) as n from orders where o_custkey % 2 = 0")
def agg16_single_half(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.when(F.col("o_custkey") % 2 == 0, "A").otherwise("B").alias("half_set"))
    return P.single_half(o.where("half_set = 'A'")).agg(F.count(F.lit(1)).alias("n"))


@query("select count(*) as total, count(*) filter (where event_id % 7 <> 0) as accepted, count(*) filter (where event_id % 7 <> 0 and abs(value - 50) <= 10) as visible from events")
def agg19_review_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return R.review_counts(e, e.where("event_id % 7 = 0").select("event_id"), "event_id", P.in_slab(F.col("value"), 50, 10))


@query("select user_id, event_type, round(avg(value), 6) + 0.0 as confidence from events group by all")
def agg20_confidence(spark, sf_dir):
    return A.mean_confidence(table(spark, sf_dir, "events"), ["user_id", "event_type"], "value").select("user_id", "event_type", r6("confidence").alias("confidence"))


@query("select c_custkey from customer except select o_custkey from orders where o_orderpriority like '1%'")
def set5_unknown_ids(spark, sf_dir):
    """Customers without an urgent order."""
    return P.unknown(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").where("o_orderpriority like '1%'").select(F.col("o_custkey").alias("c_custkey")))


@query("select 'a' as source, event_id from events where event_type = 'click' union all select 'b', event_id from events where value > 50")
def set3_concatenated(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return P.concatenated({"a": e.where("event_type = 'click'").select("event_id"), "b": e.where("value > 50").select("event_id")})


@query("select p_brand, p_type, rank from (select p_brand, p_type, row_number() over (partition by p_brand order by sum(p_retailprice) desc, p_type) as rank from part group by p_brand, p_type) where rank <= 3")
def win7_ranked_listing(spark, sf_dir):
    sums = table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.sum("p_retailprice").alias("s"))
    return W.ranked(sums, ["p_brand"], "s", "p_type", 3).select("p_brand", "p_type", "rank")


@query("select vec_id from embeddings where label in (1, 4, 7)")
def flt10_select_tomograms(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("string").alias("tomogram_id"))
    return P.select_tomograms(e, ["1", "4", "7"]).select("vec_id")


@query("select label, half_set, count(*) as n, round(avg(v), 6) + 0.0 as mean0 from (select label, case when vec_id % 2 = 0 then 'A' else 'B' end as half_set, embedding[1]::double as v from embeddings) group by all")
def agg17_means_by_half(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", F.when(F.col("vec_id") % 2 == 0, "A").otherwise("B").alias("half_set"), F.slice("embedding", 1, 1).alias("v"))
    m = A.elementwise_mean(e, ["label", "half_set"], "v")
    return m.select("label", "half_set", "n", r6(F.col("mean")[0]).alias("mean0"))


@query("select vec_id, tile_column, tile_row from (select vec_id, floor(x / 25)::int as tile_column, floor(y / 25)::int as tile_row from (" + POINTS + "))")
def review_tiles(spark, sf_dir):
    from ..operators.preview import tile

    t = points(spark, sf_dir).withColumn("t", tile(F.col("x"), F.col("y"), 25))
    return t.select("vec_id", F.col("t.column").alias("tile_column"), F.col("t.row").alias("tile_row"))


# volumes: the 64 values of an embedding as a cube of four voxels a side

CUBES = "select vec_id, label, embedding from embeddings"


def cubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


def per_cube(df: DataFrame, values, schema: str) -> DataFrame:
    """Rows (vec_id, ...) that values(cube) lists for each cube, in Arrow batches."""

    def make(batches):
        for rows in batches:
            out = [(i, *r) for i, v in zip(rows["vec_id"], rows["v"], strict=True) for r in values(np.array(v, float).reshape(4, 4, 4))]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return df.mapInPandas(make, schema)


# values at points p (k..., a, b, c) of cubes e, in the order of their axes, clamped to the edge
TRILINEAR = """
q as (select *, least(greatest(a, 0), 3) as pa, least(greatest(b, 0), 3) as pb, least(greatest(c, 0), 3) as pc from p),
w as (select *, least(floor(pa), 2)::int as la, least(floor(pb), 2)::int as lb, least(floor(pc), 2)::int as lc from q),
d as (select unnest([0, 1]) as s), t as (select w.*, x.s as da, y.s as db, z.s as dc,
    (case x.s when 1 then pa - la else 1 - (pa - la) end) * (case y.s when 1 then pb - lb else 1 - (pb - lb) end) * (case z.s when 1 then pc - lc else 1 - (pc - lc) end) as share from w, d x, d y, d z)
"""


@query(f"""
with p as (select k, 1.2 + 0.0 as a, 0.7 + 0.6 * (k - 1) as b, 2.1 + 0.8 * (k - 1) as c from (select unnest([0, 1, 2, 3]) as k)), {TRILINEAR}
select vec_id, k::int as k, round(sum(share * embedding[16 * (la + da) + 4 * (lb + db) + (lc + dc) + 1]::double), 6) + 0.0 as v from ({CUBES}), t group by vec_id, k
""")
def k2_sample_along(spark, sf_dir):
    """Samples from one voxel below to two above a point along a slanted normal, clamped at the edge."""
    at, way = np.array([[1.2, 0.7, 2.1]]), np.array([[0.0, 0.6, 0.8]])
    found = per_cube(cubes(spark, sf_dir), lambda v: enumerate(V.sample_along(v, at, way, -1, 2, 4)[0].tolist()), "vec_id long, k int, v double")
    return found.select("vec_id", "k", r6("v").alias("v"))


RINGS = f"p as (select r, f, z, 1.5 + (0.5 + 0.5 * r) * cos(f * pi() / 4) as a, 1.5 + (0.5 + 0.5 * r) * sin(f * pi() / 4) as b, z::double as c from (select unnest([0, 1, 2]) as r), (select unnest([0, 1, 2, 3, 4, 5, 6, 7]) as f), (select unnest([0, 1, 2, 3]) as z)), {TRILINEAR}"


@query(f"with {RINGS} select vec_id, r::int as r, f::int as f, z::int as z, round(sum(share * embedding[16 * (la + da) + 4 * (lb + db) + (lc + dc) + 1]::double), 6) + 0.0 as v from ({CUBES}), t group by vec_id, r, f, z")
def k7_cylindrical(spark, sf_dir):
    found = per_cube(cubes(spark, sf_dir), lambda v: ((*at, x) for at, x in np.ndenumerate(S.cylindrical(v, 3, 8))), "vec_id long, r int, f int, z int, v double")
    return found.select("vec_id", "r", "f", "z", r6("v").alias("v"))


@query(f"""
with {RINGS}, v as (select vec_id, r, f, z, sum(share * embedding[16 * (la + da) + 4 * (lb + db) + (lc + dc) + 1]::double) as v from ({CUBES}), t group by vec_id, r, f, z),
m as (select vec_id, m, r, z, sum(v * cos(2 * pi() * m * f / 8)) / 8 as re, sum(v * sin(2 * pi() * m * f / 8)) / 8 as im from v, (select unnest([0, 1, 2, 3]) as m) group by all)
select vec_id, m::int as m, r::int as r, z::int as z, round(case m when 0 then re else sqrt(re * re + im * im) end, 6) + 0.0 as v from m
""")
def k8_azimuthal_modes(spark, sf_dir):
    found = per_cube(cubes(spark, sf_dir), lambda v: ((*at, x) for at, x in np.ndenumerate(S.azimuthal_modes(S.cylindrical(v, 3, 8), 3))), "vec_id long, m int, r int, z int, v double")
    return found.select("vec_id", "m", "r", "z", r6("v").alias("v"))


@query("""
with p as (select label + 1 as w, embedding[1]::double * 20 + 4 as a, embedding[2]::double * 20 + 4 as b, embedding[3]::double * 20 + 4 as c from embeddings), d as (select unnest([0, 1]) as s),
t as (select floor(a)::int + x.s as i, floor(b)::int + y.s as j, floor(c)::int + z.s as k,
    w * (case x.s when 1 then a - floor(a) else 1 - (a - floor(a)) end) * (case y.s when 1 then b - floor(b) else 1 - (b - floor(b)) end) * (case z.s when 1 then c - floor(c) else 1 - (c - floor(c)) end) as v from p, d x, d y, d z)
select i::int as i, j::int as j, k::int as k, round(sum(v), 5) + 0.0 as v from t where i between 0 and 7 and j between 0 and 7 and k between 0 and 7 group by i, j, k having round(sum(v), 5) <> 0
""")
def k12_splat(spark, sf_dir):
    """All positions in one box; tasks deposit their own points first."""
    e = table(spark, sf_dir, "embeddings").select((F.col("label") + 1).alias("w"), F.col("embedding").cast("array<double>").alias("v"))

    def deposit(batches):
        box = np.zeros((8, 8, 8))
        for rows in batches:
            box += V.splat(np.array([v[:3] for v in rows["v"]]).reshape(-1, 3) * 20 + 4, rows["w"].to_numpy(float), 8)
        yield pd.DataFrame([(*at, x) for at, x in np.ndenumerate(box)], columns=["i", "j", "k", "v"])

    found = e.mapInPandas(deposit, "i int, j int, k int, v double").groupBy("i", "j", "k").agg((F.round(F.sum("v"), 5) + F.lit(0.0)).alias("v"))
    return found.where("v <> 0")


@query("""
with e as (select vec_id, generate_subscripts(embedding, 1) - 1 as p, unnest(embedding)::double as v from embeddings),
r as (select *, sqrt(pow(p // 16 - 1.5, 2) + pow(p // 4 % 4 - 1.5, 2) + pow(p % 4 - 1.5, 2)) as r from e), t as (select *, (r - 0.8 * 4 / 2) / 2 + 1 as t from r)
select vec_id, round(sum(v * case when t <= 0 then 1 when t >= 1 then 0 else 0.5 * (1 + cos(pi() * t)) end), 6) + 0.0 as under from t group by vec_id
""")
def k17_soft_sphere(spark, sf_dir):
    """What is left of each cube under the mask."""
    return per_cube(cubes(spark, sf_dir), lambda v: [(float((v * V.soft_sphere(4, 0.8, 2)).sum()),)], "vec_id long, under double").select("vec_id", r6("under").alias("under"))


#: Cubes of one side that a task of k16_fit_score takes together.
FIT_BLOCK = 256


@query("""
with e as (select vec_id, label, generate_subscripts(embedding, 1) - 1 as p, unnest(embedding)::double as v from embeddings),
voxel as (select vec_id, label, p // 16 as i, p // 4 % 4 as j, p % 4 as k, v from e), stat as (select vec_id, avg(v) as m, stddev_pop(v) as s from e group by vec_id),
reference as (select voxel.*, abs(v - m) > s as under from voxel join stat using (vec_id) where label = 0), shift as (select unnest([-1, 0, 1]) as d),
pair as (select a.vec_id, b.vec_id as other, flip from (select distinct vec_id from reference) a join (select distinct vec_id from voxel where label = 1) b on b.vec_id % 5 = a.vec_id % 5, (select unnest([false, true]) as flip)),
moved as (select r.vec_id, other, flip, x.d as dx, y.d as dy, z.d as dz, r.v as a, coalesce(c.v, 0) as b
    from pair join reference r on r.vec_id = pair.vec_id and r.under, shift x, shift y, shift z
    left join voxel c on c.vec_id = other and c.i = r.i - x.d and c.j = r.j - y.d and (case when flip then 3 - c.k else c.k end) = r.k - z.d),
scored as (select vec_id, other, coalesce(corr(a, b), 0) as c from moved group by vec_id, other, flip, dx, dy, dz)
select vec_id, other, round(max(abs(c)), 6) + 0.0 as score from scored group by all
""")
def k16_fit_score(spark, sf_dir):
    """Cubes of label 0 against those of label 1, both ways up, at 27 shifts.

    A task takes a block of references and one of candidates, so cubes are sent once for each block of the other side and not once a pair.
    """
    e = cubes(spark, sf_dir).withColumn("rest", F.col("vec_id") % 5)
    a, b = e.where("label = 0").select("vec_id", "rest", "v"), e.where("label = 1").select(F.col("vec_id").alias("other"), *(F.col(c).alias(c) for c in ("rest", "v")))

    def blocks(side: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """The side with its blocks, and how many each rest has."""
        counts = F.broadcast(side.groupBy("rest").agg(F.ceil(F.count(F.lit(1)) / FIT_BLOCK).cast("int").alias("n")))  # five rows at most
        return side.join(counts, "rest").withColumn("block", F.pmod(F.xxhash64(key), F.col("n")).cast("int")).drop("n"), counts

    (one, left), (two, right) = blocks(a, "vec_id"), blocks(b, "other")
    one = one.join(right, "rest").withColumn("beside", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n")
    two = two.withColumnRenamed("block", "beside").join(left, "rest").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n")

    def fit(ones: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if not len(ones) or not len(others):
            return pd.DataFrame({"vec_id": np.zeros(0, np.int64), "other": np.zeros(0, np.int64), "score": np.zeros(0)})
        candidates = np.stack(others["v"].to_numpy()).reshape(-1, 4, 4, 4)
        score = [V.fit_scores(np.reshape(v, (4, 4, 4)), candidates, (-1, 0, 1)) for v in ones["v"]]
        return pd.DataFrame({"vec_id": np.repeat(ones["vec_id"].to_numpy(), len(others)), "other": np.tile(others["other"].to_numpy(), len(ones)), "score": np.concatenate(score)})

    tasks, keys = 4 * spark.sparkContext.defaultParallelism, ["rest", "block", "beside"]
    found = one.repartition(tasks, *keys).groupBy(*keys).cogroup(two.repartition(tasks, *keys).groupBy(*keys)).applyInPandas(fit, "vec_id long, other long, score double")
    return found.select("vec_id", "other", r6("score").alias("score"))


@query("""
with e as (select label, vec_id % 2 as h, generate_subscripts(embedding, 1) - 1 as place, unnest(embedding)::double as v from embeddings), m as (select label, h, place, avg(v) as v from e group by all),
f as (select unnest(range(64)) as f), w as (select f, place, 2 * pi() * ((f // 16) * (place // 16) + (f // 4 % 4) * (place // 4 % 4) + (f % 4) * (place % 4)) / 4 as w from f, (select unnest(range(64)) as place)),
c as (select label, h, f, sum(v * cos(w)) as re, -sum(v * sin(w)) as im from m join w on w.place = m.place group by all),
s as (select f, floor(sqrt(pow((f // 16 + 2) % 4 - 2, 2) + pow((f // 4 % 4 + 2) % 4 - 2, 2) + pow((f % 4 + 2) % 4 - 2, 2)))::int as shell from f)
select a.label, shell, round(sum(a.re * b.re + a.im * b.im) / sqrt(sum(a.re * a.re + a.im * a.im) * sum(b.re * b.re + b.im * b.im)), 5) + 0.0 as fsc
from c a join c b on a.label = b.label and a.f = b.f and a.h = 0 and b.h = 1 join s on s.f = a.f where shell < 2 group by a.label, shell
""")
def k18_shell_correlation(spark, sf_dir):
    """Shell correlations of the means of both halves of each class."""
    means = A.elementwise_mean(cubes(spark, sf_dir).withColumn("h", F.col("vec_id") % 2), ["label", "h"], "v")
    half = lambda h, name: means.where(F.col("h") == h).select("label", F.col("mean").alias(name))

    def correlate(batches):
        for rows in batches:
            out = [(r.label, k, float(x)) for r in rows.itertuples() for k, x in enumerate(S.shell_correlation(np.array(r.a).reshape(4, 4, 4), np.array(r.b).reshape(4, 4, 4)))]
            yield pd.DataFrame(out, columns=["label", "shell", "fsc"])

    found = half(0, "a").join(half(1, "b"), "label").mapInPandas(correlate, "label int, shell int, fsc double")
    return found.select("label", "shell", (F.round("fsc", 5) + F.lit(0.0)).alias("fsc"))


@query("""
with n as (select label, count(*) as n from embeddings group by label) select label, n, greatest(1, round_even(n * 0.5, 0))::bigint as decoys from n
""")
def fn16_decoys_wanted(spark, sf_dir):
    n = table(spark, sf_dir, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return n.select("label", "n", G.decoys_wanted(F.col("n"), 0.5).alias("decoys"))


@query(f"select vec_id, round(z / 13.48, 6) + 0.0 as a, round(y / 13.48, 6) + 0.0 as b, round(x / 13.48, 6) + 0.0 as c from ({POINTS})")
def fn13_voxels_by_array_axis(spark, sf_dir):
    """Positions in voxels, in the order of a volume's axes."""
    p = points(spark, sf_dir)
    at = G.reversed_axes(F.struct(*(G.to_voxels(F.col(c), 13.48).alias(c) for c in "xyz")))
    return p.select("vec_id", at.alias("p")).select("vec_id", r6("p.x").alias("a"), r6("p.y").alias("b"), r6("p.z").alias("c"))


VOXELS = "select vec_id, p // 16 as i, p // 4 % 4 as j, p % 4 as k, v from (select vec_id, generate_subscripts(embedding, 1) - 1 as p, unnest(embedding)::double as v from embeddings)"

# the samples at w's points, 0 where one is beyond the cube
SAMPLED = f"round(case when bool_or(least(a, b, c) < -1e-9 or greatest(a, b, c) > 3 + 1e-9) then 0 else sum(share * embedding[16 * (la + da) + 4 * (lb + db) + (lc + dc) + 1]::double)::float::double end, 6) + 0.0 as v from ({CUBES}), t"


@query(f"""
with g as (select x.s as x, y.s as y, z.s as z from (select unnest([0, 1, 2]) as s) x, (select unnest([0, 1, 2]) as s) y, (select unnest([0, 1, 2]) as s) z),
p as (select x, y, z, 0.96 * (y - 1) + 0.28 * (z - 1) + 1 as a, 0.28 * (y - 1) - 0.96 * (z - 1) + 1.4 as b, x - 1 + 2.3 as c from g), {TRILINEAR}
select vec_id, x::int as x, y::int as y, z::int as z, {SAMPLED} group by vec_id, x, y, z
""")
def k5_extract_box(spark, sf_dir):
    """Boxes of three voxels in each cube, turned about x, partly beyond the cube."""
    at, q = np.array([2.3, 1.4, 1.0]), np.array([0.8, 0.6, 0.0, 0.0])
    found = per_cube(cubes(spark, sf_dir), lambda v: ((*p, float(x)) for p, x in np.ndenumerate(V.extract_box(v, at, q, 3))), "vec_id long, x int, y int, z int, v double")
    return found.select("vec_id", "x", "y", "z", r6("v").alias("v"))


@query(f"""
with g as (select x.s as i, y.s as j, z.s as k from (select unnest([0, 1, 2, 3]) as s) x, (select unnest([0, 1, 2, 3]) as s) y, (select unnest([0, 1, 2, 3]) as s) z),
p as (select i, j, k, 1.5 + cos(pi() / 6) * (i - 1.5) + sin(pi() / 6) * (j - 1.5) as a, 1.5 - sin(pi() / 6) * (i - 1.5) + cos(pi() / 6) * (j - 1.5) as b, k::double as c from g), {TRILINEAR}
select vec_id, i::int as i, j::int as j, k::int as k, {SAMPLED.replace("::float::double", "")} group by vec_id, i, j, k
""")
def k10_turn(spark, sf_dir):
    """Cubes turned by 30 degrees in the plane of their first two axes."""
    found = per_cube(cubes(spark, sf_dir), lambda v: ((*p, x) for p, x in np.ndenumerate(V.turn(v, 30.0))), "vec_id long, i int, j int, k int, v double")
    return found.select("vec_id", "i", "j", "k", r6("v").alias("v"))


@query(f"""
with e as ({VOXELS}), turned as (select vec_id, i, j, k, v from e union all select vec_id, j, 3 - i, k, v from e union all select vec_id, 3 - i, 3 - j, k, v from e union all select vec_id, 3 - j, i, k, v from e)
select vec_id, i::int as i, j::int as j, k::int as k, round(avg(v), 6) + 0.0 as v from turned group by vec_id, i, j, k
""")
def k14_azimuthal_smear(spark, sf_dir):
    """The mean of each cube's four quarter turns."""
    found = per_cube(cubes(spark, sf_dir), lambda v: ((*p, x) for p, x in np.ndenumerate(V.azimuthal_smear(v, 4))), "vec_id long, i int, j int, k int, v double")
    return found.select("vec_id", "i", "j", "k", r6("v").alias("v"))


@query(f"select vec_id, floor(sqrt((i - 1.5) * (i - 1.5) + (j - 1.5) * (j - 1.5)))::int as r, k::int as z, round(avg(v), 6) + 0.0 as v from ({VOXELS}) group by all")
def agg9_rotational_average(spark, sf_dir):
    found = per_cube(cubes(spark, sf_dir), lambda v: ((*at, x) for at, x in np.ndenumerate(S.rotational_average(v))), "vec_id long, r int, z int, v double")
    return found.select("vec_id", "r", "z", r6("v").alias("v"))


@query(f"""
with e as ({VOXELS}), m as (select vec_id, median(v)::float::double as m from e where v <= 0.1 group by vec_id)
select vec_id, count(*) filter (v > 0.1) as n_filled, round(sum(case when v > 0.1 then coalesce(m, v) else v end), 6) + 0.0 as total from e left join m using (vec_id) group by vec_id
""")
def agg5_fill_membrane(spark, sf_dir):
    """Voxels over 0.1, as a segmentation has them, take the median of the others."""

    def filled(v):
        mask = v > 0.1
        return [(int(mask.sum()), float(V.fill_membrane(v, mask).astype(float).sum()))]

    return per_cube(cubes(spark, sf_dir), filled, "vec_id long, n_filled long, total double").select("vec_id", "n_filled", r6("total").alias("total"))


@query(f"""
with e as ({VOXELS}), s as (select vec_id, avg(v) as m, stddev_pop(v) as s from e group by vec_id)
select vec_id, i::int as i, j::int as j, k::int as k from e join s using (vec_id) where abs(v - m) > s
""")
def flt13_significant(spark, sf_dir):
    return per_cube(cubes(spark, sf_dir), lambda v: map(tuple, np.argwhere(V.significant(v)).tolist()), "vec_id long, i int, j int, k int")


@query(f"""
with e as ({VOXELS}), cell as (select x.s as ci, y.s as cj, z.s as ck from (select unnest([0, 1, 2]) as s) x, (select unnest([0, 1, 2]) as s) y, (select unnest([0, 1, 2]) as s) z),
way(w, a, b) as (values (0, 0, 1), (1, 0, 2), (2, 1, 0), (3, 1, 2), (4, 2, 0), (5, 2, 1)), corner as (select unnest([0, 1, 2, 3]) as c),
-- a tetrahedron's corners: the cell's first, one step along axis a, one more along b, and the last
placed as (select ci, cj, ck, w, c, ci + (c = 3 or c >= 1 and a = 0 or c >= 2 and b = 0)::int as i, cj + (c = 3 or c >= 1 and a = 1 or c >= 2 and b = 1)::int as j, ck + (c = 3 or c >= 1 and a = 2 or c >= 2 and b = 2)::int as k from cell, way, corner),
valued as (select vec_id, ci, cj, ck, w, c, i, j, k, v, v >= 0.05 as inside from placed join e using (i, j, k)),
ranked as (select *, row_number() over (partition by vec_id, ci, cj, ck, w order by inside desc, c) - 1 as r, count(*) filter (inside) over (partition by vec_id, ci, cj, ck, w) as n from valued),
-- which edges, by rank of their ends, are a triangle's corners
part(n, t, q, r0, r1) as (values (1, 0, 0, 0, 1), (1, 0, 1, 0, 2), (1, 0, 2, 0, 3), (3, 0, 0, 0, 3), (3, 0, 1, 1, 3), (3, 0, 2, 2, 3), (2, 0, 0, 0, 2), (2, 0, 1, 0, 3), (2, 0, 2, 1, 3), (2, 1, 0, 0, 2), (2, 1, 1, 1, 3), (2, 1, 2, 1, 2)),
cut as (select x.vec_id, x.ci, x.cj, x.ck, x.w, t, q, x.i + (0.05 - x.v) / (y.v - x.v) * (y.i - x.i) as i, x.j + (0.05 - x.v) / (y.v - x.v) * (y.j - x.j) as j, x.k + (0.05 - x.v) / (y.v - x.v) * (y.k - x.k) as k
    from ranked x join part on part.n = x.n and part.r0 = x.r join ranked y on y.vec_id = x.vec_id and y.ci = x.ci and y.cj = x.cj and y.ck = x.ck and y.w = x.w and y.r = part.r1),
side as (select a.vec_id, b.i - a.i as ui, b.j - a.j as uj, b.k - a.k as uk, c.i - a.i as vi, c.j - a.j as vj, c.k - a.k as vk from cut a join cut b using (vec_id, ci, cj, ck, w, t) join cut c using (vec_id, ci, cj, ck, w, t) where a.q = 0 and b.q = 1 and c.q = 2)
select vec_id, count(*) as n_triangles, round(sum(sqrt(pow(uj * vk - uk * vj, 2) + pow(uk * vi - ui * vk, 2) + pow(ui * vj - uj * vi, 2)) / 2), 6) + 0.0 as area from side group by vec_id
""")
def k1_surface_area(spark, sf_dir):
    """Triangles of each cube's surface at 0.05 and their area."""

    def area(v):
        triangles = V.surface_triangles(v, 0.05)
        return [(len(triangles), float(V.triangle_areas(triangles).sum()))] if len(triangles) else []

    return per_cube(cubes(spark, sf_dir), area, "vec_id long, n_triangles long, area double").select("vec_id", "n_triangles", r6("area").alias("area"))
