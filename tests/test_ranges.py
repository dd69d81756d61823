"""Ids and halves over ranges: each id once and the same halves, whatever the number of partitions."""

import pytest
from pyspark.sql import functions as F

from voxframe.functions.text import numbered
from voxframe.operators.windows import split_halves
from voxframe.scratch import discard, settings, written

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("parts", [8, 200])
def test_ids_come_once(spark, parts):
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey")
    order = [F.col(c) for c in ("l_partkey", "l_orderkey", "l_linenumber")]
    with settings(spark, spark__sql__shuffle__partitions=str(parts)):
        got = []
        for _ in range(2):
            rows = numbered(lines, "p", order).collect()
            assert {r.particle_id for r in rows} == {f"p{k:06d}" for k in range(60_000)}
            got.append({(r.l_orderkey, r.l_linenumber, r.l_partkey, r.particle_id) for r in rows})
        assert got[0] == got[1]
        ranked = sorted(got[0], key=lambda r: r[3])
        assert [r[:3] for r in ranked] == sorted((r[:3] for r in ranked), key=lambda r: (r[2], r[0], r[1]))


@pytest.mark.parametrize("parts", [1, 8, 200])
def test_halves_follow_the_running_sum(spark, parts):
    counts = spark.read.parquet(f"{DATA}/orders.parquet").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    key = F.md5(F.col("o_custkey").cast("string").cast("binary"))
    rows = counts.withColumn("o", key).collect()
    total, before, want = sum(r.n for r in rows), 0, {}
    for r in sorted(rows, key=lambda r: (r.o, r.o_custkey)):
        want[r.o_custkey] = "A" if before < (total + 1) // 2 else "B"
        before += r.n
    with settings(spark, spark__sql__shuffle__partitions=str(parts)):
        for _ in range(2):
            assert {r.o_custkey: r.half_set for r in split_halves(counts, "o_custkey", "n", key).collect()} == want


def test_ties_and_empty_tables(spark):
    same = spark.createDataFrame([(1,)] * 50, "k int")
    assert {r.particle_id for r in numbered(same, "p", [F.col("k")]).collect()} == {f"p{k:06d}" for k in range(50)}
    assert numbered(same.limit(0), "p", [F.col("k")]).count() == 0
    assert split_halves(spark.createDataFrame([], "g string, n long"), "g", "n", F.col("g")).count() == 0


def test_settings_come_back_and_tables_go(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ZeroDivisionError), settings(spark, spark__sql__shuffle__partitions="3"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        raise ZeroDivisionError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    table = written(spark.range(3), "three")
    assert table.count() == 3
    discard(table)
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        table.collect()
