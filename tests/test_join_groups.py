"""Group values join back without one task reading a whole group."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import features as fe
from ledgerlake.operators import missing as mv
from ledgerlake.operators.relational import join_groups


@pytest.fixture()
def no_small_tables(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def most_rows_of_a_task(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def loans(spark, n=4000):
    return spark.range(0, n, 1, 8).select("id", F.when(F.col("id") % 50 > 0, F.lit("O")).otherwise(F.lit("F")).alias("g"),
                                          F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("x"),
                                          (F.col("id") % 2).alias("y"))


@pytest.mark.parametrize("how", ["mean", "median"])
def test_fill_group_spreads_a_large_group(spark, no_small_tables, how):
    out = mv.fill_group(loans(spark), "g", how, ["x"])
    assert out.where("x is null").count() == 0 and out.count() == 4000
    assert most_rows_of_a_task(out) < 2000


def test_target_encode_spreads_a_large_group(spark, no_small_tables):
    out = fe.target_encode(loans(spark), ["g"], "y")
    assert {r[0] for r in out.select("g_target_enc").distinct().collect()} == {0.0, 2000 / 3920}
    assert most_rows_of_a_task(out) < 2000


@pytest.mark.parametrize("limit", [2, 5, 10_000])
def test_join_groups_by_size(spark, limit):
    rows = [(i, None if i % 7 == 0 else "hot" if i % 3 else f"k{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "id int, k string")
    stats = df.groupBy("k").agg(F.count(F.lit(1)).alias("_rows"), F.max("id").alias("top"))
    want = {k: max(i for i, x in rows if x == k) for _, k in rows if k}
    got = join_groups(df, stats, "k", limit=limit).collect()
    assert {(r.id, r.k, r.top) for r in got} == {(i, k, want.get(k)) for i, k in rows} and len(got) == len(rows)
