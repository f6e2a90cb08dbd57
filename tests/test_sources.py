"""Sources and sinks."""

import glob
import os

import pytest
from pyspark.sql import Window, functions as F

from cohortspark import sources
from cohortspark.session import inline, settle

FOLDER = "/root/testdata/sf0.001"


def test_load_prunes_and_limits(spark):
    li = sources.load(spark, FOLDER, "lineitem", ["l_orderkey", "l_tax"], 7)
    assert li.columns == ["l_orderkey", "l_tax"] and li.count() == 7
    plan = sources.load(spark, FOLDER, "lineitem", ["l_orderkey"]).filter("l_tax > 0.05")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in plan and "GreaterThan(l_tax,0.05)" in plan


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "lookup")
    sources.save_csv(inline(spark, [("A", "x"), ("B", None)], "Category string, Remap0 string").coalesce(1), path)
    text = open(glob.glob(path + "/*.csv")[0]).read().splitlines()
    assert text == ["Category,Remap0", "A,x", "B,"]
    df = sources.load_lookup(spark, path, "Category string, Remap0 string")
    assert df.columns == ["category", "remap0"] and {tuple(r) for r in df.collect()} == {("A", "x"), ("B", None)}


def test_register_replaces(spark):
    sources.register(spark.range(2).toDF("a"), "cohort_ids")
    sources.register(spark.range(3).toDF("a"), "cohort_ids")
    assert spark.table("cohort_ids").count() == 3


def test_materialize_overwrites(spark, tmp_path):
    path = str(tmp_path / "stage")
    sources.materialize(spark.range(5).toDF("a"), path)
    again = sources.materialize(spark.range(2).select(F.col("id").alias("a"), (F.col("id") % 2).alias("p")), path, ["p"])
    assert again.count() == 2 and sorted(d for d in os.listdir(path) if "=" in d) == ["p=0", "p=1"]


def test_save_partitioned_keeps_entities_in_order(spark, tmp_path):
    path = str(tmp_path / "entities")
    df = spark.range(1000).select((F.col("id") % 7).alias("hadm_id"), F.col("id").alias("t_since"))
    sources.save_partitioned(df.repartition(5), "hadm_id", path, ["t_since"], files=4)
    files = glob.glob(path + "/*.parquet")
    assert 2 <= len(files) <= 4
    for f in files:
        got = [tuple(r) for r in spark.read.parquet(f).collect()]
        assert got == sorted(got)
    assert spark.read.parquet(path).count() == 1000


def test_buckets_need_no_shuffle(spark, tmp_path):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.range(500).select((F.col("id") % 50).alias("hadm_id"), F.col("id").alias("a")).repartition(3)
        b = spark.range(100).select(F.col("id").alias("hadm_id"), (F.col("id") % 7).alias("b"))
        left = sources.save_bucketed(a, str(tmp_path / "a"), "bucketed_a", ["hadm_id"], 6)
        right = sources.save_bucketed(b, str(tmp_path / "b"), "bucketed_b", ["hadm_id"], 6)
        assert len(glob.glob(str(tmp_path / "a" / "*.parquet"))) <= 6
        joined = left.join(right, "hadm_id", "left")
        ranked = joined.withColumn("r", F.row_number().over(Window.partitionBy("hadm_id").orderBy("a")))
        for df in (joined, ranked, joined.groupBy("hadm_id").agg(F.sum("b"))):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in joined.collect()} == {tuple(r) for r in a.join(b, "hadm_id", "left").collect()}
        assert sources.save_bucketed(b, str(tmp_path / "b"), "bucketed_b", ["hadm_id"], 6).count() == 100  # written again
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_settle_uses_the_session_folder(spark):
    df = settle(spark.range(10).withColumn("b", F.col("id") * 2))
    folder = spark.sparkContext.getCheckpointDir()
    assert folder and df.count() == 10
    assert spark.sparkContext.getCheckpointDir() == (settle(df) and folder)


def test_inline_is_a_local_relation(spark):
    df = inline(spark, [(1, None)], "a bigint, b string")
    assert "LocalTableScan" in df._jdf.queryExecution().toString()
    assert inline(spark, [], "a bigint").count() == 0


@pytest.mark.parametrize("name", ["entry"])
def test_entry(spark, name):
    import __spark_entry__

    assert getattr(__spark_entry__, name)(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
