"""The jobs-like view: its rows leave the few row groups of a table's file."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from jobweave.queries import jobsview


def _tables(spark, folder, n):
    day = datetime.datetime(2024, 1, 1)
    tables = {
        "orders": spark.range(n).select(
            F.col("id").alias("o_orderkey"), (F.col("id") % 3).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            F.rand(1).alias("o_totalprice"), F.lit(day).alias("o_orderdate"), F.lit("2-HIGH").alias("o_orderpriority"),
        ),
        "customer": spark.createDataFrame([(i, f"C{i}", 0, 0.0, "MACHINERY") for i in range(3)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": spark.createDataFrame([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(0, "AMERICA")], "r_regionkey int, r_name string"),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_rows_of_one_row_group_reach_several_tasks(spark, tmp_path):
    _tables(spark, tmp_path, 400_000)
    rows = jobsview.jobs(spark, str(tmp_path), spread=True).select("seq", F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert sum(r["count"] for r in rows) == 400_000
    assert len(rows) > 1
    assert max(r["count"] for r in rows) < 300_000


def test_repeated_keys_keep_their_rows(spark, tmp_path):
    _tables(spark, tmp_path, 50)
    twice = spark.read.parquet(f"{tmp_path}/orders.parquet")
    twice.union(twice).write.parquet(f"{tmp_path}/two/orders.parquet")
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").write.parquet(f"{tmp_path}/two/{name}.parquet")
    assert jobsview.jobs(spark, f"{tmp_path}/two", spread=True).count() == 100


def test_ingest_and_readers_deal_their_orders_out(spark, tmp_path):
    from jobweave.queries import REGISTRY

    _tables(spark, tmp_path, 50)
    for name in ("norm_recruitee", "norm_jobicy"):
        plan = REGISTRY[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression [o_orderkey" in plan
