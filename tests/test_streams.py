"""State of a stream stays within its horizon, and repeats within it go."""

from datetime import datetime, timedelta

from jobweave.streaming.ingest import first_within, keep_state_on_disk, read_landed

SCHEMA = "id long, ts timestamp, note string"


def test_state_falls_behind_the_horizon(spark, tmp_path):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    keep_state_on_disk(spark)
    try:
        landed, day = str(tmp_path / "in"), datetime(2024, 1, 1)
        for n in range(5):  # ten days apart: the keys of one file are forgotten by the next but one
            rows = [(n * 100 + i, day + timedelta(days=10 * n, minutes=i), "first") for i in range(100)]
            rows += [(i, t, "again") for i, t, _ in rows[:30]]
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landed)
        stream = read_landed(spark, landed, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
        run = first_within(stream, ["id"], "ts", "2 days").writeStream.format("parquet").option("path", str(tmp_path / "out"))
        run = run.option("checkpointLocation", str(tmp_path / "offsets")).trigger(availableNow=True).start()
        run.awaitTermination()
        held = [p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"]]
        assert max(held) <= 200 and sum(p["numInputRows"] for p in run.recentProgress) == 650
        assert "RocksDB" in str(run.recentProgress[0]["stateOperators"][0]["customMetrics"]) or "rocksdb" in str(run.recentProgress[0]["stateOperators"][0]["customMetrics"])
        out = spark.read.schema(SCHEMA).parquet(str(tmp_path / "out"))
        assert out.count() == 500 == out.select("id").distinct().count()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
