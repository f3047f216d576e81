"""Incremental ingest of landed postings, and streaming first-occurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from jobweave.plans.ingest import ingest
from jobweave.sources.snapshots import ROW_ID, SnapshotTable


def read_landed(spark: SparkSession, path: str, schema: StructType, glob: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Stream of landed Parquet files, at most ``files_per_batch`` of them in a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def ingest_batch(batch: DataFrame, store: SnapshotTable, as_of, batch_name: str) -> bool:
    """Ingest one batch of standard postings, unless a version was made of it before.

    The version's log row carries the batch's name, and is written last: a batch that failed
    midway left no version and is ingested again; one that got through is not.
    """
    if store.has_batch(batch_name):
        return False
    target = store.read().withColumn("row_order", F.xxhash64(ROW_ID))
    store.commit_changes(ingest(batch, target, as_of).changes, batch=batch_name)
    return True


def ingest_stream(postings: DataFrame, store: SnapshotTable, checkpoint: str, as_of, name: str = "ingest") -> StreamingQuery:
    """Run every micro-batch of standard postings through the batch ingest, each once.

    Spark numbers micro-batches in the checkpoint and delivers the last one again after a
    failure; ``name`` tells the streams of a table apart.  Stops when all landed files are read.
    """
    store.ensure()
    return (
        postings.writeStream.foreachBatch(lambda batch, n: ingest_batch(batch, store, as_of, f"{name}:{n}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def keep_state_on_disk(spark: SparkSession) -> None:
    """State of streams in RocksDB: it may outgrow the executors' memory, and a checkpoint writes
    what changed only.  Set before a stream starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def first_within(stream: DataFrame, keys: list[str], time: str, horizon: str, *extra: Column) -> DataFrame:
    """First row per key within a time horizon, such as "7 days".

    A key is remembered until the stream's time is a horizon past the row's, so the state
    holds the keys of one horizon, however long the stream runs.  Rows older than that when
    they come are dropped.
    """
    rows = stream.withColumns({f"_k{i}": c for i, c in enumerate(extra)}) if extra else stream
    names = [*keys, *[f"_k{i}" for i in range(len(extra))]]
    return rows.withWatermark(time, horizon).dropDuplicatesWithinWatermark(names).drop(
        *[f"_k{i}" for i in range(len(extra))]
    )
