"""Session settings and lineage cutting shared by the jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a job wants whatever the cluster.  Shuffle partition count and memory
# stay with the cluster; AQE coalesces or splits from there.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot key must be split even where the split costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # keeps row_number() <= k as a per-map-task pre-reduction
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "jobweave", cores: str = "*", **conf: str) -> SparkSession:
    """A single-machine session, for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate files, below the one the cluster names.

    That is ``spark.checkpoint.dir``; where it is unset, the warehouse, which driver and
    executors share as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
    return f"{shared.rstrip('/')}/jobweave-{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Used where a costly intermediate feeds several outputs: it is computed once, the
    loss of executors does not bring it back, and Spark knows its size when it picks
    joins.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
