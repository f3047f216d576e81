"""Captured responses, as a landing job stores them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobweave.schema import PAYLOADS, conform
from jobweave.session import shared_folder


def read_payloads(spark: SparkSession, path: str, source: str | None = None,
                  kind: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Payload rows of one source and kind (list, detail, feed, probe).

    Stored as Parquet partitioned by source, the filter prunes folders; the body is
    read only for the rows that remain.
    """
    df = conform(spark.read.format(fmt).load(path), PAYLOADS)
    if source is not None:
        df = df.filter(F.col("source") == source)
    if kind is not None:
        df = df.filter(F.col("kind") == kind)
    return df


def read_text_payloads(spark: SparkSession, path: str, source: str, kind: str,
                       payload_seq: Column, url: Column | None = None) -> DataFrame:
    """Whole files as payload bodies (one response per file).

    ``payload_seq`` gives the arrival order, usually from the file name
    (``file_path`` is available to both expressions).
    """
    raw = spark.read.text(path, wholetext=True).select(
        F.col("value").alias("body"), F.col("_metadata.file_path").alias("file_path")
    )
    filled = raw.withColumns(
        {
            "payload_seq": payload_seq,
            "url": F.col("file_path") if url is None else url,
            "source": F.lit(source),
            "kind": F.lit(kind),
            "status_code": F.lit(200),
        }
    )
    return conform(filled, PAYLOADS)


def by_source(payloads: DataFrame) -> DataFrame:
    """The payloads, written once to the shared folder by source and kind.

    The normalisers filter by both; over this layout each of them reads its own folder, so that
    all together read every body once.  Payloads that were landed in such folders need no copy.
    """
    path = shared_folder(payloads.sparkSession, "payloads")
    payloads.write.partitionBy("source", "kind").parquet(path)
    return conform(payloads.sparkSession.read.schema(payloads.schema).parquet(path), payloads.schema)


def succeeded(df: DataFrame) -> DataFrame:
    """Responses with a 2xx status (a missing status counts as success)."""
    return df.filter(F.coalesce(F.col("status_code").between(200, 299), F.lit(True)))
