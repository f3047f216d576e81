"""URL archive lines: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobweave.functions.text import is_blank


def read_cdx_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """URLs of archive index lines; broken lines and blank URLs are skipped."""
    return urls_of_lines(spark.read.text(path), "value")


def urls_of_lines(df: DataFrame, line: str, *carry: str) -> DataFrame:
    """The url field of a column of JSON lines."""
    parsed = df.select(*carry, F.from_json(line, "url string")["url"].alias("url"))
    return parsed.filter(~is_blank("url"))
