"""Site catalogues: CSV with a header, every column text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def _headers(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """(header line, files that begin with it) of the catalogue files at ``path``."""
    lines = spark.read.option("encoding", "UTF-8").text(path).where("_metadata.file_block_start = 0")
    first = lines.select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    first = first.filter(F.trim("value") != "").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    files = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [(r["header"], r["files"]) for r in files.orderBy("header").collect()]


def read_catalog_csv(spark: SparkSession, path: str, order: str | None = None) -> DataFrame:
    """Rows of one or more catalogue files; short rows are padded, blank lines skipped.

    Missing cells are ''.  Header names are trimmed and found ignoring case.  Files are read by
    their own header, in groups of one header each; a column that only some files have is ''
    in the others.  The file names come to the driver; catalogues are tens of files.  With
    ``order`` a column of that name gives the position of a row: file, block, row.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("encoding", "UTF-8").option("mode", "PERMISSIVE")
    out = None
    for _, files in _headers(spark, path) or [("", [path])]:
        df = reader.csv(files)
        names = [c.lstrip("\ufeff").strip() for c in df.columns]
        cells = [F.coalesce(F.col(f"`{old}`"), F.lit("")).alias(new) for old, new in zip(df.columns, names)]
        if order is not None:
            cells.append(F.struct(
                F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
            ).alias(order))
        part = df.select(*cells)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.na.fill("", [c for c, kind in out.dtypes if kind == "string"])


def write_catalog_csv(df: DataFrame, path: str, fields: Sequence[str]) -> None:
    """Write ``fields`` in order; a missing field is empty; quotes only where needed."""
    df.select(
        *[
            F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) if f in df.columns else F.lit("").alias(f)
            for f in fields
        ]
    ).write.mode("overwrite").option("header", True).option("escape", '"').option(
        "emptyValue", ""
    ).csv(path)
