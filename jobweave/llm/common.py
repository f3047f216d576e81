"""Settings, tables and Arrow helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.queries.base import table
from jobweave.session import configure, cut_lineage, shared_folder

__all__ = ["HELD_OUT", "binary_column", "cut_lineage", "held_out", "prepare", "shared_folder", "split_words", "table"]

#: Rows in an Arrow batch.  Texts reach some hundred kilobytes, so that a batch stays below
#: the size that Spark itself allows it.
BATCH_ROWS = 1000
#: One row in five is kept from every fit.
HELD_OUT = 5


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings and small Arrow batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def held_out(doc_id: Column) -> Column:
    """True where the row must not be learned from; a missing id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % HELD_OUT == 0


def split_words(text: Column) -> Column:
    """Words between ASCII white space, in built-ins that Spark compiles."""
    return F.array_remove(F.split(text, r"[\x09-\x0D\x20]+"), "")


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes, null as nothing."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that hold rows."""
    return (b for b in batches if b.num_rows)
