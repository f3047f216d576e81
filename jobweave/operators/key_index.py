"""Keys of the stored table, kept beside it, and estimates of how many there are.

Matching a batch needs the distinct references, URLs and fingerprints of the whole table.  The
index holds them as its own table in buckets of the key, so that a probe neither reads the
stored rows nor moves their keys: only the batch's keys are shuffled, into as many partitions
as there are buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobweave.operators.keys import REF, TEXT, URL, existing_keys, key_entries
from jobweave.session import shared_folder

KINDS = {REF: "references", URL: "urls", TEXT: "fingerprints"}


class KeyIndex:
    """Distinct (kind, key) of a table, as a bucketed table of the session's catalogue.

    ``build`` makes the index of a table, ``add`` extends it by rows that are new to the table.
    After rows were deleted, or changed in a key column, the index is built again: a key that
    no row has any more would make a posting count as known.  The files lie in the shared
    folder.
    """

    def __init__(self, spark: SparkSession, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.name, self.path = f"jobweave_keys_{uuid.uuid4().hex}", shared_folder(spark, "keys")

    def _save(self, keys: DataFrame, mode: str) -> None:
        # one file per bucket and write
        dealt = keys.repartition(self.buckets, "kind", "key")
        dealt.write.mode(mode).format("parquet").option("path", self.path).bucketBy(self.buckets, "kind", "key").saveAsTable(self.name)

    def build(self, target: DataFrame, **columns) -> KeyIndex:
        self._save(existing_keys(target, **columns), "overwrite")
        return self

    def add(self, rows: DataFrame, **columns) -> KeyIndex:
        fresh = existing_keys(rows, **columns).join(self.keys(), ["kind", "key"], "left_anti").select("kind", "key")
        self._save(fresh, "append")
        return self

    def keys(self) -> DataFrame:
        return self.spark.table(self.name)

    def known(self, probe: DataFrame, *carry: str) -> DataFrame:
        """The distinct ``carry`` columns of probe rows (kind, key) whose key the index has."""
        return probe.join(self.keys(), ["kind", "key"], "left_semi").select(*carry).distinct()


def key_sketches(target: DataFrame, by: list[str] | None = None, **columns) -> DataFrame:
    """An HLL sketch of the keys of each kind, per group of ``by``; sketches of parts can be merged.

    Unlike exact counts, they need no shuffle of the keys: one row per group and map task moves.
    """
    names = {"ref": "job_reference", "url": "url", "title": "Title", "company": "company", "location": "Location", **columns}
    entries = key_entries(target, by or [], **names)
    return entries.groupBy(*(by or []), "kind").agg(F.hll_sketch_agg("key", 14).alias("sketch"))


def estimated_sizes(sketches: DataFrame) -> DataFrame:
    """Estimated numbers of references, URLs and fingerprints of all parts together."""
    merged = sketches.groupBy("kind").agg(F.hll_union_agg("sketch").alias("sketch"))
    n = F.hll_sketch_estimate("sketch")
    return merged.agg(*[F.coalesce(F.sum(F.when(F.col("kind") == kind, n)), F.lit(0)).cast("bigint").alias(name) for kind, name in KINDS.items()])
