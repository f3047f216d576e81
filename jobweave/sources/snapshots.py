"""The stored table: Parquet folders by version and bucket, and a log of committed versions."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from jobweave.schema import JOBS_TABLE
from jobweave.session import cut_lineage

ROW_ID = "row_id"
STORED = T.StructType([T.StructField(ROW_ID, T.StringType()), *JOBS_TABLE])

_LOG = "version int, committed_at string, buckets int, folders map<string,int>, schema string, batch string"


class SnapshotTable:
    """A table whose versions share what did not change.

    Rows lie in ``buckets`` by a hash of their id.  A version's log row names, for each bucket
    that has rows, the version whose folder holds it; a change writes the buckets of its own
    rows and takes the other folders over.  Folders are written before the log row is, so
    readers never see half a version, and a job never overwrites the files it reads.  One
    writer at a time.  A log row can carry the id of the batch that made it, so that a batch
    delivered twice is known.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType = STORED, buckets: int = 64):
        self.spark, self.root, self.schema, self.buckets = spark, root.rstrip("/"), schema, buckets

    @property
    def _log(self) -> str:
        return f"{self.root}/log"

    def folder(self, version: int) -> str:
        return f"{self.root}/data/version={version:06d}"

    def _entries(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_LOG).json(self._log)
        except AnalysisException:
            return None

    def _entry(self, version: int | None = None):
        """The log row of a version, by default the last; None when there is none."""
        log = self._entries()
        if log is None:
            return None
        rows = log if version is None else log.filter(F.col("version") == version)
        return rows.orderBy(F.desc("version")).first()

    def version(self) -> int:
        """Current version; 0 when nothing was committed."""
        entry = self._entry()
        return entry["version"] if entry else 0

    def has_batch(self, batch: str) -> bool:
        """Whether a version was committed under this batch id."""
        log = self._entries()
        return log is not None and not log.filter(F.col("batch") == batch).isEmpty()

    def ensure(self) -> int:
        """Create an empty first version when the table does not exist."""
        if self.version() == 0:
            self.commit(self.spark.createDataFrame([], self.schema))
        return self.version()

    def bucket_of(self, row_id=ROW_ID, buckets: int | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(row_id)), F.lit(buckets or self.buckets)).cast("int")

    def folders(self, version: int | None = None) -> dict[int, str]:
        """The folder of each bucket that has rows."""
        entry = self._entry(version)
        held = (entry["folders"] if entry else None) or {}
        return {int(b): f"{self.folder(v)}/bucket={int(b)}" for b, v in held.items()}

    def read(self, version: int | None = None, only: list[int] | None = None) -> DataFrame:
        """The table, or the rows of some buckets; columns a version lacks are typed NULLs."""
        entry = self._entry(version)
        if entry is None:
            return self.spark.createDataFrame([], self.schema)
        own = T.StructType.fromJson(json.loads(entry["schema"]))
        held = {int(b): v for b, v in (entry["folders"] or {}).items()}
        paths = [f"{self.folder(held[b])}/bucket={b}" for b in sorted(held) if only is None or b in only]
        if not paths:
            return ensure_columns(self.spark.createDataFrame([], own), self.schema)
        return ensure_columns(self.spark.read.schema(own).parquet(*paths), self.schema)

    def _write(self, df: DataFrame, version: int, buckets: int) -> list[int]:
        """Write rows below the version's folder; the buckets that got some."""
        rows = df.withColumn("bucket", self.bucket_of(buckets=buckets))
        # large buckets become several files, small ones share a task
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(self.folder(version))
        written = self.spark.read.schema(rows.schema).parquet(self.folder(version))
        return sorted(r["bucket"] for r in written.select("bucket").distinct().collect())

    def _publish(self, version: int, buckets: int, folders: dict[int, int], schema: T.StructType, batch: str | None) -> int:
        row = [(version, datetime.now(timezone.utc).isoformat(), buckets, {str(b): v for b, v in folders.items()}, schema.json(), batch)]
        self.spark.createDataFrame(row, _LOG).coalesce(1).write.mode("append").json(self._log)
        return version

    def commit(self, df: DataFrame, batch: str | None = None) -> int:
        """Write ``df`` as the whole next version and publish it."""
        version = self.version() + 1
        written = self._write(df, version, self.buckets)
        return self._publish(version, self.buckets, {b: version for b in written}, df.schema, batch)

    def commit_changes(self, changes: DataFrame, deleted: DataFrame | None = None, batch: str | None = None) -> int:
        """Publish a version in which the rows of ``changes`` replace those with their ids, or are
        added, and those of ``deleted`` (row_id) are gone.

        Only the buckets of these rows are read and written; without any the new version is the
        old one under a new number.  ``changes`` holds an id once.
        """
        entry = self._entry()
        if entry is None:
            return self.commit(changes, batch)
        version, buckets, held = entry["version"] + 1, entry["buckets"], {int(b): v for b, v in (entry["folders"] or {}).items()}
        changes = cut_lineage(changes, "changes")
        gone = changes.select(ROW_ID) if deleted is None else changes.select(ROW_ID).union(deleted.select(ROW_ID))
        # at most as many numbers as there are buckets
        touched = sorted(r["bucket"] for r in gone.select(self.bucket_of(buckets=buckets).alias("bucket")).distinct().collect())
        own = T.StructType.fromJson(json.loads(entry["schema"]))
        if touched:
            kept = self.read(entry["version"], touched).join(gone, ROW_ID, "left_anti")
            rows = kept.unionByName(changes, allowMissingColumns=True)
            own = rows.schema
            written = self._write(rows, version, buckets)
            held = {b: v for b, v in held.items() if b not in set(touched)} | {b: version for b in written}
        return self._publish(version, buckets, held, own, batch)


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the schema's missing columns as typed NULLs; others keep their place."""
    have = {c.lower() for c in df.columns}
    missing = [f for f in schema if f.name.lower() not in have]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df


def empty_clone(df: DataFrame) -> DataFrame:
    """An empty table with the columns of ``df``."""
    return df.sparkSession.createDataFrame([], df.schema)
