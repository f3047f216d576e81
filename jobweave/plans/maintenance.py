"""Repair jobs over the published table: read, repair, publish, report."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from jobweave.operators import backfill
from jobweave.schema import TABLE_COLUMNS
from jobweave.session import cut_lineage
from jobweave.sources.snapshots import ROW_ID, SnapshotTable


def repairs(as_of) -> dict[str, Callable[[DataFrame], DataFrame]]:
    return {
        "it-flags": backfill.backfill_it_flags,
        "locations": backfill.backfill_location_parts,
        "variants": lambda t: backfill.backfill_variants(t, as_of),
        "cities": lambda t: backfill.cleanup_cities(t, as_of),
        "categories": backfill.backfill_categories,
    }


def changed_rows(before: DataFrame, after: DataFrame, columns: Sequence[str] = tuple(TABLE_COLUMNS)) -> tuple[DataFrame, DataFrame]:
    """(changed and added rows of ``after`` with ``_new``, ids of rows that are gone).

    Rows are compared by a hash of ``columns``; of the old table only ids and hashes move.
    """
    digest = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])
    old = before.select(ROW_ID, digest.alias("_old"))
    both = after.withColumn("_digest", digest).join(old, ROW_ID, "left")
    changed = both.filter(F.col("_old").isNull() | (F.col("_old") != F.col("_digest")))
    gone = before.select(ROW_ID).join(after.select(ROW_ID), ROW_ID, "left_anti")
    return changed.withColumn("_new", F.col("_old").isNull()).drop("_old", "_digest"), gone


def repair(store: SnapshotTable, name: str, as_of) -> DataFrame:
    """Publish the repaired table as the next version; returns the changed-row counts.

    Only buckets with changed rows are written, and the rows are counted as they are.
    """
    target = store.read()
    after = repairs(as_of)[name](target.withColumn("row_order", F.xxhash64(ROW_ID))).select(ROW_ID, *TABLE_COLUMNS)
    changed, gone = changed_rows(target, after)
    counted, dropped = Observation("changed"), Observation("gone")
    total = F.count(F.lit(1))
    changed = changed.observe(counted, F.count_if("_new").alias("inserted"), total.alias("n")).drop("_new")
    gone = cut_lineage(gone.observe(dropped, total.alias("n")), "gone")
    store.commit_changes(changed, gone)
    updated, deleted = counted.get["n"] - counted.get["inserted"], dropped.get["n"]
    row = (updated, counted.get["inserted"], deleted, target.count() - updated - deleted)
    return store.spark.createDataFrame([row], "updated long, inserted long, deleted long, unchanged long")
