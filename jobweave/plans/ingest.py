"""Full ingest: payloads or postings in, a new version of the stored table out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from jobweave.functions.classify import it_score, with_it_flags
from jobweave.operators import dedupe, expand, reports, upsert
from jobweave.operators.backfill import flag_fills, with_flags
from jobweave.operators.ordering import take_first
from jobweave.operators.places import with_places
from jobweave.schema import ROW_KEY, TABLE_COLUMNS
from jobweave.session import cut_lineage
from jobweave.sources.registry import normalize_payloads
from jobweave.sources.snapshots import ROW_ID, SnapshotTable

IN_ORDER = list(ROW_KEY)


@dataclass
class Ingest:
    """The parts of one run; all lazy except the batch, its status, and the changed rows."""

    batch: DataFrame
    status: DataFrame
    target: DataFrame
    changes: DataFrame

    @property
    def table(self) -> DataFrame:
        """The whole table afterwards."""
        same = self.target.join(self.changes.select(ROW_ID), ROW_ID, "left_anti")
        return same.select(ROW_ID, *TABLE_COLUMNS).unionByName(self.changes)

    def counts(self) -> DataFrame:
        return dedupe.status_counts(self.status)

    def coverage(self) -> DataFrame:
        fields = {"job type": "job_type", "category": "category", "posted date": "date_posted"}
        return reports.coverage(self.batch, fields, ["source_name"])

    def classes(self) -> DataFrame:
        return reports.class_counts(self.batch)


def prepare_batch(postings: DataFrame) -> DataFrame:
    """Classified and expanded batch; the location filter was applied per source.

    The class does not depend on the location, so it is set once per posting.
    """
    return expand.expand_locations(with_it_flags(postings))


def ingest(postings: DataFrame, target: DataFrame, as_of, limit: int | None = None,
           places: DataFrame | None = None) -> Ingest:
    """Refresh known postings and add new ones.

    ``target`` needs row_id and row_order.  The batch and the status of its rows are
    written once, because refresh, insert and the reports all read them.  ``limit``
    applies to refresh and insert separately, in arrival order.  With ``places`` (city, state,
    code), cities and states come from that list, and by pattern where it knows nothing.
    """
    batch = prepare_batch(postings)
    if places is not None:
        batch = with_places(batch, places, city="place_city", state="place_state", fallback=True)
    batch = cut_lineage(batch, "batch")
    keys = cut_lineage(stored_keys(target), "keys")
    status = cut_lineage(dedupe.batch_status(batch, keys, IN_ORDER), "status")
    split = batch.join(status, IN_ORDER)
    known = split.filter(F.col("status") == dedupe.EXISTING).drop("status")
    fresh = split.filter(F.col("status") == dedupe.NEW).drop("status")
    if limit is not None:
        known, fresh = take_first(known, limit, *IN_ORDER), take_first(fresh, limit, *IN_ORDER)
    changes = cut_lineage(upsert.upsert_changes(target, keys, known, fresh, as_of, IN_ORDER, classified=True), "changes")
    return Ingest(batch, status, target, _with_filled_flags(target, keys, changes))


def stored_keys(target: DataFrame) -> DataFrame:
    """What matching needs of the stored table, read once: ids, keys, and the score of rows
    that lack a flag."""
    lacking = F.col("IsIT").isNull() | F.col("ITScore").isNull()
    score = F.when(lacking, it_score("Title", "category", "description"))
    return target.select(ROW_ID, "row_order", "job_reference", "url", "Title", "company", "Location", score.alias("score"))


def _with_filled_flags(target: DataFrame, keys: DataFrame, changes: DataFrame) -> DataFrame:
    """``changes``, and the stored rows whose flags the backfill sets after them.

    Changed and new rows are classified, so only stored rows that stay as they are can lack
    flags; they pass them on to every row that shares their reference or URL.
    """
    same = keys.join(changes.select(ROW_ID), ROW_ID, "left_anti")
    lacking = same.filter(F.col("score").isNotNull())
    if lacking.isEmpty():
        return changes
    reach = same.select(ROW_ID, "job_reference", "url").unionByName(changes.select(ROW_ID, "job_reference", "url"))
    fills = cut_lineage(flag_fills(lacking, reach), "fills")
    rest = target.join(changes.select(ROW_ID), ROW_ID, "left_anti").select(ROW_ID, *TABLE_COLUMNS)
    filled = with_flags(changes.join(fills, ROW_ID, "left")).unionByName(with_flags(rest.join(fills, ROW_ID)))
    return cut_lineage(filled.select(ROW_ID, *TABLE_COLUMNS), "filled")


def ingest_payloads(payloads: DataFrame, store: SnapshotTable, as_of, only: str | None = None,
                    limit: int | None = None, places: DataFrame | None = None) -> Ingest:
    """Normalise captured payloads, ingest them, and publish the next version."""
    store.ensure()
    postings = normalize_payloads(payloads, only, as_of=as_of)
    target = store.read().withColumn("row_order", F.xxhash64(ROW_ID))
    run = ingest(postings, target, as_of, limit, places)
    store.commit_changes(run.changes)
    return run
