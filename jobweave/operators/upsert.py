"""Staging, refresh of stored rows, and insert of new ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobweave.functions.classify import normalize_category, with_it_flags
from jobweave.functions.location import city_of, state_of
from jobweave.functions.text import blank_to_null, clean, normalize_key
from jobweave.operators.dedupe import last_per_keys
from jobweave.operators.keys import spread_blank
from jobweave.schema import TABLE_COLUMNS
from jobweave.session import cut_lineage

STAGE_KEYS = [
    "normalized_reference", "normalized_url", "normalized_title", "normalized_company",
    "normalized_location",
]
# columns a refresh fills only where the incoming value is present, and those it overwrites
FILLED = [
    "Location", "Title", "city", "state", "country", "job_type", "posted_at", "company",
    "category", "url", "description",
]
OVERWRITTEN = {"Isremote": "Isremote", "IsIT": "IsIT", "ITScore": "ITScore", "inserteddate": "last_seen"}


def prepare(jobs: DataFrame, classified: bool = False) -> DataFrame:
    """Set the IT flags (unless a batch step did) and the normalised category."""
    flagged = jobs if classified else with_it_flags(jobs)
    return flagged.withColumn("category", normalize_category("category", "title", "description"))


def _timestamp(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp")


def _city_state(jobs: DataFrame) -> list[Column]:
    """City and state: what a place list said (``place_city``, ``place_state``), else "City, ST"."""
    if "place_city" in jobs.columns:
        return [clean("place_city").alias("city"), clean("place_state").alias("state")]
    return [clean(city_of("location")).alias("city"), clean(state_of("location")).alias("state")]


def stage(jobs: DataFrame, last_seen, row_key: Sequence[str] = ("seq",)) -> DataFrame:
    """Staging rows of a refresh: cleaned values and the five match keys."""
    return jobs.select(
        F.struct(*row_key).alias("stage_id"),
        clean("location").alias("Location"),
        clean("title").alias("Title"),
        *_city_state(jobs),
        F.lit("USA").alias("country"),
        clean("job_type").alias("job_type"),
        F.col("date_posted").alias("posted_at"),
        clean("company").alias("company"),
        F.coalesce(F.col("is_remote"), F.lit(False)).cast("int").alias("Isremote"),
        clean("category").alias("category"),
        clean("job_url").alias("url"),
        clean("description").alias("description"),
        F.col("is_it").alias("IsIT"),
        F.col("it_score").alias("ITScore"),
        _timestamp(last_seen).alias("last_seen"),
        normalize_key("external_id").alias("normalized_reference"),
        normalize_key("job_url").alias("normalized_url"),
        normalize_key("title").alias("normalized_title"),
        normalize_key("company").alias("normalized_company"),
        normalize_key("location").alias("normalized_location"),
    )


def dedupe_stage(staged: DataFrame, keys: Sequence[str] = tuple(STAGE_KEYS)) -> DataFrame:
    """Last staged row per key combination."""
    return last_per_keys(staged, keys, ["stage_id"])


def generated_reference(*parts) -> Column:
    """Stable reference for a posting without one (the same row gives the same id)."""
    text = F.concat_ws("|", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit("gen-"), F.left(F.sha2(text.cast("binary"), 256), F.lit(32)))


def insert_rows(jobs: DataFrame, inserted_at, row_key: Sequence[str] = ("seq",)) -> DataFrame:
    """Stored form of new postings: 18 columns, cleaned and whole."""
    generated = generated_reference(*row_key, "title", "company", "location", "job_url")
    return jobs.select(
        F.coalesce(clean("external_id"), generated).alias("job_reference"),
        clean("location").alias("Location"),
        clean("title").alias("Title"),
        *_city_state(jobs),
        F.lit(None).cast("string").alias("zip"),
        F.lit("USA").alias("country"),
        clean("job_type").alias("job_type"),
        F.col("date_posted").alias("posted_at"),
        clean("company").alias("company"),
        F.coalesce(F.col("is_remote"), F.lit(False)).cast("int").alias("Isremote"),
        clean("category").alias("category"),
        clean("job_url").alias("url"),
        clean("description").alias("description"),
        F.lit(0).cast("decimal(18,2)").alias("cpc"),
        _timestamp(inserted_at).alias("inserteddate"),
        F.col("is_it").alias("IsIT"),
        F.col("it_score").alias("ITScore"),
    )


def split_insertable(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(insertable rows, rejected rows): a stored row needs a title and a company."""
    ok = blank_to_null("Title").isNotNull() & blank_to_null("company").isNotNull()
    return rows.filter(ok), rows.filter(~ok)


def _after(new: Column, old: Column) -> Column:
    """Key of a column after a pass: the staged value where present."""
    return F.when(new.isNotNull(), normalize_key(new)).otherwise(old)


def refresh_matches(target: DataFrame, staged: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Which staged rows hit which stored row: (row_id, pass, stage_id).

    Pass 1 matches on the reference, pass 2 on the URL of staged rows without a
    reference, pass 3 on title, company and location of staged rows with neither; a
    filled reference that matches nothing does not fall through.  Each pass sees the
    keys the earlier passes left.  Staged rows are reduced to the last one per key
    first, so every join has at most one match per stored row.  Only key columns move.
    """
    values = ["url", "Title", "company", "Location"]
    ref, url = F.col("normalized_reference"), F.col("normalized_url")
    text = ["normalized_title", "normalized_company", "normalized_location"]
    slim = staged.select("stage_id", *STAGE_KEYS, *values)

    def side(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
        best = last_per_keys(rows, keys, ["stage_id"])
        return best.select(
            *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)],
            F.col("stage_id").alias(f"s{n}"),
            *[F.col(v).alias(f"v{n}_{v}") for v in values],
        )

    t = target.select(
        F.col(row_id),
        normalize_key("job_reference").alias("ref"),
        normalize_key("url").alias("url"),
        normalize_key("Title").alias("title"),
        normalize_key("company").alias("company"),
        normalize_key("Location").alias("location"),
    )

    def apply(t: DataFrame, s: DataFrame, n: int, condition: Column) -> DataFrame:
        joined = t.join(s, condition, "left")
        return joined.select(
            row_id, "ref",
            _after(F.col(f"v{n}_url"), F.col("url")).alias("url"),
            _after(F.col(f"v{n}_Title"), F.col("title")).alias("title"),
            _after(F.col(f"v{n}_company"), F.col("company")).alias("company"),
            _after(F.col(f"v{n}_Location"), F.col("location")).alias("location"),
            *[f"s{i}" for i in range(1, n + 1)],
        )

    s1 = side(slim.filter(ref != ""), ["normalized_reference"], 1)
    t = apply(t, s1, 1, spread_blank(F.col("ref"), row_id) == F.col("k0"))
    s2 = side(slim.filter((ref == "") & (url != "")), ["normalized_url"], 2)
    t = apply(t, s2, 2, spread_blank(F.col("url"), row_id) == F.col("k0"))
    s3 = side(
        slim.filter(
            (ref == "") & (url == "") & (F.col(text[0]) != "") & (F.col(text[1]) != "")
        ),
        text, 3,
    )
    t = apply(
        t, s3, 3,
        (spread_blank(F.col("title"), row_id) == F.col("k0"))
        & (F.col("company") == F.col("k1"))
        & (F.col("location") == F.col("k2")),
    )
    hits = F.filter(
        F.array(*[F.struct(F.lit(n).alias("pass"), F.col(f"s{n}").alias("stage_id")) for n in (1, 2, 3)]),
        lambda h: h["stage_id"].isNotNull(),
    )
    return t.select(row_id, F.explode(hits).alias("h")).select(row_id, "h.pass", "h.stage_id")


def _updates(target: DataFrame, staged: DataFrame, row_id: str) -> DataFrame:
    """One row of new values per stored row that a staged one hits; only keys of ``target`` are read."""
    hit = refresh_matches(target, staged, row_id).join(
        staged.select("stage_id", *FILLED, *OVERWRITTEN.values()), "stage_id"
    )
    return hit.groupBy(row_id).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("pass"))).alias(f"u_{c}") for c in FILLED],
        *[F.max_by(s, "pass").alias(f"u_{c}") for c, s in OVERWRITTEN.items()],
        F.lit(True).alias("u_hit"),
    )


def _updated(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    def value(c: str) -> Column:
        if c in OVERWRITTEN:
            return F.when(F.col("u_hit"), F.col(f"u_{c}")).otherwise(F.col(c)).alias(c)
        if c in FILLED:
            return F.coalesce(F.col(f"u_{c}"), F.col(c)).alias(c)
        return F.col(c)

    return joined.select(*[value(c) for c in columns])


def refresh(target: DataFrame, staged: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Stored rows after the refresh, all of them, with the columns of ``target``.

    Values of the matched staged rows are folded into one update per stored row; the
    stored table itself moves once, and not at all when the updates are small enough
    for Spark to broadcast.
    """
    return _updated(target.join(_updates(target, staged, row_id), row_id, "left"), target.columns)


def _new_rows(fresh: DataFrame, as_of, row_key: Sequence[str], row_id: str, classified: bool) -> DataFrame:
    """Stored form of new postings: a new row's id is 'new:<reference>', since its reference is in
    neither the table nor another new row."""
    rows = insert_rows(prepare(fresh, classified), as_of, row_key)
    return rows.select(F.concat(F.lit("new:"), F.col("job_reference")).alias(row_id), *TABLE_COLUMNS)


def staged_duplicates(duplicates: DataFrame, as_of, row_key: Sequence[str] = ("seq",), classified: bool = False) -> DataFrame:
    """Staging rows, written once: they feed three match sides and the update itself."""
    return cut_lineage(dedupe_stage(stage(prepare(duplicates, classified), as_of, row_key)), "stage")


def upsert(target: DataFrame, duplicates: DataFrame, fresh: DataFrame, as_of,
           row_key: Sequence[str] = ("seq",), row_id: str = "row_id", classified: bool = False) -> DataFrame:
    """The stored table after refreshing ``duplicates`` and inserting ``fresh``.

    Both inputs are standard postings.
    """
    updated = refresh(target, staged_duplicates(duplicates, as_of, row_key, classified), row_id)
    return updated.select(row_id, *TABLE_COLUMNS).unionByName(_new_rows(fresh, as_of, row_key, row_id, classified))


def upsert_changes(target: DataFrame, keys: DataFrame, duplicates: DataFrame, fresh: DataFrame, as_of,
                   row_key: Sequence[str] = ("seq",), row_id: str = "row_id", classified: bool = False) -> DataFrame:
    """The rows that ``upsert`` changes or adds, with their ids, and no others.

    ``keys`` has the id and key columns of ``target``, which itself is read for the rows hit only.
    """
    updates = _updates(keys, staged_duplicates(duplicates, as_of, row_key, classified), row_id)
    hit = _updated(target.join(updates, row_id), [row_id, *TABLE_COLUMNS])
    return hit.unionByName(_new_rows(fresh, as_of, row_key, row_id, classified))


def repair_report(before: DataFrame, after: DataFrame, row_id: str, columns: Sequence[str]) -> DataFrame:
    """Rows updated, inserted, deleted and unchanged between two states of the table."""
    digest = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])
    old = before.select(row_id, digest.alias("old"))
    new = after.select(row_id, digest.alias("new"))
    both = old.join(new, row_id, "full_outer")
    o, n = F.col("old"), F.col("new")
    return both.agg(
        F.count_if(o.isNotNull() & n.isNotNull() & (o != n)).alias("updated"),
        F.count_if(o.isNull()).alias("inserted"),
        F.count_if(n.isNull()).alias("deleted"),
        F.count_if(o == n).alias("unchanged"),
    )
