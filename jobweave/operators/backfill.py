"""Table-wide repair jobs: each takes the stored table and returns it repaired."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave.functions.classify import it_score, normalize_category
from jobweave.functions.location import (
    city_of,
    cleanup_source,
    expansion_source,
    has_separator,
    safe_city,
    state_of,
)
from jobweave.functions.text import clean, is_blank, normalize_key, same
from jobweave.operators.dedupe import first_per_key, last_per_keys
from jobweave.operators.expand import with_variants
from jobweave.operators.filters import has_unsafe_city, is_multi_location
from jobweave.operators.keys import any_key_winner, key_entries
from jobweave.operators.rows import fixed
from jobweave.schema import TABLE_COLUMNS

# a repair job needs (row_id, order): a unique id and the scan order of the table


def backfill_it_flags(target: DataFrame, row_id: str = "row_id", order: str = "row_order") -> DataFrame:
    """Classify rows lacking a flag or score, and every row sharing their reference or URL.

    Where several such rows reach one stored row, the last in scan order counts.
    """
    missing = target.filter(F.col("IsIT").isNull() | F.col("ITScore").isNull())
    scored = missing.select(
        order, "job_reference", "url", it_score("Title", "category", "description").alias("score")
    )
    # a row can be reached only through a key of an unclassified row
    return with_flags(target.join(flag_fills(scored, target, row_id, order), row_id, "left")).select(*target.columns)


def flag_fills(scored: DataFrame, keys: DataFrame, row_id: str = "row_id", order: str = "row_order") -> DataFrame:
    """(row_id, score) of the rows whose flags ``backfill_it_flags`` sets.

    ``scored`` has order, job_reference, url and score of the rows lacking a flag; ``keys`` the
    id, job_reference and url of all rows.
    """
    source = key_entries(scored, [order, "score"], "job_reference", "url")
    entries = key_entries(keys, [row_id], "job_reference", "url")
    return any_key_winner(entries, source, ["kind", "key"], row_id, order, "score")


def with_flags(rows: DataFrame) -> DataFrame:
    """Rows with a ``score`` (or NULL), which sets their flags and is dropped."""
    score = F.col("score")
    new = {"IsIT": F.when(score.isNotNull(), score > 0).otherwise(F.col("IsIT")), "ITScore": F.coalesce(score, F.col("ITScore"))}
    return rows.select(*[new.get(c, F.col(c)).alias(c) for c in rows.columns if c != "score"])


def backfill_location_parts(target: DataFrame) -> DataFrame:
    """Recompute city and state where they differ beyond case.

    Both depend on the row's own location only, however it is padded or cased, so every row
    is repaired where it is, and a second run changes nothing.
    """
    city, state = city_of("Location"), state_of("Location")
    changed = ~is_blank("Location") & (~same("city", city) | ~same("state", state))
    new = {"city": F.when(changed, clean(city)).otherwise(F.col("city")), "state": F.when(changed, clean(state)).otherwise(F.col("state"))}
    return target.select(*[new.get(c, F.col(c)).alias(c) for c in target.columns])


def _place_columns(location: Column) -> dict[str, Column]:
    return {
        "Location": clean(location),
        "city": clean(city_of(location)),
        "state": clean(state_of(location)),
    }


def _insert_variants(rows: DataFrame, target: DataFrame, inserted_at, row_id: str, order: str) -> DataFrame:
    """Variant rows not stored yet; a variant of two originals comes from the first."""
    ref = normalize_key(F.col("_v.reference"))
    exploded = rows.select(*target.columns, F.posexplode("_variants").alias("_part", "_v"))
    exploded = exploded.withColumn("_ref", ref).filter(F.col("_ref") != "")
    stored = target.select(normalize_key("job_reference").alias("_ref")).filter(F.col("_ref") != "").distinct()
    fresh = exploded.join(stored, "_ref", "left_anti")
    fresh = first_per_key(fresh, "_ref", [order, "_part"], "drop")
    location = F.col("_v.location")
    new = {
        row_id: F.concat(F.col(row_id).cast("string"), F.lit("/"), F.col("_v.reference")),
        "job_reference": clean(F.col("_v.reference")),
        **_place_columns(location),
        "Title": clean("Title"),
        "zip": F.lit(None).cast("string"),
        "country": F.lit("USA"),
        "job_type": clean("job_type"),
        "company": clean("company"),
        "Isremote": (F.coalesce(F.col("Isremote"), F.lit(0)) == 1).cast("int"),
        "category": clean(normalize_category("category", "Title", "description")),
        "url": clean("url"),
        "description": clean("description"),
        "cpc": F.lit(0).cast("decimal(18,2)"),
        "inserteddate": F.lit(inserted_at).cast("timestamp"),
        "IsIT": F.coalesce(F.col("IsIT"), F.lit(False)),
        "ITScore": F.coalesce(F.col("ITScore"), F.lit(0)),
    }
    return fresh.select(*[new.get(c, F.col(c)).alias(c) for c in target.columns])


def _with_action(df: DataFrame, action: Column, to: Column) -> DataFrame:
    do = F.struct(action.alias("action"), to.alias("to"), F.col("_variants").alias("variants"))
    return fixed(df, "_do", do)


def _apply(target: DataFrame, acted: DataFrame, inserted_at, row_id: str, order: str) -> DataFrame:
    """``acted`` is the whole table with ``_do``: the action (keep, place, clear, expand), the
    new location and the variants."""
    action = F.col("_do.action")
    new = {}
    for c, value in _place_columns(F.col("_do.to")).items():
        new[c] = F.when(action == "place", value).otherwise(F.col(c))
    for c in ("city", "state"):
        new[c] = F.when(action == "clear", F.lit(None)).otherwise(new[c])
    stay = acted.filter(action != "expand").select(*[new.get(c, F.col(c)).alias(c) for c in target.columns])
    expanded = acted.filter(action == "expand").withColumn("_variants", F.col("_do.variants"))
    added = _insert_variants(expanded, target, inserted_at, row_id, order)
    return stay.unionByName(added)


def backfill_variants(target: DataFrame, inserted_at, row_id: str = "row_id", order: str = "row_order") -> DataFrame:
    """Expand stored multi-location rows.

    A suspect whose list has several places is replaced by its variants (those not
    stored yet are inserted).  One place, or no list but an over-long city, is
    corrected in place.  Without a reference the row stays: its variants would have
    no key.
    """
    listed = has_separator("_source")
    n = F.size("_variants")
    sourced = fixed(target, "_source", expansion_source("Location", "city"))
    action = (
        F.when(~is_multi_location(), "keep")
        .when(~listed, F.when(F.length("city") > 50, "place").otherwise("keep"))
        .when(n == 0, "keep")
        .when(n == 1, "place")
        .when(is_blank("job_reference"), "keep")
        .otherwise("expand")
    )
    to = F.when(listed, F.get("_variants", F.lit(0))["location"]).otherwise(F.col("_source"))
    acted = _with_action(with_variants(sourced, "_source", "job_reference"), action, to)
    return _apply(target, acted, inserted_at, row_id, order)


def cleanup_cities(target: DataFrame, inserted_at, row_id: str = "row_id", order: str = "row_order") -> DataFrame:
    """Rebuild unsafe cities.

    No usable place clears city and state, one corrects the row, several replace it by
    variants (not without a reference: such a row stays).
    """
    n = F.size("_variants")
    action = (
        F.when(~has_unsafe_city(), "keep")
        .when(n == 0, "clear")
        .when(n == 1, "place")
        .when(is_blank("job_reference"), "keep")
        .otherwise("expand")
    )
    listed = with_variants(target, cleanup_source("Location", "city"), "job_reference", "_all")
    safe = F.filter("_all", lambda v: safe_city(city_of(v["location"])))
    # only rows with an unsafe city need their places checked
    checked = fixed(listed, "_variants", F.when(has_unsafe_city(), safe).otherwise(F.col("_all")))
    acted = _with_action(checked, action, F.get("_variants", F.lit(0))["location"])
    return _apply(target, acted, inserted_at, row_id, order)


def category_changes(target: DataFrame) -> DataFrame:
    """Rows whose category the normaliser changes beyond case, with the new one as ``_new``."""
    given = target.filter(~is_blank("category"))
    return given.withColumn("_new", normalize_category("category", "Title", "description")).filter(~same("category", "_new"))


def backfill_categories(target: DataFrame, row_id: str = "row_id", order: str = "row_order") -> DataFrame:
    """Normalise categories, and pass each change to the rows with the same old category
    that share the reference, the URL or the title, company and location."""
    staged = category_changes(target).select(
        F.col(order),
        clean("_new").alias("_new"),
        normalize_key("category").alias("old"),
        "job_reference", "url", "Title", "company", "Location",
    )
    keys = ["job_reference", "url", "Title", "company", "Location"]
    normal = {k: normalize_key(k) for k in keys}
    staged = last_per_keys(
        staged.select(order, "_new", "old", *[v.alias(k) for k, v in normal.items()]), [*keys, "old"], [order]
    )
    source = key_entries(staged, [order, "_new", "old"], *keys)
    stored = key_entries(target.withColumn("old", normalize_key("category")), [row_id, "old"], *keys)
    winner = any_key_winner(stored, source, ["kind", "key", "old"], row_id, order, "_new")
    joined = target.join(winner.withColumnRenamed("_new", "u_category"), row_id, "left")
    return joined.select(
        *[
            (F.coalesce("u_category", "category") if c == "category" else F.col(c)).alias(c)
            for c in target.columns
        ]
    )
