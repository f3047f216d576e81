"""Merging postings that are one job listed several times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave import rules
from jobweave.functions.text import is_blank, normalize_key
from jobweave.operators.keys import spread_blank


def _length(c: str) -> Column:
    return F.length(F.coalesce(F.col(c), F.lit("")))


def _specific(c: Column) -> Column:
    return ~normalize_key(c).isin(*rules.US_COUNTRY_NAMES)


def merge_postings(df: DataFrame, order: str = "seq", url="job_url", ref="external_id",
                   scope: tuple[str, ...] = ()) -> DataFrame:
    """One row per posting URL (else per id; rows with neither stay alone).

    The row with the longest location, then the longest description, gives the
    fields.  Its location becomes the distinct places of the group joined with '; '
    (country-only places only when there is nothing better), remote is true when any
    row is, and the description is the group's longest.

    Both steps are aggregates with map-side combine: a large group is reduced in every
    map task, and its places are made distinct before they are collected.
    """
    main = F.when(~is_blank(url), F.concat(F.lit("u:"), normalize_key(url))).when(
        ~is_blank(ref), F.concat(F.lit("i:"), normalize_key(ref))
    )
    keyed = df.withColumn("_key", spread_blank(main, order))
    keys = [*scope, "_key"]
    first = F.negative(F.col(order))
    picked = keyed.groupBy(*keys).agg(
        F.max_by(
            F.struct(*df.columns), F.struct(_length("location"), _length("description"), first)
        ).alias("best"),
        F.coalesce(F.bool_or("is_remote"), F.lit(False)).alias("any_remote"),
        F.max_by(
            "description",
            F.when(~is_blank("description"), F.struct(_length("description"), first)),
        ).alias("longest"),
    )
    places = (
        keyed.filter(~is_blank("location"))
        .groupBy(*keys, F.lower("location").alias("_place"))
        .agg(F.min(order).alias("at"), F.min_by("location", order).alias("place"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("at", "place"))).alias("seen"))
    )
    every = F.transform("seen", lambda s: s["place"])
    specific = F.filter(every, _specific)
    location = F.array_join(F.when(F.size(specific) > 0, specific).otherwise(every), "; ")
    replaced = {
        "location": F.coalesce(location, F.lit("")),
        "is_remote": F.col("any_remote"),
        "description": F.coalesce("longest", "best.description"),
    }
    return picked.join(places, keys, "left").select(
        *[replaced.get(c, F.col(f"best.{c}")).alias(c) for c in df.columns]
    )
