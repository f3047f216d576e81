"""Posting keys in long form, and joins that accept a match on any key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobweave.functions.text import fingerprint, normalize_key

REF, URL, TEXT = "ref", "url", "text"


def key_entries(df: DataFrame, carry: Sequence[str], ref, url, title=None, company=None,
                location=None, url_needs_no_ref: bool = False) -> DataFrame:
    """One row per filled key of each row: ``carry`` columns, ``kind``, ``key``.

    With ``url_needs_no_ref`` the URL counts only when the reference is blank.  Blank
    keys produce no row, so they never meet in one partition.
    """
    # keys are columns first, so that each is made once however often it is tested
    made = {"_ref": normalize_key(ref), "_url": normalize_key(url)}
    if title is not None:
        made["_text"] = fingerprint(title, company, location)
    rows = df.select(*carry, *[v.alias(k) for k, v in made.items()])
    url_key = F.when(F.col("_ref") == "", F.col("_url")).otherwise("") if url_needs_no_ref else F.col("_url")
    entries = [F.lit(REF), F.col("_ref"), F.lit(URL), url_key]
    if title is not None:
        entries += [F.lit(TEXT), F.col("_text")]
    long = rows.select(*carry, F.stack(F.lit(len(entries) // 2), *entries).alias("kind", "key"))
    return long.filter(F.col("key") != "")


def existing_keys(target: DataFrame, ref="job_reference", url="url", title="Title",
                  company="company", location="Location") -> DataFrame:
    """Distinct (kind, key) of the stored table.

    The distinct is combined map-side, so a key shared by many stored rows reaches
    the join once.
    """
    return key_entries(target, [], ref, url, title, company, location).distinct()


def key_sizes(target: DataFrame, **columns) -> DataFrame:
    """Number of distinct references, URLs and fingerprints."""
    keys = existing_keys(target, **columns)
    return keys.agg(
        F.count_if(F.col("kind") == REF).alias("references"),
        F.count_if(F.col("kind") == URL).alias("urls"),
        F.count_if(F.col("kind") == TEXT).alias("fingerprints"),
    )


def spread_blank(key: Column, *row_key) -> Column:
    """The key, or a filler unique to the row when it is blank.

    Rows without a key then spread over all partitions of an outer join or window
    instead of sharing one.
    """
    filler = F.concat_ws("\x01", F.lit("\x00"), *[F.col(c).cast("string") for c in row_key])
    return F.when(F.coalesce(key, F.lit("")) == "", filler).otherwise(key)


def any_key_winner(target_keys: DataFrame, source_keys: DataFrame, on: Sequence[str],
                   row: str, order: str, value: str) -> DataFrame:
    """For each target ``row``, the ``value`` of the matching source row with the highest
    ``order``, where one matching key in ``on`` is enough.

    An OR of equalities would be a nested-loop join; here every key is its own row
    and one equi-join serves all.  Both sides are reduced to one row per key first.
    """
    best = source_keys.groupBy(*on).agg(
        F.max_by(value, order).alias(value), F.max(order).alias(order)
    )
    hits = target_keys.join(best, list(on), "inner")
    return hits.groupBy(row).agg(F.max_by(value, order).alias(value))
