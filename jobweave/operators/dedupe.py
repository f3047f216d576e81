"""First-wins de-duplication: per key, inside a batch, and against the stored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobweave.functions.text import blank_to_null, fingerprint, normalize_key
from jobweave.operators.key_index import KeyIndex
from jobweave.operators.keys import existing_keys, key_entries, spread_blank
from jobweave.operators.rows import fixed

EXISTING, BATCH_DUPLICATE, NEW = "existing", "batch_duplicate", "new"


def _ranked(df: DataFrame, partition: Sequence[Column], order: Sequence[Column], keep: int = 1) -> DataFrame:
    window = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= keep).drop("_rn")


def first_per_key(df: DataFrame, key, order: Sequence[str], keyless: str = "keep") -> DataFrame:
    """First row per key (ignoring case and outer white space) in ``order``.

    ``keyless`` rows are all kept ("keep") or all dropped ("drop").  Spark limits each
    map task to one row per key before the shuffle, so a hot key stays small.
    """
    df, k = fixed(df, "_key", normalize_key(key)), F.col("_key")
    if keyless == "drop":
        return _ranked(df.filter(k != ""), [k], [F.col(c).asc() for c in order]).drop("_key")
    return _ranked(df, [spread_blank(k, *order)], [F.col(c).asc() for c in order]).drop("_key")


def last_per_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row (highest ``order``) per combination of ``keys``."""
    return _ranked(df, [F.col(k) for k in keys], [F.col(c).desc() for c in order])


def cap_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], keep: int) -> DataFrame:
    """At most ``keep`` rows per group, in order."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    return _ranked(df, [F.col(g) for g in group], columns, keep)


# Key ladders of the sources: which value identifies a posting inside one source.
def source_key(ladder: str, url="job_url", ref="external_id", title="title", company="company",
               location="location") -> Column:
    u, r = blank_to_null(url), blank_to_null(ref)
    text = lambda *cs: F.concat_ws("|", *[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cs])
    if ladder == "url_first":
        return F.coalesce(u, r, text(title, company, location))
    if ladder == "id_first":
        return F.coalesce(r, u, text(company, title, location))
    if ladder == "id_or_drop":
        return F.coalesce(r, u)
    raise ValueError(ladder)


def dedupe_source(df: DataFrame, ladder: str, order: Sequence[str] = ("seq",)) -> DataFrame:
    """The per-source de-duplication."""
    return first_per_key(df, source_key(ladder), order, "drop" if ladder == "id_or_drop" else "keep")


def _slim(df: DataFrame, row_key: Sequence[str], ref, url, title, company, location) -> DataFrame:
    made = df.select(*row_key, normalize_key(ref).alias("_r"), normalize_key(url).alias("_u"), fingerprint(title, company, location).alias("_text"))
    by_ref = F.when(F.col("_r") != "", F.concat(F.lit("r:"), "_r")).when(F.col("_u") != "", F.concat(F.lit("u:"), "_u"))
    return made.select(*row_key, F.coalesce(by_ref, F.lit("")).alias("_main"), "_text")


def _batch_first(slim: DataFrame, row_key: Sequence[str]) -> DataFrame:
    order = [F.col(c).asc() for c in row_key]
    stage1 = _ranked(slim, [spread_blank(F.col("_main"), *row_key)], order)
    return _ranked(stage1, [spread_blank(F.col("_text"), *row_key)], order)


def batch_dedupe(df: DataFrame, row_key: Sequence[str] = ("seq",), ref="external_id", url="job_url",
                 title="title", company="company", location="location") -> DataFrame:
    """Rows a first-wins pass over the batch keeps.

    Stage 1 keeps the first row per reference (or per URL where the reference is
    blank); stage 2 keeps, among those, the first row per fingerprint.  Only keys move
    through the two windows; the full rows are picked by row key afterwards.
    """
    kept = _batch_first(_slim(df, row_key, ref, url, title, company, location), row_key)
    return df.join(kept.select(*row_key), list(row_key), "left_semi")


def batch_status(incoming: DataFrame, target: DataFrame | KeyIndex, row_key: Sequence[str] = ("seq",),
                 ref="external_id", url="job_url", title="title", company="company",
                 location="location", target_columns: dict | None = None) -> DataFrame:
    """Row key and ``status`` of every incoming row: existing, batch_duplicate or new.

    A row exists when its reference (else its URL) or its fingerprint is stored.  ``target`` is
    the stored table, or a ``KeyIndex`` of it.
    """
    probe = key_entries(incoming, list(row_key), ref, url, title, company, location, url_needs_no_ref=True)
    if isinstance(target, KeyIndex):
        hits = target.known(probe, *row_key)
    else:
        keys = existing_keys(target, **(target_columns or {}))
        hits = probe.join(keys, ["kind", "key"], "left_semi").select(*row_key).distinct()
    slim = _slim(incoming, row_key, ref, url, title, company, location).join(
        hits.withColumn("_hit", F.lit(True)), list(row_key), "left"
    )
    kept = _batch_first(slim.filter(F.col("_hit").isNull()), row_key)
    return slim.join(
        kept.select(*row_key, F.lit(True).alias("_kept")), list(row_key), "left"
    ).select(
        *row_key,
        F.when(F.col("_hit"), EXISTING).when(F.col("_kept"), NEW).otherwise(BATCH_DUPLICATE).alias("status"),
    )


def split_batch(incoming: DataFrame, target: DataFrame, row_key: Sequence[str] = ("seq",),
                **columns) -> DataFrame:
    """Incoming rows with their ``status``; the wide rows move once."""
    return incoming.join(batch_status(incoming, target, row_key, **columns), list(row_key))


def status_counts(status: DataFrame) -> DataFrame:
    """Rows per status."""
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
