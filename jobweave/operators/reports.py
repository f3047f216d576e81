"""Counts and summaries; each is one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave.functions.text import is_blank, normalize_key, trim_ws


def _percent(part: Column, total: Column) -> Column:
    # half-to-even on two decimals
    return F.when(total == 0, F.lit(0.0)).otherwise(F.bround(F.lit(100.0) * part / total, 2))


def coverage(df: DataFrame, columns: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """Per report field: total, populated, missing and percentage populated.

    ``columns`` maps a report name to its column; text counts as populated when it is
    not blank, other types when not NULL.
    """
    types = dict(df.dtypes)
    filled = lambda c: ~is_blank(c) if types[c] == "string" else F.col(c).isNotNull()
    keys = by or []
    wide = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(filled(c)).alias(f"n_{name}") for name, c in columns.items()],
    )
    fields = F.array(
        *[F.struct(F.lit(n).alias("field"), F.col(f"n_{n}").alias("populated")) for n in columns]
    )
    return wide.select(*keys, "total", F.explode(fields).alias("f")).select(
        *keys, F.col("f.field").alias("field"), "total", F.col("f.populated").alias("populated"),
        (F.col("total") - F.col("f.populated")).alias("missing"),
        _percent(F.col("f.populated"), F.col("total")).alias("pct"),
    )


def top_values(df: DataFrame, column: str, order: str, limit: int = 5, label: str = "label") -> DataFrame:
    """Most frequent values, trimmed and ignoring case, shown in their first spelling."""
    value = trim_ws(column)
    return (
        df.filter(~is_blank(column))
        .groupBy(F.lower(value).alias("_key"))
        .agg(F.count(F.lit(1)).alias("n"), F.min_by(value, order).alias(label))
        .orderBy(F.desc("n"), F.asc(label))
        .limit(limit)
        .select(label, "n")
    )


def class_counts(df: DataFrame, flag: str = "is_it") -> DataFrame:
    return df.groupBy(flag).agg(F.count(F.lit(1)).alias("n"))


def discovery_summary(df: DataFrame) -> DataFrame:
    true = lambda c: F.count_if(F.lower(c) == "true")
    return df.agg(
        F.count(F.lit(1)).alias("sites"),
        F.coalesce(F.sum(F.coalesce(F.col("total_jobs").try_cast("int"), F.lit(0))), F.lit(0)).alias("total_jobs"),
        true("sample_still_available").alias("live"),
        true("known_from_jobsites").alias("known"),
    )


def export_summary(df: DataFrame) -> DataFrame:
    true = lambda c: F.count_if(F.lower(c) == "true")
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        true("still_available").alias("live"),
        F.count_if(F.col("description_length").try_cast("int") > 0).alias("described"),
        true("is_us").alias("us"),
        true("is_remote").alias("remote"),
        true("is_it").alias("it"),
    )


def over_limit(df: DataFrame, column: str = "category", limit: int = 30) -> DataFrame:
    """Rows whose value is longer than ``limit`` (trailing spaces not counted)."""
    return df.agg(F.count_if(F.length(F.rtrim(column)) > limit).alias("over_limit"))


def site_summary(listed: DataFrame, kept: DataFrame, site: str) -> DataFrame:
    """Per site: postings listed, kept, and kept with a description."""
    all_ = listed.groupBy(site).agg(F.count(F.lit(1)).alias("listed"))
    jobs = kept.groupBy(site).agg(
        F.count(F.lit(1)).alias("jobs"), F.count_if(~is_blank("description")).alias("described")
    )
    return all_.join(jobs, site, "left").select(
        site, "listed", F.coalesce("jobs", F.lit(0)).alias("jobs"),
        F.coalesce("described", F.lit(0)).alias("described"),
    )


def variant_complete(variants: DataFrame, existing: DataFrame, original: str = "original") -> DataFrame:
    """Per original row: variants, how many exist already, and whether none failed.

    A variant without a reference fails.
    """
    refs = existing.select(normalize_key("job_reference").alias("_ref")).distinct()
    ref = normalize_key("reference")
    joined = variants.withColumn("_ref", ref).join(
        refs.filter(F.col("_ref") != "").withColumn("_there", F.lit(True)), "_ref", "left"
    )
    return joined.groupBy(original).agg(
        F.count(F.lit(1)).alias("variants"),
        F.count_if(F.col("_there")).alias("existing"),
        F.count_if(F.col("_there").isNull() & (F.col("_ref") != "")).alias("inserted"),
        (F.count_if(F.col("_ref") == "") == 0).alias("complete"),
    )
