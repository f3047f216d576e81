"""Expanding multi-location postings into one row per place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobweave.functions.location import location_parts, variant_codes
from jobweave.functions.text import is_blank, let, zipped
from jobweave.operators.rows import fixed


def with_variants(df: DataFrame, location, reference: str, name: str = "_variants") -> DataFrame:
    """Add an array of (location, reference) for the places of a list.

    One place keeps the reference; several get ':L' and a four-character code.  A
    blank reference stays blank.
    """
    ref, places = F.col(reference), F.col("_places")
    scoped = F.transform(
        zipped(places, variant_codes("_places"), ("p", "c")),
        lambda z: F.named_struct(F.lit("location"), z["p"], F.lit("reference"), F.concat(ref, F.lit(":L"), z["c"])),
    )
    same_ref = F.transform(places, lambda p: F.named_struct(F.lit("location"), p, F.lit("reference"), ref))
    return (
        fixed(df, "_places", location_parts(location))
        .withColumn(name, F.when((F.size("_places") <= 1) | is_blank(ref), same_ref).otherwise(scoped))
        .drop("_places")
    )


def expand_locations(df: DataFrame, location="location", reference="external_id") -> DataFrame:
    """One row per place, numbered by ``part``; a row without places stays as it is."""
    keep = F.array(F.struct(F.col(location).alias("location"), F.col(reference).alias("reference")))
    rows = with_variants(df, location, reference).select(
        *[F.col(c) for c in df.columns if c != "part"],
        F.posexplode(let(F.col("_variants"), lambda v: F.when(F.size(v) > 0, v).otherwise(keep))).alias("_part", "_v"),
    )
    out = {location: F.col("_v.location"), reference: F.col("_v.reference"), "part": F.col("_part")}
    columns = df.columns if "part" in df.columns else [*df.columns, "part"]
    return rows.select(*[out.get(c, F.col(c)).alias(c) for c in columns])


def expansion_counts(before: DataFrame, after: DataFrame, row: str = "seq") -> DataFrame:
    """Postings that became several rows, and rows added."""
    per = after.groupBy(row).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.count_if(F.col("n") > 1).alias("expanded_postings"),
        F.sum(F.col("n") - 1).alias("added_rows"),
    )
