"""Top-k, limits, skipping, and row numbers that do not pass through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobweave import rules
from jobweave.functions.classify import tenant_priority
from jobweave.functions.text import first_non_empty
from jobweave.functions.url import domain_from_url
from jobweave.operators.dedupe import cap_per_group, first_per_key


def site_count(*columns: str) -> Column:
    """First of the count columns that holds an integer, else 0."""
    return F.coalesce(*[F.col(c).try_cast("int") for c in columns], F.lit(0))


def top_sites(df: DataFrame, limit: int, tie: str, count_columns: Sequence[str] = ()) -> DataFrame:
    """The sites with the most jobs, earlier rows first among equals."""
    columns = [c for c in (count_columns or rules.SITE_COUNT_COLUMNS) if c in df.columns]
    return df.withColumn("_n", site_count(*columns)).orderBy(F.desc("_n"), F.asc(tie)).limit(limit).drop("_n")


def rank_sites(df: DataFrame, tie: str, domain="domain", url: str | None = None) -> DataFrame:
    """Sites with their tenant score and job count, in visiting order."""
    host = first_non_empty(domain, domain_from_url(url)) if url else F.col(domain)
    columns = [c for c in rules.SITE_COUNT_COLUMNS if c in df.columns]
    return df.withColumn("priority", tenant_priority(host)).withColumn(
        "jobs", site_count(*columns)
    ).orderBy(F.desc("priority"), F.desc("jobs"), F.asc(tie))


def cap_per_site(df: DataFrame, site: str, order: str, keep: int) -> DataFrame:
    return cap_per_group(df, [site], [order], keep)


def take_first(df: DataFrame, limit: int, *order: str) -> DataFrame:
    """First rows in arrival order (an insert or refresh limit)."""
    return df.orderBy(*order).limit(limit)


def company_rows(df: DataFrame, order: str, skip: int = 0, take: int | None = None) -> DataFrame:
    """Companies of a catalogue: identifier from the first filled of three columns, first
    row per identifier, then a window of the list."""
    identifier = first_non_empty(*[c for c in ("identifier", "tenant", "company") if c in df.columns])
    company = first_non_empty("company", "identifier") if "company" in df.columns else F.col("identifier")
    rows = df.withColumn("identifier", identifier).filter(F.col("identifier") != "")
    rows = first_per_key(rows.withColumn("company", company), "identifier", [order], "drop")
    rows = rows.select("identifier", "company", order)
    if skip:  # what is skipped is a bounded list of slim rows; what stays is filtered where it is
        last = rows.select(F.col(order).alias("_at")).orderBy("_at").limit(skip).agg(F.max("_at").alias("_last"), F.count("*").alias("_n"))
        rows = rows.join(F.broadcast(last), (F.col(order) > F.col("_last")) & (F.col("_n") == skip)).drop("_last", "_n")
    return rows.orderBy(order) if take is None else rows.orderBy(order).limit(take)


def class_samples(df: DataFrame, flag: str, order: str, keep: int = 3) -> DataFrame:
    return cap_per_group(df, [flag], [order], keep)


def number_rows(df: DataFrame, order: Column, block: Column, name: str, start: int = 1) -> DataFrame:
    """Consecutive numbers in ``order``, without sorting everything in one task.

    ``block`` must rise with ``order`` and keep each block small enough for a task.
    Rows are numbered inside their block; the block's first number comes from the
    block counts, a table with one row per block.
    """
    blocked = df.withColumn("_block", block).withColumn("_order", order)
    counts = blocked.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = blocked.withColumn(
        "_rn", F.row_number().over(Window.partitionBy("_block").orderBy("_order"))
    )
    return inside.join(offsets, "_block").withColumn(
        name, F.col("_before") + F.col("_rn") + (start - 1)
    ).drop("_block", "_order", "_n", "_before", "_rn")
