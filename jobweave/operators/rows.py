"""Row-level helpers for building plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fixed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    A plain column used several times, or by a filter, may be copied into each use by the
    optimizer; for costly expressions that multiplies the work and can grow the generated
    code past its limit.  One-element generation keeps it a value.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def settled(df: DataFrame, *names: str) -> DataFrame:
    """Columns of ``df`` made values, as by ``fixed``, before filters use them."""
    values = F.inline(F.array(F.struct(*[F.col(n) for n in names])))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in names], values)
