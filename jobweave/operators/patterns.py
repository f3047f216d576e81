"""Wildcard URL patterns held against URLs by a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave.functions.text import col


def _bare(url) -> Column:
    """A URL without its scheme, in lower case."""
    return F.lower(F.regexp_replace(F.coalesce(col(url), F.lit("")), "(?i)^https?://", ""))


def _halves(bare: Column) -> tuple[Column, Column]:
    """Host with port, and everything after it."""
    host = F.regexp_extract(bare, "^[^/?#]*", 0)
    return host, F.substr(bare, F.length(host) + 1)


def _like(glob: Column) -> Column:
    """A wildcard pattern as a LIKE pattern: only '*' is special."""
    escaped = F.regexp_replace(glob, r"([\\%_])", r"\\$1")
    return F.replace(escaped, F.lit("*"), F.lit("%"))


def keyed_patterns(patterns: DataFrame, pattern: str = "pattern") -> DataFrame:
    """``patterns`` and ``_suffix``, the labels that every host of the pattern ends in, '' if none."""
    host, rest = _halves(_bare(F.col(pattern)))
    tail = F.regexp_extract(host, r"[^*]*$", 0)
    # after a wildcard, the first label may be the end of a longer one
    whole = F.when(F.contains(host, F.lit("*")), F.regexp_extract(tail, r"\.(.*)$", 1)).otherwise(tail)
    return patterns.withColumns({"_suffix": whole, "_host_like": _like(host), "_rest_like": _like(rest)})


def pattern_matches(df: DataFrame, url: str, patterns: DataFrame, pattern: str = "pattern") -> DataFrame:
    """A row for each row of ``df`` and each pattern its URL matches, with the columns of both.

    '*' stands for any text, within the host or after it as it is written; letter case and the
    scheme don't count.  Patterns meet URLs by an equi-join on the labels a host ends in, so that
    thousands of patterns cost a URL no more than those that share its domain.  Null and blank
    patterns match nothing.
    """
    filled = patterns.filter(F.trim(F.coalesce(F.col(pattern), F.lit(""))) != "").withColumn("_p", F.trim(F.col(pattern)))
    right = keyed_patterns(filled, "_p").drop("_p")
    host, rest = _halves(F.col("_bare"))
    rows = df.withColumn("_bare", _bare(url)).withColumns({"_host": host, "_rest": rest})
    labels = F.split("_host", r"\.")
    suffixes = F.concat(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")), F.array(F.lit("")))
    keyed = rows.withColumn("_suffix", F.explode(F.array_distinct(suffixes)))
    hits = keyed.join(right, "_suffix").filter(F.expr("_host LIKE _host_like AND _rest LIKE _rest_like"))
    return hits.drop("_suffix", "_bare", "_host", "_rest", "_host_like", "_rest_like")
