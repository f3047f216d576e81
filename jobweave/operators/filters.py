"""Row filters and scans of the stored table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from jobweave import rules
from jobweave.functions.classify import is_it
from jobweave.functions.location import is_us
from jobweave.functions.text import contains_any, is_blank, normalize_key, same


def us_or_remote(df: DataFrame, include_remote: bool, location="location", remote="is_remote") -> DataFrame:
    """US postings, and remote ones where the source's flag allows."""
    keep = is_us(location)
    if include_remote:
        keep = keep | F.coalesce(F.col(remote), F.lit(False))
    return df.filter(keep)


def validated_sites(df: DataFrame) -> DataFrame:
    return df.filter((F.lower("validated") == "true") & ~is_blank("api_url"))


def with_required(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose listed columns are all filled."""
    return df.filter(reduce(lambda a, b: a & b, [~is_blank(c) for c in columns]))


def listed_only(df: DataFrame, flag="isListed") -> DataFrame:
    """Rows not explicitly unlisted (a missing flag counts as listed)."""
    return df.filter(F.coalesce(F.col(flag), F.lit(True)))


def it_only(df: DataFrame, title="title", category="category") -> DataFrame:
    return df.filter(is_it(title, category))


def login_wall(url, html) -> Column:
    """The page asks for a sign-in instead of showing jobs."""
    return contains_any(url, rules.LOGIN_WALL_URL) | contains_any(html, rules.LOGIN_WALL_HTML)


def missing_flags(df: DataFrame) -> DataFrame:
    return df.filter(F.col("IsIT").isNull() | F.col("ITScore").isNull())


def _length_no_trailing(c: str) -> Column:
    return F.length(F.rtrim(F.coalesce(F.col(c), F.lit(""))))


def is_multi_location() -> Column:
    """Stored row that looks like several places in one; variants are excluded."""
    location, city = F.col("Location"), F.col("city")
    suspect = (
        F.coalesce(F.contains(location, F.lit(";")), F.lit(False))
        | F.coalesce(location.rlike("(?i)US/[A-Z][A-Z]/"), F.lit(False))
        | F.coalesce(city.rlike("[;|]"), F.lit(False))
        | (_length_no_trailing("city") > 50)
    )
    variant = normalize_key("job_reference").rlike(rules.VARIANT_REFERENCE)
    return suspect & F.col("job_reference").isNotNull() & ~variant


def multi_location_suspects(df: DataFrame) -> DataFrame:
    return df.filter(is_multi_location())


def has_unsafe_city() -> Column:
    city = F.coalesce(F.col("city"), F.lit(""))
    return city.rlike("[;|]") | (_length_no_trailing("city") > 50) | city.rlike("(?i)^US Remote")


def unsafe_city(df: DataFrame) -> DataFrame:
    return df.filter(has_unsafe_city())


def changed_only(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Rows where any (old, new) pair differs beyond case and outer white space."""
    return df.filter(reduce(lambda a, b: a | b, [~same(a, b) for a, b in pairs]))


def pick_company(df: DataFrame, wanted: str, *columns: str) -> DataFrame:
    """Rows whose slug or company equals ``wanted``, ignoring case."""
    return df.filter(reduce(lambda a, b: a | b, [F.lower(c) == wanted.lower() for c in columns]))


def scan_nonblank(df: DataFrame, *columns: str) -> DataFrame:
    """Projection of ``columns`` where at least one of them is filled."""
    return df.filter(reduce(lambda a, b: a | b, [~is_blank(c) for c in columns])).select(*columns)
