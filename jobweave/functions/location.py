"""Locations: US test, city/state, joining, and splitting multi-location values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobweave import rules
from jobweave.functions.text import (
    blank_to_null,
    col,
    collapse_ws,
    contains_any,
    distinct_ignore_case,
    empty_to_null,
    filled_items,
    is_blank,
    join_filled,
    trim_ws,
)

_CITY_STATE = r"(?i)^\s*([^,]+),\s*(" + "|".join(rules.US_STATE_CODES + ["DC"]) + r")\b"


def is_us(location, include_remote_word: bool = False) -> Column:
    """Names the US, a state code after a comma, or a large US city.

    ``include_remote_word`` also accepts the word remote (one board's own test).
    """
    value = F.coalesce(col(location), F.lit(""))
    words = rules.US_WORDS + rules.US_CITIES + (["remote"] if include_remote_word else [])
    return contains_any(value, words) | value.rlike(rules.US_STATE_PATTERN)


def geo_allowed(geo, words: list[str]) -> Column:
    """Blank, or holds one of the accepted region words."""
    value = F.coalesce(col(geo), F.lit(""))
    return (value == "") | contains_any(value, words)


def city_of(location) -> Column:
    value = F.coalesce(col(location), F.lit(""))
    return blank_to_null(F.regexp_extract(value, _CITY_STATE, 1))


def state_of(location) -> Column:
    value = F.coalesce(col(location), F.lit(""))
    return empty_to_null(F.upper(F.regexp_extract(value, _CITY_STATE, 2)))


def country_name(country, aliases=("us", "usa")) -> Column:
    value = col(country)
    return F.when(F.lower(value).isin(*aliases), F.lit("United States")).otherwise(value)


def place(*parts, separator: str = ", ") -> Column:
    return join_filled(separator, *parts)


def join_places(values, separator: str) -> Column:
    """Filled, distinct (ignoring case) places joined."""
    return F.array_join(distinct_ignore_case(filled_items(values)), separator)


def or_remote(location, remote) -> Column:
    """'Remote' for a blank location of a remote posting."""
    return F.when(is_blank(location) & remote, F.lit("Remote")).otherwise(col(location))


def city_state_in_text(c) -> Column:
    """First 'City, ST' in running text."""
    return collapse_ws(F.regexp_extract(F.coalesce(col(c), F.lit("")), rules.CITY_STATE_PATTERN, 1))


def location_in_title(c) -> Column:
    """Trailing '(…)' of a title when it looks like a place."""
    pattern = r"(?i)\(([^)]*(?:remote|united states|usa|[A-Z]{2})[^)]*)\)$"
    return collapse_ws(F.regexp_extract(F.coalesce(col(c), F.lit("")), pattern, 1))


def location_label(c) -> Column:
    """Text after 'Location' in a feed description; NULL when absent."""
    value = F.regexp_extract(col(c), r"(?i)Location[^A-Za-z0-9]*([A-Za-z0-9 ,.\-/]+)", 1)
    return empty_to_null(F.rtrim(trim_ws(value), F.lit(".,")))


def location_parts(location) -> Column:
    """Places of a ';' or '|' list: trimmed, filled, distinct ignoring case."""
    parts = F.transform(F.split(F.coalesce(col(location), F.lit("")), r"[;|]"), trim_ws)
    return distinct_ignore_case(F.filter(parts, lambda p: p != ""))


def has_separator(c) -> Column:
    return F.coalesce(col(c), F.lit("")).rlike("[;|]")


def variant_codes(parts) -> Column:
    """Code of 32 hex digits per place, the same for the same place whatever its case."""
    return F.transform(col(parts), lambda p: F.left(F.sha2(F.lower(p).cast("binary"), 256), F.lit(32)))


def safe_city(city) -> Column:
    """Blank, or at most 50 characters without a list separator."""
    value = F.coalesce(col(city), F.lit(""))
    return is_blank(value) | ((F.length(value) <= 50) & ~value.rlike("[;|]"))


def expansion_source(location, city) -> Column:
    """Which column holds the location list of a suspect row."""
    c = F.coalesce(col(city), F.lit(""))
    in_location = F.contains(F.coalesce(col(location), F.lit("")), F.lit(";"))
    return F.when(~in_location & c.rlike("[;|]"), col(city)).otherwise(col(location))


def cleanup_source(location, city) -> Column:
    """Which column to rebuild an unsafe city from."""
    value = F.coalesce(col(location), F.lit(""))
    usable = ~is_blank(value) & (value.rlike("[;|]") | (F.length(value) > 50))
    return F.when(usable, col(location)).when(is_blank(city), col(location)).otherwise(col(city))
