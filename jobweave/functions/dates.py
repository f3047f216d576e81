"""Dates: permissive parsing, relative phrases, epoch numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobweave.functions.text import col, let, trim_ws

# (shape of the text, Spark pattern); the weekday and zone names are cut before.
_FORMATS = [
    (r"^\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{2}:\d{2} [+-]\d{4}$", "d MMM yyyy H:mm:ss Z"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{2}:\d{2}$", "d MMM yyyy H:mm:ss"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", "d MMMM yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{4,9} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
    (r"(?i)^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} [AP]M$", "M/d/yyyy h:mm:ss a"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
]
# how every readable date begins, ISO or written, with or without a weekday; other texts are
# not tried further
_BEGINS = r"^(?:[A-Za-z]{3,9},\s+)?(?:\d{4}[-/]|\d{1,2}/\d|\d{1,2} [A-Za-z]{3}|[A-Za-z]{3,9} \d{1,2}, \d)"


def parse_date(c) -> Column:
    """Timestamp of an ISO, RFC 1123, US or written-out date; NULL when unreadable.

    Times without a zone are taken in the session zone (UTC).
    """

    def read(text: Column) -> Column:
        iso = F.regexp_replace(text, r"(?i)\s+UTC$", "Z")
        found = F.coalesce(
            F.when(iso.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), iso.try_cast("timestamp")), let(_named(text), _written)
        )
        return F.when(text.rlike(_BEGINS), found)

    return let(trim_ws(c), read)


def _named(text: Column) -> Column:
    """The text without weekday, its zone name as an offset."""
    return F.regexp_replace(
        F.regexp_replace(text, r"^[A-Za-z]{3,9},\s+", ""), r"(?i)\s+(GMT|UTC|Z)$", " +0000"
    )


def _written(text: Column) -> Column:
    read = F.coalesce(
        *[F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(fmt))) for shape, fmt in _FORMATS]
    )
    return F.when(text.rlike(r"\d{4}"), read)  # every shape holds a year


def relative_date(c, as_of) -> Column:
    """'Posted Today', 'Yesterday', 'Posted 3+ Days Ago', or a date; ``as_of`` is today."""
    today = (F.lit(as_of) if not isinstance(as_of, Column) else as_of).cast("date")

    def read(text: Column) -> Column:
        days = F.regexp_extract(text, r"(?i)Posted\s+(\d+)\+?\s+Days?\s+Ago", 1).try_cast("int")
        lowered = F.lower(text)
        return (
            F.when(lowered.isin("posted today", "today"), today.cast("timestamp"))
            .when(lowered.isin("posted yesterday", "yesterday"), F.date_sub(today, 1).cast("timestamp"))
            .when(days.isNotNull(), F.date_sub(today, days).cast("timestamp"))
            .otherwise(parse_date(text))
        )

    return let(trim_ws(c), read)


def from_epoch_seconds(c) -> Column:
    return F.timestamp_seconds(col(c).try_cast("bigint"))


def from_epoch_millis(c) -> Column:
    return F.timestamp_millis(col(c).try_cast("bigint"))
