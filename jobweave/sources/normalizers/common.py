"""Steps the normalisers share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave import rules
from jobweave.functions.html import job_postings
from jobweave.functions.location import is_us
from jobweave.operators.dedupe import cap_per_group, dedupe_source
from jobweave.operators.rows import fixed, settled  # noqa: F401  (fixed: used by the normalisers)
from jobweave.schema import JOBS_STD, conform
from jobweave.sources.payloads import succeeded

CONTEXT = ["payload_seq", "tenant", "site", "domain", "company_name"]

# Arrival order in one number of 38 digits: source rank, payload (any long) and position in the
# payload (any int), each in digits of its own, so that no two items share a number.
_POSITION_DIGITS, _PAYLOAD_DIGITS = 10, 19


def _digits(n: int) -> Column:
    return F.lit(f"1{'0' * n}").cast("decimal(38,0)")


def arrival(source: rules.Source, payload_seq, position) -> Column:
    whole = lambda c: c.cast("decimal(38,0)")
    payload = F.lit(source.rank).cast("decimal(8,0)") * _digits(_PAYLOAD_DIGITS).cast("decimal(20,0)") + F.col(payload_seq).cast("decimal(19,0)")
    return whole(payload.cast("decimal(27,0)") * _digits(_POSITION_DIGITS).cast("decimal(11,0)") + F.col(position).cast("decimal(10,0)"))


def payload_of(seq) -> Column:
    """The payload number inside an arrival number."""
    inner = (F.col(seq) % _digits(_POSITION_DIGITS + _PAYLOAD_DIGITS)).cast("decimal(29,0)")
    return F.floor(inner / _digits(_POSITION_DIGITS).cast("decimal(11,0)")).cast("bigint")


def context(payloads: DataFrame) -> DataFrame:
    return succeeded(payloads).withColumnRenamed("company", "company_name")


def items(payloads: DataFrame, array: Column, *extra: Column) -> DataFrame:
    """One row per list item: the payload's context, ``extra``, ``pos`` and ``j``."""
    return context(payloads).select(*CONTEXT, *extra, F.posexplode(array).alias("pos", "j"))


def json_list(payloads: DataFrame, item: str, *path: str) -> DataFrame:
    """Items of a JSON list at the root or under ``path``."""
    schema = f"array<{item}>"
    for name in reversed(path):
        schema = f"struct<{name}:{schema}>"
    body = F.col("body")
    root_ok = F.startswith(F.ltrim(body), F.lit("[" if not path else "{"))
    parsed = F.from_json(F.when(root_ok, body), schema)
    for name in path:
        parsed = parsed[name]
    return items(payloads, parsed)


def with_posting(df: DataFrame, html: str, use_graph: bool = True) -> DataFrame:
    """Add ``p``, the first JSON-LD posting of a page, or NULL."""
    first = F.slice(job_postings(html, use_graph), 1, 1)
    return df.select("*", F.explode_outer(first).alias("p"))


def us_or_remote(df: DataFrame, *filled: str) -> DataFrame:
    """US or remote postings whose ``filled`` columns are not ''.

    The tested columns are made values first: below the filter their expressions would be
    computed once for each place the test uses them.
    """
    kept = is_us("location") | F.coalesce(F.col("is_remote"), F.lit(False))
    for name in filled:
        kept = (F.col(name) != "") & kept
    return settled(df, "location", "is_remote", *filled).filter(kept)


def finish(df: DataFrame, name: str, ladder: str | None = None) -> DataFrame:
    """Standard record of the source, de-duplicated by its key ladder if it has one."""
    source = rules.SOURCE_BY_NAME[name]
    jobs = df.withColumns(
        {
            "source_name": F.lit(name),
            "source_id": F.lit(source.source_id),
            "seq": arrival(source, "payload_seq", "pos"),
            "part": F.lit(0),
        }
    )
    jobs = conform(jobs, JOBS_STD)
    return jobs if ladder is None else dedupe_source(jobs, ladder)


def with_detail(listed: DataFrame, details: DataFrame, url: str, how: str = "left") -> DataFrame:
    """Add the captured detail body (``detail``) of each listed posting by its URL.

    A URL captured twice counts once.  A failed capture has no body.
    """
    ok = succeeded(details).filter(F.col("body").isNotNull())
    one = cap_per_group(ok.select("url", "payload_seq", "body"), ["url"], ["payload_seq"], 1)
    right = one.select(F.col("url").alias("_url"), F.col("body").alias("detail"))
    return listed.join(right, listed[url] == right["_url"], how).drop("_url")
