"""Choosing and appending sources."""

from __future__ import annotations

import inspect
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from jobweave import rules
from jobweave.operators.filters import us_or_remote
from jobweave.sources.normalizers import NORMALIZERS
from jobweave.sources.normalizers.common import payload_of
from jobweave.sources.payloads import by_source


def _plain(name: str | None) -> str:
    return "".join(ch for ch in (name or "").lower() if ch.isalnum())


def wanted_sources(only: str | None = None) -> list[rules.Source]:
    """Sources a name or alias selects, compared on letters and digits; all without one."""
    if not _plain(only):
        return list(rules.SOURCES)
    return [s for s in rules.SOURCES if _plain(only) in {_plain(n) for n in (s.name, *s.aliases)}]


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All postings of several sources."""
    return reduce(DataFrame.unionByName, frames)


def normalize_payloads(payloads: DataFrame, only: str | None = None, route: bool = False, **options) -> DataFrame:
    """Standard postings of every source found in a payload table.

    Each source and kind is a filtered scan.  Where the table does not lie in folders by source,
    ``route`` copies it into such folders first, so that its bodies are read twice instead of
    once per source.

    Each source filters by its own rule (US, or remote where the source's flag allows)
    and is appended in its fixed order.  Options such as ``as_of`` go to the normalisers
    that take them.
    """
    if route:
        payloads = by_source(payloads)
    frames = []
    for source in wanted_sources(only):
        entry = NORMALIZERS[source.name]
        own = payloads.filter(F.col("source") == source.name)
        parts = [own.filter(F.col("kind") == kind) for kind in entry.kinds]
        takes = inspect.signature(entry.function).parameters
        extra = {k: v for k, v in options.items() if k in takes}
        jobs = entry.function(*parts, **extra)
        frames.append(us_or_remote(jobs, source.remote_counts))
    return union_sources(frames)


# How a source's list responses must look: where the list is, in JSON; or what a feed or page
# of that system begins with or holds.
_LIST_PATHS = {
    "Jobicy": ("$.jobs",), "Remotive": ("$.jobs",), "Arbeitnow": ("$.data",), "Greenhouse": ("$.jobs",), "Taleo": ("$.requisitionList",),
    "Lever": ("$",), "Ashby": ("$.jobs",), "SmartRecruiters": ("$.content",), "Dayforce": ("$",), "Recruitee": ("$.offers",), "Jobsoid": ("$",),
    "OracleCloud": ("$.items",), "BambooHR": ("$.result",), "ApplicantPro": ("$.data.jobs",), "BreezyHR": ("$",), "Workday": ("$.jobPostings",),
    "SuccessFactors": ("$", "$.jobs", "$.results", "$.data.jobs"),
}


# Where a detail response has its posting, in JSON.
_DETAIL_PATHS = {
    "SmartRecruiters": ("$.name", "$.jobAd"), "OracleCloud": ("$.items",), "BambooHR": ("$.result.jobOpening",), "ApplicantPro": ("$.data",),
    "Workday": ("$.jobPostingInfo",),
}
# What a page of a source and kind holds, any of these; a list page may also say that it has no jobs.
_OG_TITLE = r"""(?is)<meta[^>]+og:title"""
_META_DESCRIPTION = r"""(?is)<meta[^>]+(?:name|property)=["'](?:og:)?description["']"""
_PAGE_MARKS = {
    ("Freshteam", "list"): (rules.FRESHTEAM_CARD, rules.FRESHTEAM_TYPE_SELECT, rules.NO_JOBS_PAGE),
    ("Freshteam", "detail"): (rules.JSON_LD_POSTING, _OG_TITLE, r"""(?i)class=["'][^"']*job-desc"""),
    ("ZohoRecruit", "list"): (rules.ZOHO_ROW, rules.JOB_LINK_PATTERNS["zohorecruit"], rules.JSON_LD_POSTING, rules.NO_JOBS_PAGE),
    ("ZohoRecruit", "detail"): (rules.JSON_LD_POSTING, rules.JOB_LINK_PATTERNS["zohorecruit"], _OG_TITLE, r"(?i)zoho"),
    ("JazzHR", "detail"): (rules.JSON_LD_POSTING, _OG_TITLE, *rules.JOB_LOCATION_HTML, *rules.JOB_DESCRIPTION_HTML),
    ("iCIMS", "detail"): (rules.JSON_LD_POSTING, _OG_TITLE, rules.ICIMS_LOCATION_HTML),
    ("CATSOne", "detail"): (rules.EMBEDDED_TITLE, rules.JSON_LD_POSTING),
    ("BreezyHR", "detail"): (rules.JSON_LD_POSTING, _META_DESCRIPTION),
    ("PinpointHQ", "detail"): (rules.JSON_LD_POSTING, _META_DESCRIPTION, rules.URL_ID_PATTERNS["posting_uuid"]),
}


def _is_list(body: Column, path: str) -> Column:
    found = body if path == "$" else F.get_json_object(body, path)
    return F.coalesce(F.startswith(F.ltrim(found), F.lit("[")), F.lit(False))


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _wrong_shape(body: Column) -> Column:
    """True for a response whose body can't hold its source's postings."""
    own = lambda name, kind: (F.col("source") == name) & (F.col("kind") == kind)
    out = F.lit(False)
    for name, paths in _LIST_PATHS.items():
        out = F.when(own(name, "list"), ~_any([_is_list(body, p) for p in paths])).otherwise(out)
    for name, paths in _DETAIL_PATHS.items():
        out = F.when(own(name, "detail"), ~_any([F.get_json_object(body, p).isNotNull() for p in paths])).otherwise(out)
    for (name, kind), marks in _PAGE_MARKS.items():
        out = F.when(own(name, kind), ~_any([body.rlike(m) for m in marks])).otherwise(out)
    feed = F.col("kind") == "feed"
    return F.when(feed, ~body.rlike(r"(?is)<(rss|feed|channel|item|workzag-jobs|jobs|position)\b")).otherwise(out)


def _reason() -> Column:
    """Why no normaliser can use a payload; NULL when one can."""
    names = [s.name for s in rules.SOURCES]
    kinds = [F.lit(f"{name}|{kind}") for name, entry in NORMALIZERS.items() for kind in entry.kinds]
    own_kind = F.array_contains(F.array(*kinds), F.concat_ws("|", "source", "kind"))
    body = F.ltrim(F.coalesce("body", F.lit("")))
    looks_json = body.rlike(r"^[\[{]")
    return (
        F.when(~F.col("source").isin(*names), F.lit("unknown source"))
        .when(~own_kind, F.lit("unknown kind"))
        .when(F.col("status_code").isNotNull() & ~F.col("status_code").between(200, 299), F.lit("status"))
        .when(body == "", F.lit("empty body"))
        .when(looks_json & F.try_parse_json("body").isNull(), F.lit("broken json"))
        .when(body.rlike(rules.BLOCKED_PAGE) & ~body.rlike(rules.JSON_LD_POSTING), F.lit("blocked page"))
        .when(_wrong_shape(body), F.lit("wrong shape"))
    )


def rejects(payloads: DataFrame) -> DataFrame:
    """Payloads no normaliser can use, with the reason: unknown sources and kinds, failed captures,
    empty bodies, JSON that does not parse, pages in front of a site, and bodies of another
    shape than the source's.  An empty list, and a page that says it has no jobs, is not a reject.

    A broken body gives no postings; it does not stop the other sources.
    """
    return payloads.withColumn("reason", _reason()).filter(F.col("reason").isNotNull())


def outcomes(payloads: DataFrame, postings: DataFrame) -> DataFrame:
    """(source, kind, payload_seq, domain, url, outcome, postings) of every payload.

    ``postings`` are the normalised ones of these payloads.  The outcome is the reject's reason;
    else 'postings' where there are some; 'none kept' where a list or feed was read, but was
    empty or its postings were filtered or given by other payloads; 'read' for details, which
    complete the postings of lists.  Only counts are joined, by source and payload.
    """
    counts = postings.groupBy(F.col("source_name").alias("_source"), payload_of("seq").alias("_seq")).agg(F.count(F.lit(1)).alias("postings"))
    rows = payloads.select("source", "kind", "payload_seq", "domain", "url", _reason().alias("reason"))
    joined = rows.join(counts, (F.col("source") == F.col("_source")) & (F.col("payload_seq") == F.col("_seq")), "left")
    own = F.array(*[F.lit(name) for name, entry in NORMALIZERS.items() if entry.kinds == ("detail",)])
    gives = (F.col("kind") != "detail") | F.array_contains(own, F.col("source"))
    n = F.when(F.col("reason").isNull() & gives, F.coalesce("postings", F.lit(0))).otherwise(0).cast("bigint")
    outcome = F.coalesce("reason", F.when(~gives, "read").when(n > 0, "postings").otherwise("none kept"))
    return joined.select("source", "kind", "payload_seq", "domain", "url", outcome.alias("outcome"), n.alias("postings"))
