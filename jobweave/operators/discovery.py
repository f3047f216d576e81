"""Deriving site catalogues from URL archives and captured probe responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobweave import rules
from jobweave.functions.text import blank_to_null, col, is_blank, normalize_key, trim_ws
from jobweave.functions.url import (
    domain_from_url,
    matches_pattern,
    normalize_domain,
    path_segments,
    workday_api_url,
    workday_careers_url,
    workday_sample_url,
)
from jobweave.operators.dedupe import first_per_key
from jobweave.operators.ordering import number_rows


def catalog_domain(df: DataFrame) -> Column:
    """First filled of the four domain columns, else the first column of the file."""
    names = {c.lower(): c for c in df.columns}
    picks = [names[c] for c in ("domain", "normalized_domain", "original_domain") if c in names]
    return F.coalesce(*[F.when(~is_blank(c), F.col(c)) for c in picks], F.col(df.columns[0]))


def site_domains(df: DataFrame, domain: Column, order: str, block: Column) -> DataFrame:
    """Distinct normalised domains with their catalogue row number (the header is row 1).

    ``block`` groups ``order`` into ranges small enough for one task.
    """
    rows = df.select(F.col(order), normalize_domain(domain).alias("domain"))
    first = rows.filter(F.col("domain") != "").groupBy("domain").agg(F.min(order).alias(order))
    return number_rows(first, F.col(order), block, "source_row", start=2).select("source_row", "domain")


def route_source(domain, routes: Sequence[rules.Rule] = rules.HOST_ROUTES) -> Column:
    """Recruiting system a host belongs to; NULL when none of the patterns fits."""
    host = F.coalesce(col(domain), F.lit(""))
    label = F.lit(None).cast("string")
    for route in reversed(routes):
        label = F.when(host.rlike("(?i)" + route.pattern), F.lit(route.label)).otherwise(label)
    return label


def archive_candidate(url, host_pattern: str = rules.WORKDAY_HOST, marker: str = "job") -> Column:
    """(domain, tenant, server, site) of an archived job URL, or NULL.

    The path needs the marker segment at position two or later with something after it;
    the site is the segment before it.
    """
    domain = domain_from_url(url)
    segments = path_segments(url)
    at = F.array_position(F.transform(segments, F.lower), marker).cast("int")  # 1-based
    site = F.get(segments, at - 2)
    ok = domain.rlike(host_pattern) & (at >= 3) & (at < F.size(segments)) & ~is_blank(site)
    return F.when(
        ok,
        F.struct(
            domain.alias("domain"),
            F.regexp_extract(domain, host_pattern, 1).alias("tenant"),
            F.regexp_extract(domain, host_pattern, 2).alias("server"),
            site.alias("site"),
        ),
    )


def seed_candidate(url, suffix: str = rules.WORKDAY_SUFFIX, marker: str = "job") -> Column:
    """The variant for stored job URLs: the marker at position one or later is enough, and
    a locale segment before it is skipped when there is another one."""
    domain = domain_from_url(url)
    segments = F.filter(F.split(F.trim(_path(url), F.lit("/")), "/"), lambda s: s != "")
    at = F.array_position(segments, marker).cast("int")
    near = F.get(segments, at - 2)
    site = F.when(near.rlike(rules.LOCALE_SEGMENT) & (at >= 3), F.get(segments, at - 3)).otherwise(near)
    labels = F.split(domain, r"\.")
    ok = F.endswith(domain, F.lit(suffix)) & (at >= 2) & ~is_blank(site) & (F.size(labels) >= 3)
    return F.when(
        ok,
        F.struct(
            domain.alias("domain"), labels[0].alias("tenant"), labels[1].alias("server"), site.alias("site")
        ),
    )


def _path(url) -> Column:
    from jobweave.functions.url import url_path

    return url_path(url)


def candidates(df: DataFrame, url: str, order: str, parse=archive_candidate, **options) -> DataFrame:
    """Parsed candidates: the first URL per domain and site, ignoring case."""
    rows = df.select(F.col(order), F.col(url).alias("url"), parse(F.col(url), **options).alias("c"))
    rows = rows.filter(F.col("c").isNotNull()).select(order, "url", "c.*")
    return first_per_key(rows, F.concat_ws("|", "domain", "site"), [order], "drop")


def domain_site_keys(df: DataFrame, domain="domain", site="site") -> DataFrame:
    """Distinct (domain, site) keys of a list, blanks dropped."""
    return (
        df.select(normalize_key(domain).alias("_domain"), normalize_key(site).alias("_site"))
        .filter((F.col("_domain") != "") & (F.col("_site") != ""))
        .distinct()
    )


def any_column_hosts(df: DataFrame, host) -> DataFrame:
    """Distinct hosts found in any cell of a table; ``host`` maps a cell to a host or ''."""
    cells = df.select(F.explode(F.array(*[F.col(c).cast("string") for c in df.columns])).alias("cell"))
    return cells.select(F.lower(host(F.col("cell"))).alias("domain")).filter(F.col("domain") != "").distinct()


def exclude(df: DataFrame, known: DataFrame | None = None, skip: DataFrame | None = None) -> DataFrame:
    """Drop candidates of known domains and skipped (domain, site) pairs.

    Both lists are distinct; Spark broadcasts them when they are small.
    """
    if known is not None:
        keys = known.select(F.lower("domain").alias("_domain")).distinct()
        df = df.join(keys, F.lower(df["domain"]) == keys["_domain"], "left_anti")
    if skip is not None:
        keys = domain_site_keys(skip)
        df = df.join(
            keys,
            (normalize_key(df["domain"]) == keys["_domain"]) & (normalize_key(df["site"]) == keys["_site"]),
            "left_anti",
        )
    return df


def flag_known(df: DataFrame, known: DataFrame, flag: str = "known_from_jobsites") -> DataFrame:
    keys = known.select(F.lower("domain").alias("_domain")).distinct().withColumn("_known", F.lit(True))
    joined = df.join(keys, F.lower(df["domain"]) == keys["_domain"], "left")
    return joined.select(*df.columns, F.col("_known").isNotNull().alias(flag))


def first_valid_probe(probes: DataFrame, site: str, attempt: str, candidate: str, valid: str,
                      keep: Sequence[str] = ()) -> DataFrame:
    """First valid attempt per site, with the candidates tried up to it.

    Attempts are few per site (the candidate lists are fixed); repeated captures of one
    attempt are merged before any list is built.
    """
    # of several captures of an attempt, a valid one counts, the smallest of them whole
    capture = F.struct(candidate, *keep)
    merged = probes.groupBy(site, attempt).agg(
        F.min(F.struct((~F.col(valid)).alias("bad"), capture.alias("capture"))).alias("_best")
    ).select(site, attempt, (~F.col("_best.bad")).alias(valid), "_best.capture.*")
    found = merged.filter(valid).groupBy(site).agg(
        F.min(attempt).alias("_at"),
        F.min_by(F.struct(candidate, *keep), attempt).alias("_hit"),
    )
    tried = merged.join(found, site).filter(F.col(attempt) <= F.col("_at"))
    return tried.groupBy(site).agg(
        F.min("_hit").alias("_hit"),
        F.min("_at").alias(attempt),
        F.sort_array(F.collect_list(F.struct(attempt, candidate))).alias("_tried"),
    ).select(
        site, attempt, "_hit.*",
        F.array_join(F.transform("_tried", lambda t: t[candidate]), ";").alias("attempted"),
    )


def probe_to_catalog(df: DataFrame, site: str, items: str, url, title, posted=None) -> DataFrame:
    """Count and first-item sample of a list payload; empty lists give no row.

    ``url``, ``title`` and ``posted`` map an item to the sample columns.
    """
    first = F.get(F.col(items), F.lit(0))
    columns = [
        F.col(site),
        F.size(items).alias("job_links_found"),
        url(first).alias("sample_job_url"),
        title(first).alias("sample_title"),
    ]
    if posted is not None:
        columns.append(posted(first).alias("sample_posted_at"))
    return df.filter(F.size(items) > 0).select(*columns)


def slice_matches(df: DataFrame, url: str, patterns: Sequence[str]) -> DataFrame:
    """One row per matching wildcard pattern, with the pattern's rank."""
    hits = F.filter(
        F.array(*[F.when(matches_pattern(url, p), F.lit(i)) for i, p in enumerate(patterns)]),
        lambda i: i.isNotNull(),
    )
    return df.select("*", F.explode(hits).alias("slice"))


def discover_slices(df: DataFrame, rank: str, order: str, valid: Column, limit: int | None = None,
                    skip: DataFrame | None = None) -> DataFrame:
    """Valid candidates slice by slice, each (domain, site) once; with ``limit``, the first so many.

    The slices run one after another in the source and see what earlier ones took;
    taking the first occurrence by (slice, order) gives the same rows in one pass.
    """
    rows = exclude(df.filter(valid), skip=skip)
    first = first_per_key(rows, F.concat_ws("|", "domain", "site"), [rank, order], "drop")
    return first if limit is None else first.orderBy(rank, order).limit(limit)


def validate(cands: DataFrame, lists: DataFrame, details: DataFrame, index_id: str = "",
             notes: str = "Common Crawl Workday job URL discovery") -> DataFrame:
    """Candidates whose captured list response has jobs and whose sample is still live.

    ``lists``: domain, site, status_code, body.  ``details``: domain, site, status_code,
    body of the sample posting.  Of several captures of a list, the smallest usable response
    counts, so that captures never multiply a candidate.
    """
    shape = "total string, jobPostings array<struct<title:string,externalPath:string>>"
    listed = lists.select(
        normalize_key("domain").alias("_domain"), normalize_key("site").alias("_site"),
        F.col("status_code").cast("string").alias("status_code"), F.from_json("body", shape).alias("l"),
    ).filter(F.col("status_code").rlike("^2"))
    sample = F.get(F.col("l.jobPostings"), F.lit(0))
    listed = listed.select(
        "_domain", "_site", "status_code", F.coalesce(F.col("l.total"), F.lit("")).alias("total_jobs"),
        F.coalesce(sample["title"], F.lit("")).alias("sample_title"),
        F.coalesce(sample["externalPath"], F.lit("")).alias("sample_external_path"),
    ).filter((F.col("total_jobs").try_cast("int") > 0) & ~is_blank("sample_title") & ~is_blank("sample_external_path"))
    response = F.struct("status_code", "total_jobs", "sample_title", "sample_external_path")
    listed = listed.groupBy("_domain", "_site").agg(F.min(response).alias("r")).select("_domain", "_site", "r.*")
    live = details.filter(F.col("status_code").cast("string").rlike("^2")).select(
        normalize_key("domain").alias("_domain"), normalize_key("site").alias("_site"),
        F.get_json_object("body", "$.jobPostingInfo.title").alias("_title"),
    ).filter(~is_blank("_title")).select("_domain", "_site").distinct()
    keyed = cands.withColumn("_domain", normalize_key("domain")).withColumn("_site", normalize_key("site"))
    rows = keyed.join(listed, ["_domain", "_site"]).join(live, ["_domain", "_site"], "left_semi")
    text = lambda v: F.lit(v).cast("string")
    api = workday_api_url("domain", "tenant", "site")
    known = F.initcap(F.col("known_from_jobsites").cast("string")) if "known_from_jobsites" in cands.columns else text("False")
    values = {
        "source_row": text("commoncrawl"),
        "original_domain": F.col("domain"),
        "wd_server": F.col("server"),
        "api_url": api,
        "careers_url": workday_careers_url("domain", "site"),
        "final_url": api,
        "validated": text("True"),
        "sample_job_url": workday_sample_url("domain", "site", "sample_external_path"),
        "sample_still_available": text("True"),
        "known_from_jobsites": known,
        "commoncrawl_index": text(index_id),
        "commoncrawl_url": F.col("url"),
        "error": text(""),
        "candidate_count": text("1"),
        "attempted_sites": F.col("site"),
        "discovery_notes": text(notes),
        "elapsed_seconds": text(""),
    }
    from jobweave.schema import DISCOVERY_COLUMNS

    return rows.select(*[values.get(c, F.col(c)).alias(c) for c in DISCOVERY_COLUMNS])


def extend_skip_list(lists: Sequence[tuple[str, DataFrame]], order: str) -> DataFrame:
    """Union of earlier lists with the list each (domain, site) was first seen in."""
    union = None
    for rank, (name, df) in enumerate(lists):
        rows = df.select(
            F.lit(rank).alias("_rank"), F.col(order).alias("_order"), "domain", "site",
            F.lit(name).alias("source_file"),
        )
        union = rows if union is None else union.unionByName(rows)
    filled = union.filter(~is_blank("domain") & ~is_blank("site"))
    key = F.concat_ws("|", trim_ws("domain"), trim_ws("site"))
    return first_per_key(filled, key, ["_rank", "_order"], "drop").select("domain", "site", "source_file")


def sample_estimate(df: DataFrame, site: str, hit: Column) -> DataFrame:
    """Per site: rows, hits and hit percentage, over all of the site's rows."""
    counted = df.groupBy(site).agg(F.count(F.lit(1)).alias("total_jobs"), F.count_if(hit).alias("hits"))
    return counted.select(
        site, "total_jobs", "hits", F.round(100 * F.col("hits") / F.col("total_jobs"), 2).alias("hit_pct")
    ).orderBy(F.desc("hits"), F.asc(site))


def blank_as_null(df: DataFrame, *columns: str) -> DataFrame:
    """Blank cells of the listed columns as NULL."""
    return df.withColumns({c: blank_to_null(c) for c in columns})
