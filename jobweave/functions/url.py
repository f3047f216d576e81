"""URLs: hosts, tenants, ids, slugs, links and the builders of job addresses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobweave import rules
from jobweave.functions.text import col, empty_to_null, is_blank, let, trim_ws


def normalize_domain(c) -> Column:
    """Host of a catalogue cell: no scheme, path, outer dots or 'www.'."""
    value = F.rtrim(F.lower(trim_ws(F.coalesce(col(c), F.lit("")))), F.lit("/"))
    value = F.regexp_replace(value, "^https?://", "")
    value = F.trim(trim_ws(F.split_part(value, F.lit("/"), F.lit(1))), F.lit("."))
    return F.regexp_replace(value, r"^www\.", "")


def domain_from_url(c) -> Column:
    """Lower-case host of an absolute URL, '' otherwise."""
    return F.coalesce(F.lower(F.try_parse_url(col(c), F.lit("HOST"))), F.lit(""))


def url_path(c) -> Column:
    return F.coalesce(F.try_parse_url(col(c), F.lit("PATH")), F.lit(""))


def host_if_suffix(c, suffix: str) -> Column:
    """Host of a value that may lack a scheme, kept only under ``suffix``; else ''."""
    text = trim_ws(c)
    absolute = F.when(text.rlike("(?i)^https?://"), text).otherwise(
        F.concat(F.lit("https://"), F.ltrim(text, F.lit("/")))
    )
    host = domain_from_url(absolute)
    return F.when(F.endswith(host, F.lit(suffix)), host).otherwise("")


def tenant_key(c) -> Column:
    """Tenant part of a scoped id: the host without 'www.'."""
    value = F.lower(trim_ws(F.coalesce(col(c), F.lit(""))))
    value = F.coalesce(F.lower(F.try_parse_url(value, F.lit("HOST"))), value)
    value = trim_ws(F.split_part(value, F.lit("/"), F.lit(1)))
    return F.regexp_replace(value, r"^www\.", "")


def workday_host(c) -> tuple[Column, Column]:
    """(tenant, server) of a Workday host; '' when it is another host."""
    value = F.coalesce(col(c), F.lit(""))
    return F.regexp_extract(value, rules.WORKDAY_HOST, 1), F.regexp_extract(value, rules.WORKDAY_HOST, 2)


def path_segments(c) -> Column:
    """Decoded, non-empty path segments."""
    return F.transform(
        F.filter(F.split(url_path(c), "/"), lambda s: s != ""),
        lambda s: F.coalesce(F.try_url_decode(s), s),
    )


def resolve(base, href) -> Column:
    """Absolute form of an href without its fragment.

    Covers absolute, scheme-relative, root-relative and folder-relative links.
    """
    return let(col(href), lambda h: let(col(base), lambda b: _resolved(b, h)))


def _resolved(base: Column, href: Column) -> Column:
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    folder = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/(?:[^?#]*/)?)", 1)
    url = (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(F.startswith(href, F.lit("/")), F.concat(origin, href))
        .otherwise(F.concat(origin, F.when(folder == "", F.lit("/")).otherwise(folder), href))
    )
    return F.split_part(url, F.lit("#"), F.lit(1))


def id_from_url(c, system: str) -> Column:
    """Posting id inside a URL; the URL itself when the pattern is absent."""
    names = ["zohorecruit_query", "zohorecruit_path"] if system == "zohorecruit" else [system]
    find = lambda v: [empty_to_null(F.regexp_extract(v, rules.URL_ID_PATTERNS[n], 1)) for n in names]
    if system == "successfactors":
        return find(col(c))[0]
    return let(col(c), lambda v: F.coalesce(*find(v), v))


def posting_uuid(c) -> Column:
    """First UUID in a value, lower case; '' if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(col(c), F.lit("")), "(?i)" + rules.UUID, 0))


def posting_uuid_in_html(c) -> Column:
    return F.lower(
        F.regexp_extract(F.coalesce(col(c), F.lit("")), rules.URL_ID_PATTERNS["posting_uuid"], 1)
    )


def title_from_url(c, system: str) -> Column:
    """Readable title from a URL slug, '' if there is none."""
    slug = F.regexp_extract(url_path(c), rules.URL_SLUG_PATTERNS[system], 1)
    return trim_ws(F.regexp_replace(F.coalesce(F.try_url_decode(slug), slug), "[-_]+", " "))


def with_query(url, **params) -> Column:
    """URL with query parameters set; present names keep their place, new ones follow."""
    url = col(url)
    base = F.regexp_extract(url, r"^([^?#]*)", 1)
    query = F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(""))
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    for name, value in params.items():
        pair = F.concat(F.lit(name + "="), F.url_encode(F.lit(value) if isinstance(value, str) else value))
        has = F.exists(pairs, lambda p: F.lower(F.split_part(p, F.lit("="), F.lit(1))) == name.lower())
        pairs = F.when(
            has,
            F.transform(
                pairs,
                lambda p: F.when(
                    F.lower(F.split_part(p, F.lit("="), F.lit(1))) == name.lower(), pair
                ).otherwise(p),
            ),
        ).otherwise(F.concat(pairs, F.array(pair)))
    return F.concat(base, F.lit("?"), F.array_join(pairs, "&"))


def paged_search_url(url, page) -> Column:
    """The paging form of a search page: ss kept or 1, in_iframe=1, pr=page."""
    url = col(url)
    has_ss = url.rlike("(?i)[?&]ss=")
    return F.when(
        has_ss, with_query(url, in_iframe="1", pr=col(page).cast("string"))
    ).otherwise(with_query(url, ss="1", in_iframe="1", pr=col(page).cast("string")))


def glob_to_like(pattern: str) -> str:
    """'*' wildcard pattern as a LIKE pattern over scheme-less URLs."""
    return pattern.replace("%", r"\%").replace("_", r"\_").replace("*", "%")


def matches_pattern(url, pattern: str) -> Column:
    bare = F.regexp_replace(col(url), "(?i)^https?://", "")
    return F.lower(bare).like(glob_to_like(pattern.lower()))


# --- builders ------------------------------------------------------------------------


def _is_absolute(path: Column) -> Column:
    return path.rlike("(?i)^https?://")


def workday_job_url(domain, site, external_path) -> Column:
    head = F.concat(F.lit("https://"), col(domain), F.lit("/en-US/"), col(site))
    return let(
        F.coalesce(col(external_path), F.lit("")),
        lambda path: F.when(_is_absolute(path), path)
        .when(F.startswith(path, F.lit("/")), F.concat(head, path))
        .otherwise(F.concat(head, F.lit("/job/"), path)),
    )


def workday_sample_url(domain, site, external_path) -> Column:
    """Job URL of a probe sample: '' when the probe had no path."""
    return F.when(is_blank(external_path), F.lit("")).otherwise(
        workday_job_url(domain, site, external_path)
    )


def workday_detail_url(domain, tenant, site, external_path) -> Column:
    path = F.coalesce(trim_ws(external_path), F.lit(""))
    path = F.when(_is_absolute(path), url_path(path)).otherwise(path)
    path = F.regexp_replace(F.ltrim(path, F.lit("/")), "(?i)^job/", "")
    return F.concat(
        F.lit("https://"), col(domain), F.lit("/wday/cxs/"), col(tenant), F.lit("/"), col(site),
        F.lit("/job/"), path,
    )


def workday_api_url(domain, tenant, site) -> Column:
    return F.concat(
        F.lit("https://"), col(domain), F.lit("/wday/cxs/"), col(tenant), F.lit("/"), col(site), F.lit("/jobs")
    )


def workday_careers_url(domain, site) -> Column:
    return F.concat(F.lit("https://"), col(domain), F.lit("/en-US/"), col(site))


def oracle_job_url(domain, site, job_id) -> Column:
    return F.concat(
        F.lit("https://"), col(domain), F.lit("/hcmUI/CandidateExperience/en/sites/"), col(site),
        F.lit("/job/"), col(job_id),
    )


def oracle_list_url(domain, site, limit: int, offset) -> Column:
    return F.concat(
        F.lit("https://"), col(domain),
        F.lit("/hcmRestApi/resources/latest/recruitingCEJobRequisitions?onlyData=true&finder=findReqs;siteNumber="),
        col(site), F.lit(f",limit={limit},offset="), col(offset).cast("string"),
        F.lit(",sortBy=POSTING_DATES_DESC&expand=requisitionList"),
    )


def oracle_detail_url(domain, site, job_id) -> Column:
    return F.concat(
        F.lit("https://"), col(domain),
        F.lit("/hcmRestApi/resources/latest/recruitingCEJobRequisitionDetails?onlyData=true&finder=ById;Id="),
        F.url_encode(col(job_id)), F.lit(",siteNumber="), F.url_encode(col(site)), F.lit("&expand=all"),
    )
