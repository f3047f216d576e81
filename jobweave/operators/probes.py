"""Captured probes of career sites: candidates in their order, and count readers per system."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from jobweave import rules
from jobweave.functions.html import (
    class_text,
    clean_text,
    decode_entities,
    first_group,
    hrefs,
    job_links,
    job_postings,
    page_title,
    strip_tags,
    table_cells,
)
from jobweave.functions.text import best_title, col, contains_any, distinct_ignore_case, empty_to_null, filled_items, is_blank, trim_ws
from jobweave.functions.xmlv import xml_elements, xml_record
from jobweave.functions.url import oracle_job_url, resolve, url_path, workday_api_url, workday_careers_url
from jobweave.operators.filters import login_wall
from jobweave.session import cut_lineage

# --- candidates ----------------------------------------------------------------------------


def _https(*parts) -> Column:
    return F.concat(F.lit("https://"), F.col("domain"), *parts)


def _workday(site: Column) -> Column:
    return workday_api_url(F.col("domain"), F.regexp_extract("domain", rules.WORKDAY_HOST, 1), site)


#: Per system, the values tried in order and the URL each is fetched from.
CANDIDATES: dict[str, tuple[list[str], Callable[[Column], Column]]] = {
    "Workday": (rules.WORKDAY_SITE_CANDIDATES, _workday),
    "iCIMS": (rules.ICIMS_PATHS, _https),
    "JazzHR": (rules.JAZZHR_PATHS, _https),
    "OracleCloud": (rules.ORACLE_SITES, lambda site: _https(F.lit("/hcmUI/CandidateExperience/en/sites/"), site)),
    "ZohoRecruit": (rules.ZOHO_PATHS, _https),
}


def _candidate_list() -> Column:
    lists = F.lit(None).cast("array<string>")
    for system, (values, _) in CANDIDATES.items():
        lists = F.when(F.col("system") == system, F.array(*[F.lit(v) for v in values])).otherwise(lists)
    return lists


def candidate_urls(sites: DataFrame) -> DataFrame:
    """(system, domain, attempt, candidate, probe_url) of each candidate of the given sites.

    ``sites`` has ``system`` and ``domain``; systems without a list have no candidates.
    """
    rows = sites.select("system", F.lower("domain").alias("domain")).distinct()
    rows = rows.select("system", "domain", F.posexplode(_candidate_list()).alias("attempt", "candidate"))
    url = F.lit(None).cast("string")
    for system, (_, build) in CANDIDATES.items():
        url = F.when(F.col("system") == system, build(F.col("candidate"))).otherwise(url)
    return rows.withColumn("probe_url", url).withColumn("attempt", F.col("attempt") + 1)


def _base() -> Column:
    return F.concat(F.lit("https://"), F.col("domain"))


def _responded() -> Column:
    return F.coalesce(F.col("status_code").between(200, 299), F.lit(False))


def _has(*words: str) -> Column:
    return contains_any(F.coalesce("body", F.lit("")), list(words))


def _links(system: str) -> Column:
    """Whether a page has a job link of its system."""
    return F.size(hrefs("body", system)) > 0


def valid_response() -> Column:
    """Whether a captured response is one of its system's: the first such candidate is the site's."""
    body = F.col("body")
    row = lambda r: (first_group(r, rules.ZOHO_ANCHOR, 1) != "") | (F.size(hrefs(r, "zohorecruit")) > 0)
    inline = F.exists(job_postings("body"), lambda p: ~is_blank(p["title"]))
    tests = {
        "Workday": F.startswith(F.ltrim(body), F.lit("{")) & F.try_parse_json(body).isNotNull(),
        "iCIMS": _links("icims") | _has("icims"),
        "JazzHR": _links("jazzhr") | _has("jazzhr", "resumator", "applytojob"),
        "OracleCloud": (first_group("body", rules.ORACLE_SITE_NUMBER) != "") | _has("candidateexperience"),
        "ZohoRecruit": ~login_wall("final_url", "body") & (_links("zohorecruit") | F.exists(_zoho_rows(), row) | F.coalesce(inline, F.lit(False))),
    }
    out = F.lit(False)
    for system, test in tests.items():
        out = F.when(F.col("system") == system, test).otherwise(out)
    return _responded() & F.coalesce(out, F.lit(False))


def first_valid_candidates(sites: DataFrame, captures: DataFrame) -> DataFrame:
    """(system, domain, attempt, candidate, probe_url, status_code, body, final_url, attempted) of
    the first candidate of each site whose captured response is valid; sites without one have no row.

    ``captures`` has url, status_code, body, and final_url where requests were redirected; they
    meet the candidates by URL.  ``attempted`` lists the candidates up to the valid one: one that
    was not captured, or failed, counts as tried.  Of several valid captures of a candidate one
    is taken, chosen by a hash of its body.
    """
    final = F.coalesce("final_url", "url") if "final_url" in captures.columns else F.col("url")
    seen = captures.select(F.col("url").alias("probe_url"), "status_code", "body", final.alias("final_url"))
    valid = candidate_urls(sites).join(seen, "probe_url").filter(valid_response())
    valid = cut_lineage(valid.withColumn("_capture", F.monotonically_increasing_id()), "valid-probes")
    # bodies stay out of the choice
    first = F.min(F.struct("attempt", F.xxhash64("final_url", "body").alias("h"), "_capture"))
    chosen = valid.groupBy("system", "domain").agg(first.alias("f")).select("f._capture")
    won = valid.join(chosen, "_capture", "left_semi").drop("_capture")
    return won.withColumn("attempted", F.array_join(F.slice(_candidate_list(), F.lit(1), F.col("attempt")), ";"))


# --- readers ---------------------------------------------------------------------------------


def _zoho_rows() -> Column:
    return F.regexp_extract_all(F.coalesce("body", F.lit("")), F.lit(rules.ZOHO_ROW), F.lit(1))


def _zoho_row_link(row: Column) -> Column:
    anchor = first_group(row, rules.ZOHO_ANCHOR, 1)
    return F.when(anchor != "", resolve(F.col("final_url"), decode_entities(anchor))).otherwise(F.get(job_links(row, F.col("final_url"), "zohorecruit"), F.lit(0)))


def _zoho_links() -> Column:
    """Links of the portal table's rows, else of the page."""
    rows = distinct_ignore_case(filled_items(F.transform(_zoho_rows(), _zoho_row_link)))
    return F.when(F.size(rows) > 0, rows).otherwise(job_links("body", F.col("final_url"), "zohorecruit"))


def _zoho_inline() -> Column:
    return F.filter(job_postings("body"), lambda p: ~is_blank(p["title"]))


def _zoho_count() -> Column:
    return F.when(F.size(_zoho_links()) > 0, F.size(_zoho_links())).otherwise(F.size(_zoho_inline()))


def _variant(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


def _json_columns(probe: rules.JsonProbe) -> dict[str, Column]:
    """Count and sample of one system's list, read from the parsed body ``_v``."""
    items = _variant(F.col("_v"), probe.items, "array<variant>")
    first = F.get(items, F.lit(0))
    field = lambda path: F.coalesce(trim_ws(_variant(first, path)), F.lit("")) if path else F.lit("")
    total = _variant(F.col("_v"), probe.total, "int") if probe.total else F.lit(None).cast("int")
    count = total if probe.total_only else F.when(items.isNotNull(), F.coalesce(total, F.size(items)))
    identifier = field(probe.id)
    built = oracle_job_url("domain", "site", identifier) if probe.name == "OracleCloud" else _https(F.lit(probe.path), identifier) if probe.path else F.lit("")
    built = F.when(identifier != "", built).otherwise("")
    url = F.when(field(probe.url) != "", field(probe.url)).otherwise(built)
    company = F.coalesce(_variant(F.col("_v"), probe.company), F.lit("")) if probe.company else F.lit("")
    return {
        "job_links_found": count, "sample_job_url": url, "sample_title": field(probe.title),
        "sample_posted_at": field(probe.posted), "sample_company": company,
    }


def _feed_columns() -> dict[str, dict[str, Column]]:
    rss, jobs = xml_elements("body", "item"), xml_elements("body", "position")
    item = xml_record(F.get(rss, F.lit(0)), "link string,title string,pubDate string", "item")
    position = xml_record(F.get(jobs, F.lit(0)), "id string,name string,createdAt string", "position")
    text = lambda c: F.coalesce(clean_text(c), F.lit(""))
    plain = lambda c: F.coalesce(trim_ws(c), F.lit(""))
    home = F.concat(_base(), F.lit("/"))
    return {
        "PinpointHQ": {
            "job_links_found": F.size(rss), "sample_job_url": text(item["link"]), "sample_title": text(item["title"]), "sample_posted_at": text(item["pubDate"]),
        },
        "Personio": {
            "job_links_found": F.size(jobs), "sample_title": plain(position["name"]), "sample_posted_at": plain(position["createdAt"]),
            "sample_job_url": F.when(is_blank(position["id"]), home).otherwise(F.concat(home, F.lit("job/"), trim_ws(position["id"]))),
        },
    }


def _page_columns() -> dict[str, dict[str, Column]]:
    fresh = job_links("body", _base(), "freshteam")
    card = first_group("body", rules.FRESHTEAM_CARD, 4)
    own = url_path(F.col("final_url"))
    cats = F.filter(job_links("body", F.col("final_url"), "catsone"), lambda u: F.lower(url_path(u)) != F.lower(own))
    row, inline = F.get(_zoho_rows(), F.lit(0)), F.get(_zoho_inline(), F.lit(0))
    titled = best_title(strip_tags(first_group(row, rules.ZOHO_ANCHOR, 2)), table_cells(row))
    return {
        "Freshteam": {"job_links_found": F.size(fresh), "sample_job_url": F.get(fresh, F.lit(0)), "sample_title": class_text(card, "job-title")},
        "CATSOne": {
            "job_links_found": F.size(cats), "sample_job_url": F.coalesce(F.get(cats, F.lit(0)), F.col("final_url")),
            "sample_title": F.when(F.size(cats) > 0, "").otherwise(page_title("body")),
        },
        "ZohoRecruit": {
            "job_links_found": F.when(~login_wall("final_url", "body"), _zoho_count()),
            "sample_job_url": F.coalesce(F.get(_zoho_links(), F.lit(0)), inline["url"], F.col("final_url")),
            "sample_title": F.coalesce(empty_to_null(F.when(row.isNotNull(), titled)), inline["title"], F.lit("")),
        },
    }


SAMPLE = ["job_links_found", "sample_job_url", "sample_title", "sample_posted_at", "sample_company"]


def read_probes(captures: DataFrame) -> DataFrame:
    """(system, domain, site, list_url, status_code, portal_id, and SAMPLE) of every captured list
    response that counts at least one posting.

    ``captures`` has system, domain, site, url, status_code, body, and final_url where requests
    were redirected.  Bodies are parsed once, in one scan of all systems; those of failed
    requests and broken ones count nothing.
    """
    final = F.coalesce("final_url", "url") if "final_url" in captures.columns else F.col("url")
    rows = captures.filter(_responded()).select("system", F.lower("domain").alias("domain"), "site", "url", final.alias("final_url"), "status_code", "body")
    json = F.col("system").isin(*[p.name for p in rules.JSON_PROBES])
    rows = rows.withColumn("_v", F.when(json, F.try_parse_json("body")))
    readers = {p.name: _json_columns(p) for p in rules.JSON_PROBES} | _feed_columns() | _page_columns()
    sample = F.lit(None).cast("struct<job_links_found:int,sample_job_url:string,sample_title:string,sample_posted_at:string,sample_company:string>")
    for system, columns in readers.items():
        fields = [F.coalesce(columns[c], F.lit("")).alias(c) if c in columns else F.lit("").alias(c) for c in SAMPLE[1:]]
        own = F.struct(columns["job_links_found"].cast("int").alias(SAMPLE[0]), *fields)
        sample = F.when(F.col("system") == system, own).otherwise(sample)
    found = rows.select("system", "domain", "site", F.col("final_url").alias("list_url"), "status_code", F.explode(F.array(sample)).alias("s"))
    portal = F.when(F.col("system") == "CATSOne", first_group("list_url", rules.CATSONE_PORTAL)).otherwise("")
    return found.filter("s.job_links_found > 0").select("system", "domain", "site", "list_url", "status_code", portal.alias("portal_id"), "s.*")


def workday_sites(first: DataFrame) -> DataFrame:
    """Catalogue columns of the first valid Workday candidates (see ``first_valid_candidates``)."""
    v = F.try_parse_json("body")
    sample = F.get(F.try_variant_get(v, "$.jobPostings", "array<variant>"), F.lit(0))
    return first.filter(F.col("system") == "Workday").select(
        "domain", F.regexp_extract("domain", rules.WORKDAY_HOST, 1).alias("tenant"), F.regexp_extract("domain", rules.WORKDAY_HOST, 2).alias("wd_server"),
        F.col("candidate").alias("site"), F.col("probe_url").alias("api_url"), workday_careers_url("domain", "candidate").alias("careers_url"),
        F.col("status_code").cast("string").alias("status_code"), F.coalesce(F.try_variant_get(v, "$.total", "string"), F.lit("")).alias("total_jobs"),
        F.coalesce(F.try_variant_get(sample, "$.title", "string"), F.lit("")).alias("sample_title"),
        F.lit(str(len(rules.WORKDAY_SITE_CANDIDATES))).alias("candidate_count"), F.col("attempted").alias("attempted_sites"),
    )


def oracle_sites(first: DataFrame) -> DataFrame:
    """(domain, site) of Oracle career sites: the number on the page, else the candidate."""
    number = first_group("body", rules.ORACLE_SITE_NUMBER)
    return first.filter(F.col("system") == "OracleCloud").select("domain", F.when(number != "", number).otherwise(col("candidate")).alias("site"))
