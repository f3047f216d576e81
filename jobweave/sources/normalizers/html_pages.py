"""Systems read from HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave import rules
from jobweave.functions.classify import (
    infer_category,
    is_it,
    job_type_in_text,
    names_non_us_country,
    normalize_category,
    remote_in,
)
from jobweave.functions.dates import parse_date
from jobweave.functions.html import (
    attribute,
    clean_text,
    class_text,
    decode_entities,
    first_group,
    first_of,
    h1,
    job_links,
    job_postings,
    json_string_field,
    meta,
    page_title,
    posting_company,
    posting_identifier,
    posting_job_type,
    posting_location,
    select_options,
    strip_tags,
    table_cells,
)
from jobweave.functions.ids import plain_id, scoped_id
from jobweave.functions.location import city_state_in_text, or_remote, place
from jobweave.functions.text import (
    best_title,
    blank_to_null,
    collapse_ws,
    company_from_career_page_title,
    company_from_domain,
    cut_after_bar,
    first_non_empty,
    is_blank,
    json_unescape,
    label_value,
    location_candidate,
    looks_like_date,
    strip_career_page,
    strip_careers_suffix,
    strip_hiring_for,
    trim_ws,
    upper_first,
)
from jobweave.functions.url import id_from_url, resolve, title_from_url
from jobweave.operators.dedupe import cap_per_group, dedupe_source
from jobweave.operators.filters import login_wall
from jobweave.session import cut_lineage
from jobweave.sources.normalizers.common import CONTEXT, context, finish, items, settled, us_or_remote, with_detail, with_posting



def _filled(c) -> Column:
    return blank_to_null(c)


def page_text(html) -> Column:
    """Whole text of a page."""
    return strip_tags(html)


def _pages(details: DataFrame) -> DataFrame:
    """Detail pages as rows: the page's URL is the posting's."""
    pages = context(details).select(
        *CONTEXT, F.lit(0).alias("pos"), F.col("url").alias("job_url"), F.col("body").alias("html")
    )
    return with_posting(pages, "html")


def _p(name: str) -> Column:
    return F.coalesce(F.col(f"p.{name}"), F.lit(""))


# --- Freshteam ---------------------------------------------------------------------------


def freshteam(payloads: DataFrame, details: DataFrame) -> DataFrame:
    """List pages hold job cards; a detail page completes a card when it was captured."""
    cards = F.regexp_extract_all(F.coalesce("body", F.lit("")), F.lit(rules.FRESHTEAM_CARD), F.lit(0))
    df = items(payloads, cards, select_options("body").alias("_types"))
    group = lambda n: F.regexp_extract("j", rules.FRESHTEAM_CARD, n)
    df = df.withColumns({"_attrs": group(1), "_id": trim_ws(decode_entities(group(2))), "_body": group(4)})
    df = df.withColumns(
        {
            "location": attribute("_attrs", "data-portal-location"),
            "_title": class_text("_body", "job-title"),
            "_text": class_text("_body", "job-desc"),
            "_type": F.coalesce(
                F.try_element_at("_types", attribute("_attrs", "data-portal-job-type")), F.lit("")
            ),
            "_href": decode_entities(first_group("_attrs", """(?i)href=["']([^"']+)["']""")),
        }
    )
    remote = F.lower(attribute("_attrs", "data-portal-remote-location")) == "true"
    df = df.withColumn("is_remote", remote & ~names_non_us_country("location"))
    df = us_or_remote(df, "_id", "_title")
    df = df.withColumn("job_url", resolve(F.concat(F.lit("https://"), F.col("domain"), F.lit("/")), F.col("_href")))
    df = with_detail(df, details, "job_url")
    page = lambda key: json_string_field("detail", key)
    df = df.withColumn(
        "description",
        first_non_empty(strip_tags(page("description")), class_text("detail", "job-desc"), "_text"),
    )
    posted_by = collapse_ws(first_group(meta("detail", "og:description"), r"(?i)Posted by\s*:\s*([^|]+)"))
    has_page = F.col("detail").isNotNull()
    df = df.withColumn(
        "title",
        F.when(has_page, strip_hiring_for(clean_text(first_non_empty(page("title"), meta("detail", "og:title"), "_title")))
        ).otherwise(F.col("_title")),
    )
    df = settled(df, "title").filter(F.col("title") != "")
    inferred = F.when(has_page, infer_category("title", "description", "freshteam"))
    return finish(
        df.withColumns(
            {
                "external_id": plain_id(92, "_id"),
                "company": first_non_empty(page("hiringOrganization"), posted_by, company_from_domain("domain")),
                "location": or_remote("location", F.col("is_remote")),
                "date_posted": parse_date(page("datePosted")),
                "job_type": first_non_empty(page("employmentType"), "_type"),
                "category": first_non_empty(
                    F.when(has_page, label_value("description", "Department")), inferred
                ),
            }
        ),
        "Freshteam",
        "id_first",
    )


# --- iCIMS ---------------------------------------------------------------------------------


def icims(details: DataFrame) -> DataFrame:
    """IT postings only: by the title in the URL before the page is read, then by the page."""
    df = context(details).filter(is_it(title_from_url("url", "icims"), F.lit("")))
    df = df.select(*CONTEXT, F.lit(0).alias("pos"), F.col("url").alias("job_url"), F.col("body").alias("html"))
    df = with_posting(df, "html", use_graph=False)
    df = df.withColumns(
        {
            "title": F.coalesce(
                F.when(~is_blank("p.title"), F.col("p.title")), _filled(meta("html", "og:title")),
                _filled(h1("html")), upper_first(title_from_url("job_url", "icims")),
            ),
            "location": F.coalesce(
                _filled(posting_location("p")), strip_tags(first_group("html", rules.ICIMS_LOCATION_HTML))
            ),
            "description": F.coalesce(_filled(strip_tags(_p("description"))), meta("html", "description")),
            "category": F.coalesce(F.col("p.occupationalCategory"), F.col("p.industry"), F.lit("")),
        }
    )
    df = df.withColumn("is_remote", remote_in("icims", "location", "title", "description"))
    df = us_or_remote(settled(df, "title").filter(~is_blank("title")))
    df = settled(df, "category").filter(is_it("title", "category"))
    company = F.coalesce(_filled(posting_company("p")), company_from_domain("domain", rules.ICIMS_COMPANY_PREFIX))
    return finish(
        df.withColumns(
            {
                "external_id": scoped_id(98, "icims", "domain", id_from_url("job_url", "icims")),
                "company": company,
                "location": or_remote("location", F.col("is_remote")),
                "date_posted": parse_date(_p("datePosted")),
                "job_type": posting_job_type("p"),
            }
        ),
        "iCIMS",
        "url_first",
    )


# --- JazzHR --------------------------------------------------------------------------------


def jazzhr(details: DataFrame) -> DataFrame:
    """Every field has a ladder: JSON-LD, meta tags, page markup, URL or host."""
    df = _pages(details)
    candidates = [location_candidate(strip_tags(first_group("html", p))) for p in rules.JOB_LOCATION_HTML]
    df = df.withColumns(
        {
            "_raw_title": F.coalesce(
                F.when(~is_blank("p.title"), F.col("p.title")), _filled(meta("html", "og:title")),
                _filled(h1("html")), upper_first(title_from_url("job_url", "jazzhr")),
            ),
            "location": F.coalesce(_filled(posting_location("p")), *[_filled(c) for c in candidates], F.lit("")),
            "description": F.coalesce(
                _filled(strip_tags(_p("description"))),
                _filled(strip_tags(first_of("html", rules.JOB_DESCRIPTION_HTML))),
                meta("html", "description"),
            ),
        }
    )
    df = df.withColumn("title", strip_career_page(decode_entities("_raw_title")))
    df = df.withColumn("is_remote", remote_in("jazzhr", "location", "title", "description"))
    df = us_or_remote(settled(df, "title").filter(~is_blank("title")))
    return finish(
        df.withColumns(
            {
                "external_id": scoped_id(97, "jazzhr", "domain", id_from_url("job_url", "jazzhr")),
                "company": F.coalesce(
                    _filled(posting_company("p")), _filled(meta("html", "og:site_name")),
                    _filled(company_from_career_page_title(decode_entities("_raw_title"))),
                    company_from_domain("domain"),
                ),
                "location": or_remote("location", F.col("is_remote")),
                "date_posted": parse_date(_p("datePosted")),
                "job_type": posting_job_type("p"),
                "category": first_non_empty(
                    _p("occupationalCategory"), _p("industry"),
                    strip_tags(first_of("html", rules.JOB_CATEGORY_HTML)),
                    infer_category("title", "description"),
                ),
            }
        ),
        "JazzHR",
        "url_first",
    )


# --- CATSOne -------------------------------------------------------------------------------


def embedded_field(text, key: str) -> Column:
    """Decoded string field of a JSON fragment inside a page."""
    raw = first_group(text, rf'(?i)"{key}"\s*:\s*"((?:\\.|[^"\\])*)"')
    return clean_text(json_unescape(raw))


def catsone(details: DataFrame) -> DataFrame:
    df = context(details).select(
        *CONTEXT, F.lit(0).alias("pos"), F.col("url").alias("job_url"), F.col("body").alias("html")
    )
    raw_title = clean_text(json_unescape(first_group("html", rules.EMBEDDED_TITLE)))
    raw_text = clean_text(json_unescape(first_group("html", rules.EMBEDDED_DESCRIPTION)))
    block = first_group("html", rules.EMBEDDED_LOCATION)
    named = place(*[embedded_field(block, k) for k in ("city", "state", "country_code")])
    df = df.withColumns(
        {
            "title": cut_after_bar(first_non_empty(raw_title, page_title("html"))),
            "description": first_non_empty(strip_tags(raw_text), page_text("html")),
            "location": F.coalesce(_filled(named), city_state_in_text(strip_tags("html"))),
        }
    )
    df = df.withColumn("is_remote", remote_in("catsone", "title", "location", "description"))
    df = us_or_remote(df, "title")
    return finish(
        df.withColumns(
            {
                "external_id": scoped_id(98, "catsone", "domain", id_from_url("job_url", "catsone")),
                "company": company_from_domain("domain"),
                "location": or_remote("location", F.col("is_remote")),
                "job_type": job_type_in_text("description"),
                "category": normalize_category(F.lit(""), "title", "description"),
            }
        ),
        "CATSOne",
        "id_or_drop",
    )


# --- ZohoRecruit ---------------------------------------------------------------------------


def portal_rows(payloads: DataFrame) -> DataFrame:
    """Rows of portal tables: link, best title, and the first two other cells as location."""
    open_pages = payloads.filter(~login_wall("url", "body"))
    rows = F.regexp_extract_all(F.coalesce("body", F.lit("")), F.lit(rules.ZOHO_ROW), F.lit(1))
    df = items(open_pages, rows, F.col("url").alias("_base"))
    anchor = first_group("j", rules.ZOHO_ANCHOR, 1)
    df = df.withColumns(
        {
            "job_url": F.when(anchor != "", resolve("_base", decode_entities(anchor))).otherwise(
                F.get(job_links("j", "_base", "zohorecruit"), F.lit(0))
            ),
            "_cells": table_cells("j"),
            "_anchor": strip_tags(first_group("j", rules.ZOHO_ANCHOR, 2)),
        }
    )
    df = settled(df, "job_url", "_cells").filter(~is_blank("job_url"))
    df = df.withColumn("_title", best_title("_anchor", "_cells"))
    others = F.filter(
        "_cells",
        lambda v: (F.lower(v) != F.lower("_title"))
        & ~v.rlike(rules.JOB_CODE)
        & ~v.rlike(rules.JOB_TYPE_CELL)
        & ~looks_like_date(v),
    )
    df = df.withColumn("_where", F.array_join(others, ", "))
    return cap_per_group(df, ["payload_seq", "job_url"], ["pos"], 1)


def zohorecruit(payloads: DataFrame, details: DataFrame) -> DataFrame:
    """Detail pages with JSON-LD, else their text completed by the portal row; list pages
    without any link can hold JSON-LD postings themselves."""
    pages = context(details).filter(~login_wall("url", "body"))
    pages = pages.select(
        *CONTEXT, F.lit(0).alias("pos"), F.col("url").alias("job_url"), F.col("body").alias("html")
    )
    portal = portal_rows(payloads).select(
        F.col("job_url").alias("_url"), F.col("_title"), F.col("_where"), F.col("payload_seq").alias("_seq")
    )
    portal = cap_per_group(portal, ["_url"], ["_seq"], 1)
    body = F.coalesce("body", F.lit(""))
    listed = body.rlike(rules.JOB_LINK_PATTERNS["zohorecruit"]) | body.rlike(rules.ZOHO_ROW)
    inline = context(payloads).filter(~login_wall("url", "body") & ~listed).select(*CONTEXT, F.lit(0).alias("pos"), F.col("url").alias("job_url"), F.col("body").alias("html"))

    # the first eligible JSON-LD posting of a detail page, and all of a list page
    # (written once: the pages' JSON-LD is read for them and for the pages that are left)
    from_pages = cut_lineage(cap_per_group(_posted(pages), ["payload_seq"], ["pos"], 1), "posted")
    structured = from_pages.unionByName(_posted(inline))
    plain = pages.join(from_pages.select("payload_seq").distinct(), "payload_seq", "left_anti")
    plain = plain.join(portal, plain["job_url"] == portal["_url"], "left")
    plain = plain.withColumns(
        {
            "title": strip_careers_suffix(first_non_empty("_title", clean_text(page_title("html")))),
            "description": page_text("html"),
        }
    )
    plain = plain.withColumn("location", first_non_empty("_where", city_state_in_text("description")))
    plain = plain.withColumn("is_remote", remote_in("zohorecruit", "title", "location"))
    plain = us_or_remote(plain, "title")
    text_jobs = finish(
        plain.withColumns(
            {
                "external_id": scoped_id(99, "zohorecruit", "domain", id_from_url("job_url", "zohorecruit")),
                "company": company_from_domain("domain"),
                "location": or_remote("location", F.col("is_remote")),
                "job_type": job_type_in_text("description"),
                "category": normalize_category(F.lit(""), "title", "description"),
            }
        ),
        "ZohoRecruit",
    )
    return dedupe_source(_finish_posted(structured).unionByName(text_jobs), "id_or_drop")


def _posted(pages: DataFrame) -> DataFrame:
    """Eligible JSON-LD postings of pages, still with their page columns."""
    df = pages.select(
        *CONTEXT, "job_url", F.posexplode(job_postings("html")).alias("pos", "p")
    )
    df = df.withColumns(
        {
            "title": clean_text(_p("title")),
            "description": strip_tags(_p("description")),
            "location": posting_location("p", add_name=True),
        }
    )
    df = df.withColumn(
        "is_remote", remote_in("zohorecruit", _p("jobLocationType"), "location", "title", "description")
    )
    return us_or_remote(df, "title")


def _finish_posted(structured: DataFrame) -> DataFrame:
    ref = first_non_empty(posting_identifier("p"), id_from_url("job_url", "zohorecruit"), "title")
    return finish(
        structured.withColumns(
            {
                "external_id": scoped_id(99, "zohorecruit", "domain", ref),
                "company": first_non_empty(posting_company("p"), company_from_domain("domain")),
                "location": or_remote("location", F.col("is_remote")),
                "job_url": first_non_empty(_p("url"), "job_url"),
                "date_posted": parse_date(_p("datePosted")),
                "job_type": posting_job_type("p"),
                "category": normalize_category(_p("occupationalCategory"), "title", "description"),
            }
        ),
        "ZohoRecruit",
    )

