"""Systems read through RSS or XML feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave import rules
from jobweave.functions.classify import infer_category, personio_remote, remote_in
from jobweave.functions.dates import parse_date
from jobweave.functions.html import (
    clean_text,
    decode_entities_in,
    meta,
    posting_company,
    posting_identifier,
    posting_job_type,
    posting_location,
    strip_tags,
    strip_tags_loose,
    strip_tags_only,
)
from jobweave.functions.ids import plain_id
from jobweave.functions.location import (
    geo_allowed,
    is_us,
    join_places,
    location_in_title,
    location_label,
    or_remote,
)
from jobweave.functions.text import (
    empty_to_null,
    collapse_ws,
    company_after_at,
    company_from_domain,
    contains_any,
    first_non_empty,
    is_blank,
    label_value,
    title_before_at,
    trim_ws,
    zipped,
)
from jobweave.functions.xmlv import xml_elements, xml_record
from jobweave.functions.url import id_from_url, posting_uuid, posting_uuid_in_html
from jobweave.operators.upsert import generated_reference
from jobweave.sources.normalizers.common import finish, fixed, items, payload_of, settled, us_or_remote, with_detail, with_posting
from jobweave.sources.normalizers.lists import successfactors_json

def rss_items(payloads: DataFrame, *fields: str) -> DataFrame:
    """Items of an RSS feed (channel/item) with the named child elements as text."""
    item = ",".join(f"{f}:string" for f in fields)
    parsed = xml_record("body", f"channel struct<item:array<struct<{item}>>>", "rss")
    return items(payloads, parsed["channel"]["item"])


def _j(name: str) -> Column:
    return F.col(f"j.{name}")


def weworkremotely(payloads: DataFrame) -> DataFrame:
    df = rss_items(payloads, "title", "company", "region", "link", "pubDate", "description")
    title = F.coalesce(_j("title"), F.lit(""))
    df = df.withColumn("location", F.coalesce(_j("region"), F.lit("USA")))
    df = df.filter(geo_allowed("location", rules.WWR_GEO))
    return finish(
        df.withColumns(
            {
                "title": title_before_at(title),
                "company": F.coalesce(_j("company"), company_after_at(title)),
                "description": strip_tags_only(F.coalesce(_j("description"), F.lit(""))),
                "job_url": F.coalesce(_j("link"), F.lit("")),
                "is_remote": F.lit(True),
                "date_posted": parse_date(_j("pubDate")),
                # the feed has no posting id; the same item gives the same reference
                "external_id": generated_reference("j.link", "j.title", "j.pubDate"),
            }
        ),
        "WeWorkRemotely",
    )


def successfactors_rss(payloads: DataFrame) -> DataFrame:
    df = rss_items(payloads, "title", "link", "description", "pubDate", "guid")
    df = df.withColumn("description", strip_tags_loose(_j("description")))
    df = df.withColumn("location", F.coalesce(location_label("description"), F.lit("")))
    df = df.filter(is_us("location"))
    return finish(
        df.withColumns(
            {
                "external_id": F.coalesce(id_from_url(_j("link"), "successfactors"), _j("guid")),
                "title": _j("title"),
                "company": F.col("company_name"),
                "job_url": _j("link"),
                "is_remote": contains_any("location", ["remote"]),
                "date_posted": parse_date(_j("pubDate")),
            }
        ),
        "SuccessFactors",
    )


def successfactors(payloads: DataFrame, feeds: DataFrame) -> DataFrame:
    """JSON postings, and RSS postings of the hosts whose JSON form gave none."""
    listed = successfactors_json(payloads)
    hosts = payloads.select("payload_seq", "domain")
    # the payload number sits in the arrival number, so the host needs no second parse
    seen = (
        listed.select(payload_of("seq").alias("payload_seq"))
        .distinct()
        .join(hosts, "payload_seq")
        .select("domain")
        .distinct()
    )
    rest = feeds.join(seen, "domain", "left_anti")
    return listed.unionByName(successfactors_rss(rest))


_POSITION = (
    "id string,name string,office string,additionalOffices string,department string,"
    "recruitingCategory string,occupationCategory string,schedule string,employmentType string,"
    "keywords string,subcompany string,publishedAt string,createdAt string,"
    "jobDescriptions struct<jobDescription:array<struct<name:string,value:string>>>"
)


def personio(payloads: DataFrame) -> DataFrame:
    # the root element's name differs between tenants; the positions are cut out by tag
    found = items(payloads, xml_elements("body", "position")).withColumnRenamed("j", "_xml")
    df = fixed(found, "j", xml_record("_xml", _POSITION, "position"))
    text = lambda f: clean_text(trim_ws(F.coalesce(_j(f), F.lit(""))))
    df = df.withColumns({"_id": trim_ws(F.coalesce(_j("id"), F.lit(""))), "title": text("name")})
    df = settled(df, "_id", "title").filter((F.col("_id") != "") & (F.col("title") != ""))
    df = df.withColumn("location", join_places(F.array(text("office"), text("additionalOffices")), " | "))
    df = us_or_remote(df.withColumn("is_remote", personio_remote("location", "title", text("keywords"))))
    blocks = F.coalesce(_j("jobDescriptions.jobDescription"), F.array())
    plain = decode_entities_in(F.transform(blocks, lambda b: F.regexp_replace(b["value"], rules.ANY_TAG, " ")))
    heads = decode_entities_in(F.transform(blocks, lambda b: b["name"]))
    parts = F.transform(
        zipped(heads, plain, ("n", "v")),
        lambda z: F.when(
            ~is_blank(z["v"]),
            F.concat(
                F.when(is_blank(z["n"]), F.lit("")).otherwise(F.concat(collapse_ws(z["n"]), F.lit(": "))),
                collapse_ws(z["v"]),
            ),
        ),
    )
    return finish(
        df.withColumns(
            {
                "external_id": plain_id(93, "_id"),
                "company": first_non_empty(text("subcompany"), company_from_domain("domain")),
                "location": or_remote("location", F.col("is_remote")),
                "description": F.array_join(F.filter(parts, lambda p: p.isNotNull()), " "),
                "job_url": F.concat(F.lit("https://"), F.col("domain"), F.lit("/job/"), F.col("_id")),
                "date_posted": parse_date(first_non_empty(_j("publishedAt"), _j("createdAt"))),
                "job_type": first_non_empty(text("schedule"), text("employmentType")),
                "category": first_non_empty(
                    text("department"), text("recruitingCategory"), text("occupationCategory")
                ),
            }
        ),
        "Personio",
        "id_first",
    )


def pinpointhq(feeds: DataFrame, details: DataFrame) -> DataFrame:
    """Feed items with their detail pages; a posting needs a page and a UUID."""
    df = rss_items(feeds, "title", "link", "pubDate")
    df = df.withColumns({"_title": clean_text(_j("title")), "job_url": clean_text(_j("link"))})
    df = settled(df, "_title", "job_url").filter((F.col("_title") != "") & (F.col("job_url") != ""))
    df = with_posting(with_detail(df, details, "job_url", "inner"), "detail")
    p = lambda f: F.coalesce(F.col(f"p.{f}"), F.lit(""))
    df = df.withColumns(
        {
            "title": clean_text(first_non_empty(p("title"), "_title")),
            "description": F.coalesce(
                empty_to_null(strip_tags(p("description"))), meta("detail", "description")
            ),
            "location": first_non_empty(posting_location("p", name_first=True), location_in_title("_title")),
            "_uuid": posting_uuid(
                first_non_empty(
                    posting_identifier("p"), posting_uuid_in_html("detail"), id_from_url("job_url", "pinpointhq"),
                    "job_url",
                )
            ),
        }
    )
    remote = remote_in("pinpointhq", "_title", "job_url") | remote_in(
        "pinpointhq", p("jobLocationType"), "location", "title", "description"
    )
    df = us_or_remote(df.withColumn("is_remote", remote), "title", "_uuid")
    label = lambda name: label_value("description", name, stop_at_colon=True)
    return finish(
        df.withColumns(
            {
                "external_id": plain_id(94, "_uuid"),
                "company": first_non_empty(posting_company("p"), company_from_domain("domain")),
                "location": or_remote("location", F.col("is_remote")),
                "date_posted": F.coalesce(parse_date(p("datePosted")), parse_date(clean_text(_j("pubDate")))),
                "job_type": first_non_empty(posting_job_type("p"), label("Employment Type")),
                "category": first_non_empty(
                    label("Department"), p("occupationalCategory"), p("industry"),
                    infer_category("title", "description"),
                ),
            }
        ),
        "PinpointHQ",
        "id_first",
    )

