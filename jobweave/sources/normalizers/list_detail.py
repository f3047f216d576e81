"""Systems with a JSON list and one detail response per posting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave.functions.classify import infer_category, is_it, normalize_category, remote_in
from jobweave.functions.dates import parse_date
from jobweave.functions.html import (
    clean_text,
    decode_entities_in,
    meta,
    posting_job_type,
    posting_location,
    strip_tags,
)
from jobweave.functions.ids import scoped_id, site_scoped_id
from jobweave.functions.jsonv import as_items, id_name_map, object_field, scalar, sections_text
from jobweave.functions.location import country_name, is_us, join_places, or_remote, place
from jobweave.functions.text import (
    empty_to_null,
    collapse_ws,
    company_from_domain,
    contains_any,
    distinct_ignore_case,
    filled_items,
    first_non_empty,
    is_blank,
    keep_if_filled,
    let,
    trim_ws,
    zipped,
)
from jobweave.functions.url import domain_from_url, oracle_detail_url, oracle_job_url
from jobweave import rules
from jobweave.sources.normalizers.common import finish, fixed, items, json_list, settled, us_or_remote, with_detail, with_posting
from jobweave.sources.normalizers.lists import _struct, _t


def _https(*parts) -> Column:
    return F.concat(F.lit("https://"), *[F.lit(p) if isinstance(p, str) else p for p in parts])


# --- SmartRecruiters ------------------------------------------------------------------

_SR = (
    "struct<id:string,uuid:string,ref:string,name:string,location:string,department:string,`function`:string,"
    "typeOfEmployment:string,company:string,postingUrl:string,applyUrl:string,releasedDate:string,"
    "jobAd:struct<sections:map<string,struct<title:string,text:string>>>>"
)


def _sr_location(v: Column) -> Column:
    part = lambda f: object_field(v, f)
    built = place(part("city"), part("region"), country_name(part("country"), aliases=("us",)))
    return F.coalesce(keep_if_filled(part("fullLocation")), built, F.lit(""))


def _sr_remote(v: Column, location) -> Column:
    return F.coalesce(object_field(v, "remote") == "true", F.lit(False)) | contains_any(location, ["remote"])


def smartrecruiters(payloads: DataFrame, details: DataFrame) -> DataFrame:
    """US or remote is tested on the listing first, and again on the detail."""
    df = json_list(payloads, _SR, "content").withColumn("location", _sr_location(F.col("j.location")))
    df = us_or_remote(df.withColumn("is_remote", _sr_remote(F.col("j.location"), "location")))
    built = _https(
        "api.smartrecruiters.com/v1/companies/", F.url_encode("tenant"), F.lit("/postings/"),
        F.url_encode(F.coalesce(_t("id"), _t("uuid"))),
    )
    df = df.withColumn("_detail_url", F.coalesce(keep_if_filled(_t("ref")), built))
    df = with_detail(df, details, "_detail_url").withColumnRenamed("j", "_listed")
    df = fixed(df, "j", F.coalesce(F.from_json("detail", _SR), F.col("_listed")))
    df = df.withColumn("location", _sr_location(F.col("j.location")))
    df = us_or_remote(df.withColumn("is_remote", _sr_remote(F.col("j.location"), "location")))
    # section texts are decoded as one array, outside the higher-order function
    sections = F.coalesce(F.col("j.jobAd.sections"), F.create_map().cast("map<string,struct<title:string,text:string>>"))
    texts = decode_entities_in(
        F.transform(F.map_values(sections), lambda s: F.regexp_replace(s["text"], rules.ANY_TAG, " "))
    )
    rebuilt = F.map_from_arrays(
        F.map_keys(sections),
        F.transform(
            zipped(F.map_values(sections), texts, ("s", "t")),
            lambda z: F.named_struct(F.lit("title"), z["s"]["title"], F.lit("text"), z["t"]),
        ),
    )
    labels = distinct_ignore_case(
        filled_items(F.array(object_field("j.department", "label"), object_field("j.function", "label")))
    )
    return finish(
        df.withColumns(
            {
                "external_id": F.coalesce(_t("uuid"), _t("id")),
                "title": _t("name"),
                "company": F.coalesce(object_field("j.company", "name"), F.col("company_name")),
                "description": sections_text(
                    rebuilt, lambda t: trim_ws(F.regexp_replace(F.coalesce(t, F.lit("")), r"\s{2,}", " "))
                ),
                "job_url": F.coalesce(_t("postingUrl"), _t("applyUrl"), _t("ref")),
                "date_posted": parse_date(_t("releasedDate")),
                "job_type": object_field("j.typeOfEmployment", "label"),
                "category": F.array_join(labels, " / "),
            }
        ),
        "SmartRecruiters",
    )


# --- OracleCloud ------------------------------------------------------------------------

_FACET = "array<struct<Id:string,Name:string>>"
_REQ = _struct("Id", "Title", "Category", "JobFamilyId", "JobFunction", "JobFamily", "WorkplaceType",
               "WorkplaceTypeCode", "PrimaryLocation", "PostedDate", "JobSchedule", "JobType", "WorkerType",
               "ContractType", "ShortDescriptionStr")
_PLACES = "array<struct<Name:string,LocationName:string,PrimaryLocation:string,WorkLocation:string>>"
_DETAIL = _struct("ExternalDescriptionStr", "ExternalResponsibilitiesStr", "ExternalQualificationsStr",
                  "CorporateDescriptionStr", "PrimaryLocation", "WorkplaceType", "WorkplaceTypeCode", "Organization",
                  "LegalEmployer", "BusinessUnit", "Category", "JobFunction", "JobSchedule", "JobType", "WorkerType",
                  "ContractType", "ExternalPostedStartDate", f"secondaryLocations:{_PLACES}",
                  f"otherWorkLocations:{_PLACES}", f"workLocation:{_PLACES}")


def oraclecloud(payloads: DataFrame, details: DataFrame) -> DataFrame:
    """``site`` and ``domain`` of a list payload name the career site."""
    search = F.from_json(
        "body",
        "struct<items:array<struct<TotalJobsCount:string,organizationsFacet:" + _FACET + ",categoriesFacet:"
        + _FACET + ",requisitionList:array<" + _REQ + ">>>>",
    )
    one = F.get(search["items"], F.lit(0))
    df = items(
        payloads, one["requisitionList"],
        F.get(one["organizationsFacet"], F.lit(0))["Name"].alias("_org"),
        id_name_map(one["categoriesFacet"]).alias("_categories"),
    )
    j = lambda f: F.col(f"j.{f}")
    text = lambda f: clean_text(j(f))
    df = df.withColumns({"_id": text("Id"), "title": text("Title"), "_workplace": text("WorkplaceType")})
    df = settled(df, "_id", "title").filter((F.col("_id") != "") & (F.col("title") != ""))
    family = clean_text(F.try_element_at("_categories", F.lower(F.coalesce(j("JobFamilyId"), F.lit("")))))
    df = df.withColumns(
        {
            "location": first_non_empty(text("PrimaryLocation"), "_workplace"),
            "_category": first_non_empty(text("Category"), family, text("JobFunction"), text("JobFamily")),
            "_company": first_non_empty(clean_text("_org"), company_from_domain("domain")),
            "_short": strip_tags(j("ShortDescriptionStr")),
            "_type": first_non_empty(*[j(f) for f in ("JobSchedule", "JobType", "WorkerType", "ContractType")]),
        }
    )
    df = df.withColumn("is_remote", remote_in("oraclecloud", "_workplace", j("WorkplaceTypeCode"), "title", "location"))
    df = us_or_remote(df.withColumn("location", or_remote("location", F.col("is_remote"))))
    df = df.withColumn("_detail_url", oracle_detail_url("domain", "site", "_id"))
    df = with_detail(df, details, "_detail_url")
    df = fixed(df, "d", F.get(F.from_json("detail", f"struct<items:array<{_DETAIL}>>")["items"], F.lit(0)))
    d = lambda f: F.coalesce(F.col(f"d.{f}"), F.lit(""))
    long_text = strip_tags(
        F.concat_ws(
            " ",
            *[
                keep_if_filled(d(f))
                for f in (
                    "ExternalDescriptionStr", "ExternalResponsibilitiesStr", "ExternalQualificationsStr",
                    "CorporateDescriptionStr",
                )
            ],
        )
    )
    child = lambda f: F.coalesce(F.col(f"d.{f}"), F.array().cast(_PLACES))
    named = F.transform(
        F.concat(child("secondaryLocations"), child("otherWorkLocations"), child("workLocation")),
        lambda p: first_non_empty(p["Name"], p["LocationName"], p["PrimaryLocation"], p["WorkLocation"]),
    )
    every = F.transform(decode_entities_in(F.concat(F.array(d("PrimaryLocation")), named)), collapse_ws)
    df = df.withColumns(
        {
            "_long": long_text,
            "location": first_non_empty(join_places(every, " | "), "location"),
        }
    )
    df = df.withColumn(
        "is_remote",
        F.col("is_remote")
        | remote_in("oraclecloud", first_non_empty(d("WorkplaceType"), d("WorkplaceTypeCode")), "location", "_long"),
    )
    df = us_or_remote(df)
    dt = lambda f: clean_text(d(f))
    return finish(
        df.withColumns(
            {
                "external_id": site_scoped_id(95, "domain", "site", "_id"),
                "company": first_non_empty(dt("Organization"), dt("LegalEmployer"), dt("BusinessUnit"), "_company"),
                "location": or_remote("location", F.col("is_remote")),
                "description": first_non_empty("_long", "_short"),
                "job_url": oracle_job_url("domain", "site", "_id"),
                "date_posted": F.coalesce(parse_date(d("ExternalPostedStartDate")), parse_date(j("PostedDate"))),
                "job_type": first_non_empty(
                    dt("JobSchedule"), dt("JobType"), dt("WorkerType"), dt("ContractType"), "_type"
                ),
                "category": first_non_empty(dt("Category"), dt("JobFunction"), "_category"),
            }
        ),
        "OracleCloud",
        "id_first",
    )


# --- BambooHR -----------------------------------------------------------------------------

_BAMBOO_PLACE = "struct<city:string,state:string,addressCountry:string>"


def _bamboo_place(v: str) -> Column:
    return F.coalesce(
        place(F.col(f"{v}.city"), F.col(f"{v}.state"), F.col(f"{v}.addressCountry")), F.lit("")
    )


def bamboohr(payloads: DataFrame, details: DataFrame) -> DataFrame:
    """A posting without a readable detail response is dropped."""
    item = _struct("id", "jobOpeningName", "departmentLabel", "employmentStatusLabel", "isRemote", "locationType",
                   f"location:{_BAMBOO_PLACE}")
    opening = _struct("jobOpeningName", "description", "departmentLabel", "employmentStatusLabel", "isRemote",
                      "locationType", "jobOpeningShareUrl", "datePosted", f"location:{_BAMBOO_PLACE}")
    df = json_list(payloads, item, "result")
    df = df.filter(~is_blank("j.id") & ~is_blank("j.jobOpeningName"))
    df = df.withColumns({"_id": F.col("j.id"), "_where": _bamboo_place("j.location")})
    df = df.withColumn(
        "_remote", remote_in("bamboohr", "j.isRemote", "j.locationType", "j.jobOpeningName", "_where")
    )
    df = df.withColumn("_detail_url", _https(F.col("domain"), F.lit("/careers/"), F.col("_id"), F.lit("/detail")))
    df = with_detail(df, details, "_detail_url", "inner")
    df = fixed(df, "d", F.from_json("detail", f"struct<result:struct<jobOpening:{opening}>>")["result"]["jobOpening"])
    df = df.filter(F.col("d").isNotNull())
    d = lambda f: F.col(f"d.{f}")
    df = df.withColumns(
        {
            "title": first_non_empty(clean_text(d("jobOpeningName")), clean_text("j.jobOpeningName")),
            "description": strip_tags(d("description")),
            "location": first_non_empty(_bamboo_place("d.location"), "_where"),
            "_listed_category": clean_text("j.departmentLabel"),
        }
    )
    df = df.withColumn(
        "is_remote",
        F.col("_remote")
        | remote_in("bamboohr", d("isRemote"), d("locationType"), "title", "location", "description"),
    )
    df = us_or_remote(df, "title")
    inferred = F.when(
        is_it("title", "_listed_category"), infer_category("title", "description", "bamboo")
    ).otherwise("")
    return finish(
        df.withColumns(
            {
                "external_id": scoped_id(96, "bamboohr", "domain", "_id"),
                "company": company_from_domain("domain"),
                "location": or_remote("location", F.col("is_remote")),
                "job_url": first_non_empty(
                    d("jobOpeningShareUrl"), _https(F.col("domain"), F.lit("/careers/"), F.col("_id"))
                ),
                "date_posted": parse_date(d("datePosted")),
                "job_type": first_non_empty(clean_text(d("employmentStatusLabel")), clean_text("j.employmentStatusLabel")),
                "category": first_non_empty(clean_text(d("departmentLabel")), "_listed_category", inferred),
            }
        ),
        "BambooHR",
        "id_first",
    )


# --- ApplicantPro --------------------------------------------------------------------------

_AP = _struct("id", "title", "jobLocation", "city", "abbreviation", "iso3", "jobUrl", "startDateRef",
              "employmentType", "jobCategory", "customCategory", "classification", "orgTitle", "workplaceType",
              "description", "advertisingDescriptionHtml", "advertisingDescription")


def _ap_location(v: str) -> Column:
    return first_non_empty(
        clean_text(f"{v}.jobLocation"), clean_text(place(f"{v}.city", f"{v}.abbreviation", f"{v}.iso3"))
    )


def _ap_category(v: str) -> Column:
    return first_non_empty(*[f"{v}.{f}" for f in ("jobCategory", "customCategory", "classification", "orgTitle")])


def applicantpro(payloads: DataFrame, details: DataFrame) -> DataFrame:
    """``site`` of a list payload is the numeric site id."""
    df = json_list(payloads, _AP, "data", "jobs").withColumn("_title", clean_text("j.title"))
    df = settled(df, "_title").filter(~is_blank("j.id") & (F.col("_title") != ""))
    df = df.withColumn("_where", _ap_location("j"))
    df = df.withColumns(
        {
            "_remote": remote_in("applicantpro", "j.workplaceType", "_where", "_title"),
            "job_url": first_non_empty("j.jobUrl", _https(F.col("domain"), F.lit("/jobs/"), F.col("j.id"))),
            "_detail_url": _https(
                F.col("domain"), F.lit("/core/jobs/"), F.col("site"), F.lit("/"), F.col("j.id"), F.lit("/job-details")
            ),
        }
    )
    df = with_detail(df, details, "_detail_url")
    df = fixed(df, "d", F.from_json("detail", f"struct<data:{_AP}>")["data"])
    df = df.withColumns(
        {
            "title": clean_text(first_non_empty("d.title", "_title")),
            "location": clean_text(first_non_empty(_ap_location("d"), "_where")),
            "description": strip_tags(
                first_non_empty("d.description", "d.advertisingDescriptionHtml", "d.advertisingDescription")
            ),
        }
    )
    df = df.withColumn(
        "is_remote",
        F.col("_remote")
        | (F.col("d").isNotNull() & remote_in("applicantpro", "d.workplaceType", "location", "title", "description")),
    )
    df = us_or_remote(df)
    return finish(
        df.withColumns(
            {
                "external_id": scoped_id(97, "applicantpro", "domain", "j.id"),
                "company": company_from_domain("domain"),
                "location": or_remote("location", F.col("is_remote")),
                "date_posted": F.coalesce(parse_date("d.startDateRef"), parse_date("j.startDateRef")),
                "job_type": clean_text(first_non_empty("d.employmentType", clean_text("j.employmentType"))),
                "category": clean_text(
                    first_non_empty(
                        _ap_category("d"), _ap_category("j"),
                        normalize_category(F.lit(""), "title", "description"),
                    )
                ),
            }
        ),
        "ApplicantPro",
        "id_or_drop",
    )


# --- BreezyHR ------------------------------------------------------------------------------

_BREEZY = _struct("id", "friendly_id", "name", "url", "location", "locations", "remote_details", "type", "department",
                  "company", "published_date")


def _breezy_place(v: Column) -> Column:
    shape = "struct<name:string,city:string,country:struct<id:string,name:string>,state:struct<id:string,name:string>>"

    def inside(p: Column) -> Column:
        built = place(
            p["city"], first_non_empty(p["state"]["name"], p["state"]["id"]),
            first_non_empty(p["country"]["name"], p["country"]["id"]),
        )
        return F.coalesce(keep_if_filled(collapse_ws(p["name"])), built)

    return F.when(v.rlike(r"^\s*\{"), let(F.from_json(v, shape), inside)).otherwise(collapse_ws(scalar(v)))


def breezyhr(payloads: DataFrame, details: DataFrame) -> DataFrame:
    """The page's JSON-LD completes the listed posting; without a page the listing stands."""
    df = json_list(payloads, _BREEZY).withColumn("_title", clean_text("j.name"))
    df = settled(df, "_title").filter(~is_blank("j.id") & (F.col("_title") != ""))
    many = F.when(F.startswith("j.locations", F.lit("[")), F.transform(as_items("j.locations"), _breezy_place))
    several = join_places(decode_entities_in(many), " | ")
    df = df.withColumn(
        "_where",
        F.coalesce(empty_to_null(several), clean_text(_breezy_place(F.col("j.location")))),
    )
    company = F.when(F.startswith("j.company", F.lit("{")), F.get_json_object("j.company", "$.name"))
    kind = F.when(
        F.startswith("j.type", F.lit("{")),
        first_non_empty(F.get_json_object("j.type", "$.name"), F.get_json_object("j.type", "$.id")),
    ).otherwise(F.col("j.type"))
    df = df.withColumns(
        {
            "_remote": remote_in("breezyhr", "_title", "_where", "j.remote_details", "j.location", "j.locations"),
            "job_url": first_non_empty(
                "j.url",
                _https(F.col("domain"), F.lit("/p/"), F.coalesce("j.friendly_id", F.lit(""))),
            ),
            "company": first_non_empty(clean_text(company), company_from_domain("domain")),
            "_type": clean_text(kind),
            "_department": clean_text("j.department"),
        }
    )
    df = settled(df, "_where", "_remote").filter(is_us("_where") | F.col("_remote"))
    df = with_posting(with_detail(df, details, "job_url"), "detail")
    p = lambda f: F.coalesce(F.col(f"p.{f}"), F.lit(""))
    df = df.withColumns(
        {
            "title": first_non_empty(p("title"), "_title"),
            "description": F.coalesce(
                empty_to_null(strip_tags(p("description"))), meta("detail", "description")
            ),
            "location": first_non_empty(posting_location("p", add_name=True), "_where"),
        }
    )
    df = df.withColumn(
        "is_remote",
        F.col("_remote")
        | (F.col("detail").isNotNull() & remote_in("breezyhr", p("jobLocationType"), "location", "title", "description")),
    )
    df = us_or_remote(df)
    inferred = F.when(F.col("detail").isNotNull(), infer_category("title", "description"))
    return finish(
        df.withColumns(
            {
                "external_id": scoped_id(98, "breezyhr", domain_from_url("job_url"), "j.id"),
                "location": or_remote("location", F.col("is_remote")),
                "date_posted": F.coalesce(parse_date(p("datePosted")), parse_date("j.published_date")),
                "job_type": first_non_empty(posting_job_type("p"), "_type"),
                "category": first_non_empty("_department", p("occupationalCategory"), p("industry"), inferred),
            }
        ),
        "BreezyHR",
        "id_first",
    )
