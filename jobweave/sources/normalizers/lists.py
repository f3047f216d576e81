"""Systems whose list response carries everything (JSON)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave import rules
from jobweave.functions.classify import (
    infer_category,
    infer_job_type,
    jobsoid_remote,
    normalize_job_type,
)
from jobweave.functions.dates import from_epoch_millis, from_epoch_seconds, parse_date
from jobweave.functions.html import (
    clean_text,
    strip_tags,
    strip_tags_loose,
    strip_tags_only,
    strip_tags_plain,
)
from jobweave.functions.ids import plain_id
from jobweave.functions.jsonv import (
    as_items,
    category_metadata,
    compensation,
    job_type_metadata,
    names,
    object_field,
    positional,
    scalar,
    translation,
)
from jobweave.functions.location import country_name, geo_allowed, is_us, join_places, or_remote, place
from jobweave.functions.text import (
    empty_to_null,
    blank_to_null,
    company_from_domain,
    contains_any,
    distinct_ignore_case,
    filled_items,
    first_non_empty,
    is_blank,
    keep_if_filled,
    let,
    trim_ws,
    upper_first,
)
from jobweave.operators.merge import merge_postings
from jobweave.sources.normalizers.common import fixed, finish, items, json_list, us_or_remote


def _struct(*fields: str) -> str:
    return "struct<" + ",".join(f"{f}:string" if ":" not in f else f for f in fields) + ">"


def _t(name: str) -> Column:
    """Scalar text of an item field."""
    return scalar(F.col(f"j.{name}"))


def _has(value, word: str) -> Column:
    return contains_any(value, [word])


def jobicy(payloads: DataFrame) -> DataFrame:
    item = _struct("id", "jobTitle", "companyName", "jobGeo", "jobExcerpt", "url", "jobType", "jobIndustry", "pubDate")
    df = json_list(payloads, item, "jobs")
    return finish(
        df.withColumns(
            {
                "external_id": _t("id"),
                "title": _t("jobTitle"),
                "company": _t("companyName"),
                "location": F.coalesce(_t("jobGeo"), F.lit("Remote")),
                "description": _t("jobExcerpt"),
                "job_url": _t("url"),
                "job_type": _t("jobType"),
                "is_remote": F.lit(True),
                "category": _t("jobIndustry"),
                "date_posted": parse_date(_t("pubDate")),
            }
        ),
        "Jobicy",
    )


def remotive(payloads: DataFrame) -> DataFrame:
    item = _struct("id", "title", "company_name", "candidate_required_location", "description", "url", "job_type",
                   "category", "publication_date")
    df = json_list(payloads, item, "jobs").withColumn(
        "geo", F.coalesce(_t("candidate_required_location"), F.lit(""))
    )
    df = df.filter(geo_allowed("geo", rules.REMOTIVE_GEO))
    text = strip_tags_only(_t("description"))
    text = trim_ws(F.replace(F.replace(text, F.lit("&amp;"), F.lit("&")), F.lit("&nbsp;"), F.lit(" ")))
    return finish(
        df.withColumns(
            {
                "external_id": _t("id"),
                "title": _t("title"),
                "company": _t("company_name"),
                "location": F.when(F.col("geo") == "", F.lit("Remote / USA")).otherwise(F.col("geo")),
                "description": text,
                "job_url": _t("url"),
                "job_type": _t("job_type"),
                "is_remote": F.lit(True),
                "category": _t("category"),
                "date_posted": parse_date(_t("publication_date")),
            }
        ),
        "Remotive",
    )


def arbeitnow(payloads: DataFrame) -> DataFrame:
    item = _struct("slug", "title", "company_name", "location", "description", "url", "remote", "created_at",
                   "tags:array<string>")
    df = json_list(payloads, item, "data")
    return finish(
        df.withColumns(
            {
                "external_id": _t("slug"),
                "title": _t("title"),
                "company": _t("company_name"),
                "location": F.coalesce(_t("location"), F.lit("Remote")),
                "description": _t("description"),
                "job_url": _t("url"),
                "is_remote": F.coalesce(_t("remote") == "true", F.lit(False)),
                "category": F.coalesce(F.array_join("j.tags", ", "), F.lit("")),
                "date_posted": from_epoch_seconds(_t("created_at")),
            }
        ),
        "Arbeitnow",
    )


def greenhouse(payloads: DataFrame) -> DataFrame:
    item = _struct("id", "title", "location", "content", "absolute_url", "updated_at", "employment_type",
                   "employmentType", "job_type", "jobType", "commitment", "type", "category", "department", "team",
                   "function", "departments", "metadata")
    df = json_list(payloads, item, "jobs").withColumn(
        "location", F.coalesce(object_field("j.location", "name"), F.lit(""))
    )
    df = df.filter(is_us("location", include_remote_word=True))
    df = df.withColumn("description", strip_tags_plain(_t("content")))
    stated = first_non_empty(*[_t(f) for f in ("employment_type", "employmentType", "job_type", "jobType", "commitment", "type")])
    in_metadata = job_type_metadata("j.metadata")
    title = F.coalesce(_t("title"), F.lit(""))
    job_type = (
        F.when(stated != "", normalize_job_type(stated))
        .when(in_metadata != "", normalize_job_type(in_metadata))
        .otherwise(infer_job_type(F.concat_ws(" ", title, F.col("description"))))
    )
    category = F.coalesce(
        blank_to_null(first_non_empty(*[_t(f) for f in ("category", "department", "team", "function")])),
        keep_if_filled(names("j.departments")),
        keep_if_filled(category_metadata("j.metadata")),
        infer_category(title, table="board"),
    )
    return finish(
        df.withColumns(
            {
                "external_id": _t("id"),
                "title": _t("title"),
                "company": upper_first(F.coalesce(keep_if_filled("company_name"), F.col("tenant"))),
                "job_url": _t("absolute_url"),
                "is_remote": _has("location", "remote"),
                "date_posted": parse_date(_t("updated_at")),
                "job_type": job_type,
                "category": category,
            }
        ),
        "Greenhouse",
    )


def taleo(payloads: DataFrame) -> DataFrame:
    shape = "struct<fields:array<string>,requisitionList:array<struct<column:array<string>,contestNo:string,jobId:string>>>"
    parsed = F.from_json("body", shape)
    df = items(payloads, parsed["requisitionList"], parsed["fields"].alias("fields"))
    df = fixed(df, "v", positional("fields", F.coalesce(F.col("j.column"), F.array().cast("array<string>"))))
    value = lambda k: F.try_element_at("v", F.lit(k))
    df = df.withColumn("location", F.coalesce(value("location"), value("primarylocation"), F.lit("")))
    df = df.filter(is_us("location"))
    contest = F.coalesce(value("contestno"), _t("contestNo"), _t("jobId"))
    job_id = F.coalesce(F.col("j.jobId"), contest)
    base = F.concat(F.lit("https://"), F.col("tenant"), F.lit(".taleo.net/careersection/"), F.col("site"))
    reference = F.coalesce(contest, job_id)
    url = F.when(
        F.coalesce(job_id, F.lit("")) != "",
        F.concat(base, F.lit("/jobdetail.ftl?job="), reference, F.lit("&lang=en")),
    ).otherwise(F.concat(base, F.lit("/jobsearch.ftl?lang=en")))
    return finish(
        df.withColumns(
            {
                "external_id": reference,
                "title": value("title"),
                "company": F.col("company_name"),
                "description": strip_tags_loose(F.coalesce(value("description"), value("jobdescription"))),
                "job_url": url,
                "is_remote": _has("location", "remote"),
                "date_posted": parse_date(F.coalesce(value("postingdate"), value("posteddate"))),
            }
        ),
        "Taleo",
    )


def lever(payloads: DataFrame) -> DataFrame:
    item = _struct("id", "text", "categories", "workplaceType", "createdAt", "descriptionPlain", "description",
                   "hostedUrl", "applyUrl")
    df = json_list(payloads, item)
    part = lambda f: object_field("j.categories", f)
    df = df.withColumn("location", F.coalesce(part("location"), F.lit("")))
    df = df.withColumn(
        "is_remote", F.coalesce(F.lower(_t("workplaceType")) == "remote", F.lit(False)) | _has("location", "remote")
    )
    df = us_or_remote(df)
    return finish(
        df.withColumns(
            {
                "external_id": _t("id"),
                "title": _t("text"),
                "company": upper_first(F.coalesce(keep_if_filled("company_name"), F.col("tenant"))),
                "description": F.coalesce(_t("descriptionPlain"), strip_tags_loose(_t("description"))),
                "job_url": F.coalesce(_t("hostedUrl"), _t("applyUrl")),
                "date_posted": F.when(F.col("j.createdAt").rlike("^-?[0-9]+$"), from_epoch_millis("j.createdAt")),
                "job_type": part("commitment"),
                "category": part("team"),
            }
        ),
        "Lever",
    )


def ashby(payloads: DataFrame) -> DataFrame:
    item = _struct("id", "title", "isListed", "location", "secondaryLocations", "isRemote", "workplaceType",
                   "descriptionPlain", "descriptionHtml", "description", "compensation", "jobUrl", "applyUrl",
                   "publishedDate", "publishedAt", "createdAt", "updatedAt", "employmentType", "department", "team")
    df = json_list(payloads, item, "jobs").filter(F.coalesce(F.col("j.isListed"), F.lit("true")) != "false")

    def one_place(v: Column) -> Column:
        named = F.coalesce(object_field(v, "name"), object_field(v, "location"))
        return F.when(v.rlike(r"^\s*\{"), named).otherwise(scalar(v))

    others = F.when(
        F.startswith("j.secondaryLocations", F.lit("[")), F.transform(as_items("j.secondaryLocations"), one_place)
    ).otherwise(F.array().cast("array<string>"))
    df = df.withColumn(
        "location", join_places(F.concat(F.array(one_place(F.col("j.location"))), others), ", ")
    )
    df = df.withColumn(
        "is_remote",
        F.coalesce(F.col("j.isRemote") == "true", F.lit(False))
        | _has(_t("workplaceType"), "remote")
        | _has("location", "remote"),
    )
    df = us_or_remote(df)
    text = F.coalesce(_t("descriptionPlain"), strip_tags_loose(F.coalesce(_t("descriptionHtml"), F.lit(""))))
    pay = compensation("j.compensation")
    description = (
        F.when(is_blank(pay), text)
        .when(is_blank(text), pay)
        .otherwise(F.concat(text, F.lit("\n\nCompensation: "), pay))
    )
    both = distinct_ignore_case(filled_items(F.array(_t("department"), _t("team"))))
    posted = F.coalesce(*[_t(f) for f in ("publishedDate", "publishedAt", "createdAt", "updatedAt")])
    return finish(
        df.withColumns(
            {
                "external_id": _t("id"),
                "title": _t("title"),
                "company": F.col("company_name"),
                "description": description,
                "job_url": F.coalesce(_t("jobUrl"), _t("applyUrl")),
                "date_posted": parse_date(posted),
                "job_type": _t("employmentType"),
                "category": F.array_join(both, " / "),
            }
        ),
        "Ashby",
    )


def dayforce(payloads: DataFrame) -> DataFrame:
    item = _struct("ReferenceNumber", "ParentRequisitionCode", "JobId", "Title", "CompanyName", "ParentCompanyName",
                   "City", "State", "Country", "TelecommutePercentage", "Description", "Education", "JobDetailsUrl",
                   "ApplyUrl", "DatePosted", "LastUpdated", "EmploymentIndicator", "JobFunction")
    df = json_list(payloads, item)
    df = df.withColumn("location", place(_t("City"), _t("State"), country_name(_t("Country"))))
    remote = (
        F.coalesce(_t("TelecommutePercentage").try_cast("decimal(18,4)") > 0, F.lit(False))
        | _has("location", "remote")
        | _has(_t("Title"), "remote")
        | _has(_t("Description"), "remote")
    )
    df = us_or_remote(df.withColumn("is_remote", remote))
    parts = distinct_ignore_case(
        filled_items(F.array(strip_tags_loose(_t("Description")), strip_tags_loose(_t("Education"))))
    )
    jobs = finish(
        df.withColumns(
            {
                "external_id": F.coalesce(_t("ReferenceNumber"), _t("ParentRequisitionCode"), _t("JobId")),
                "title": _t("Title"),
                "company": F.coalesce(_t("CompanyName"), _t("ParentCompanyName"), F.col("company_name")),
                "description": F.array_join(parts, "\n\n"),
                "job_url": F.coalesce(_t("JobDetailsUrl"), _t("ApplyUrl")),
                "date_posted": parse_date(F.coalesce(_t("DatePosted"), _t("LastUpdated"))),
                "job_type": _t("EmploymentIndicator"),
                "category": _t("JobFunction"),
            }
        ),
        "Dayforce",
    )
    return merge_postings(jobs)


def recruitee(payloads: DataFrame) -> DataFrame:
    item = _struct("id", "guid", "slug", "title", "sharing_title", "company_name", "location", "city", "state_name",
                   "state_code", "country", "remote", "description", "requirements", "careers_url",
                   "careers_apply_url", "published_at", "created_at", "employment_type_code", "department",
                   "category_code", "translations:map<string,string>", "locations")
    df = json_list(payloads, item, "offers")
    shape = "struct<name:string,city:string,state:string,state_code:string,country:string>"

    def one_place(v: Column) -> Column:
        def read(p: Column) -> Column:
            parts = place(scalar(p["city"]), F.coalesce(scalar(p["state"]), scalar(p["state_code"])), scalar(p["country"]))
            return F.coalesce(keep_if_filled(scalar(p["name"])), parts)

        return F.when(v.rlike(r"^\s*\{"), let(F.from_json(v, shape), read))

    listed = F.when(
        F.startswith("j.locations", F.lit("[")), filled_items(F.transform(as_items("j.locations"), one_place))
    ).otherwise(F.array().cast("array<string>"))
    single = F.coalesce(
        _t("location"), place(_t("city"), F.coalesce(_t("state_name"), _t("state_code")), _t("country"))
    )
    df = df.withColumn("_places", listed).withColumn(
        "location", F.when(F.size("_places") > 0, join_places("_places", "; ")).otherwise(single)
    )
    df = df.withColumn(
        "is_remote",
        F.coalesce(F.col("j.remote") == "true", F.lit(False)) | _has("location", "remote") | _has(_t("title"), "remote"),
    )
    df = us_or_remote(df)
    words = lambda f: strip_tags_loose(F.coalesce(translation("j.translations", f), _t(f)))
    parts = distinct_ignore_case(filled_items(F.array(words("description"), words("requirements"))))
    return finish(
        df.withColumns(
            {
                "external_id": F.coalesce(_t("id"), _t("guid"), _t("slug")),
                "title": F.coalesce(_t("title"), translation("j.translations", "title"), _t("sharing_title")),
                "company": F.coalesce(_t("company_name"), F.col("company_name")),
                "description": F.array_join(parts, "\n\n"),
                "job_url": F.coalesce(_t("careers_url"), _t("careers_apply_url")),
                "date_posted": parse_date(F.coalesce(_t("published_at"), _t("created_at"))),
                "job_type": _t("employment_type_code"),
                "category": F.coalesce(_t("department"), _t("category_code")),
            }
        ),
        "Recruitee",
    )


def jobsoid(payloads: DataFrame) -> DataFrame:
    where = "struct<title:string,city:string,state:string,country:string>"
    item = _struct("id", "title", "company", f"location:{where}", "function:struct<title:string>",
                   "department:struct<title:string>", "industry", "type", "description", "hostedUrl", "postedDate")
    df = json_list(payloads, item).withColumn("title", clean_text("j.title"))
    df = df.filter(~is_blank("j.id") & (F.col("title") != ""))
    part = lambda f: clean_text(F.col(f"j.location.{f}"))
    df = df.withColumns({f"_{f}": part(f) for f in ("title", "city", "state", "country")})
    shown = ~is_blank("_title") & ~F.contains("_title", F.lit(" - "))
    df = df.withColumns(
        {
            "location": F.when(shown, F.col("_title")).otherwise(place("_city", "_state", "_country")),
            "job_type": clean_text("j.type"),
            "description": strip_tags("j.description"),
        }
    )
    df = us_or_remote(df.withColumn("is_remote", jobsoid_remote("job_type", "title", "description", "_country")))
    own = F.concat(F.lit("https://"), F.col("domain"), F.lit("/j/"), F.col("j.id"))
    return finish(
        df.withColumns(
            {
                "external_id": plain_id(91, "j.id"),
                "company": first_non_empty(clean_text("j.company"), company_from_domain("domain")),
                "location": or_remote("location", F.col("is_remote")),
                "job_url": first_non_empty("j.hostedUrl", own),
                "date_posted": parse_date("j.postedDate"),
                "category": F.coalesce(
                    keep_if_filled(clean_text("j.function.title")),
                    keep_if_filled(clean_text("j.department.title")),
                    clean_text("j.industry"),
                ),
            }
        ),
        "Jobsoid",
        "id_first",
    )


def successfactors_json(payloads: DataFrame) -> DataFrame:
    """The JSON form: the list at the root, or under jobs, results or data.jobs."""
    item = _struct("title", "jobTitle", "name", "location", "jobLocation", "city", "jobId", "id", "reqId",
                   "requisitionId", "url", "jobUrl", "applyUrl", "description", "jobDescription", "postedDate",
                   "postingDate", "datePosted")
    body = F.ltrim("body")
    root = F.from_json(F.when(F.startswith(body, F.lit("[")), body), f"array<{item}>")
    nested = F.from_json(
        F.when(F.startswith(body, F.lit("{")), body),
        f"struct<jobs:array<{item}>,results:array<{item}>,data:struct<jobs:array<{item}>>>",
    )
    df = items(payloads, F.coalesce(root, nested["jobs"], nested["results"], nested["data"]["jobs"]))
    first = lambda *fs: F.coalesce(*[_t(f) for f in fs])
    df = df.withColumn("location", F.coalesce(first("location", "jobLocation", "city"), F.lit("")))
    df = df.filter(is_us("location"))
    ref = first("jobId", "id", "reqId", "requisitionId")
    own = F.concat(F.lit("https://"), F.col("domain"), F.lit("/careers/job/"), ref)
    return finish(
        df.withColumns(
            {
                "external_id": ref,
                "title": first("title", "jobTitle", "name"),
                "company": F.col("company_name"),
                "description": strip_tags_loose(first("description", "jobDescription")),
                "job_url": F.coalesce(empty_to_null(first("url", "jobUrl", "applyUrl")), own),
                "is_remote": _has("location", "remote"),
                "date_posted": parse_date(first("postedDate", "postingDate", "datePosted")),
            }
        ),
        "SuccessFactors",
    )

