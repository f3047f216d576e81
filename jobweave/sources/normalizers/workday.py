"""Workday: list pages, detail responses, and the archive export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave.functions.classify import availability, it_score, remote_in
from jobweave.functions.dates import relative_date
from jobweave.functions.html import strip_tags
from jobweave.functions.ids import prefer_detail_reference, workday_reference
from jobweave.functions.jsonv import scalar, text_or_descriptor
from jobweave.functions.location import is_us, or_remote
from jobweave.functions.text import (
    company_from_tenant,
    first_non_empty,
    is_blank,
    keep_if_filled,
    trim_ws,
)
from jobweave.functions.url import workday_api_url, workday_detail_url, workday_job_url
from jobweave.schema import EXPORT_COLUMNS
from jobweave.operators.dedupe import cap_per_group
from jobweave.sources.normalizers.common import finish, fixed, json_list, settled, us_or_remote, with_detail
from jobweave.sources.normalizers.lists import _struct, _t

_POSTING = _struct("title", "externalPath", "locationsText", "location", "postedOn", "startDate", "jobReqId",
                   "timeType", "employmentType", "workerSubType", "jobFamily", "jobFamilyGroup", "jobProfile",
                   "workplaceType", "remoteType", "jobType", "bulletFields:array<string>")
_INFO_FIELDS = ("title", "jobReqId", "id", "jobDescription", "timeType", "employmentType", "workerSubType",
                "startDate", "postedOn")
_DETAIL = f"struct<jobPostingInfo:{_struct(*_INFO_FIELDS)}," + ",".join(f"{f}:string" for f in _INFO_FIELDS) + ">"


def category_of(j: str = "j") -> Column:
    """First filled job-family field, else the bullets joined with ' | '."""
    fields = ("jobFamily", "jobFamilyGroup", "jobProfile", "workerSubType", "employmentType")
    named = [F.when(~is_blank(scalar(f"{j}.{f}")), trim_ws(scalar(f"{j}.{f}"))) for f in fields]
    bullets = F.filter(F.col(f"{j}.bulletFields"), lambda b: ~is_blank(b))
    return F.coalesce(*named, F.array_join(bullets, " | "), F.lit(""))


def _listed(payloads: DataFrame) -> DataFrame:
    df = json_list(payloads, _POSTING, "jobPostings")
    path = F.coalesce(_t("externalPath"), F.lit(""))
    df = df.withColumns(
        {
            "external_path": path,
            "title": F.coalesce(_t("title"), F.lit("")),
            "location": F.coalesce(_t("locationsText"), _t("location"), F.lit("")),
            "category": category_of(),
        }
    )
    words = [_t(f) for f in ("workplaceType", "remoteType", "jobType")]
    return df.withColumns(
        {
            "is_remote": remote_in("workday", "location", *words),
            "job_url": workday_job_url("domain", "site", "external_path"),
            "detail_api_url": workday_detail_url("domain", "tenant", "site", "external_path"),
            "_reference": workday_reference(
                _t("jobReqId"), "category", "external_path", "domain", "tenant", "site", _t("title")
            ),
        }
    )


def _from_detail(field: str, typed: bool = False) -> list[Column]:
    read = text_or_descriptor if typed else scalar
    return [read(F.col(f"d.jobPostingInfo.{field}")), read(F.col(f"d.{field}"))]


def _detail_type() -> Column:
    kinds = ("timeType", "employmentType", "workerSubType")
    return first_non_empty(
        *[_from_detail(f, True)[0] for f in kinds], *[_from_detail(f, True)[1] for f in kinds]
    )


def _detail_description() -> Column:
    inside, outside = _from_detail("jobDescription")
    return strip_tags(F.coalesce(keep_if_filled(inside), outside, F.lit("")))


def _detail_reference(level: int) -> Column:
    return first_non_empty(_from_detail("jobReqId")[level], _from_detail("id")[level])


def _detail_date(as_of, level: int) -> Column:
    return relative_date(
        first_non_empty(_from_detail("startDate")[level], _from_detail("postedOn")[level]), as_of
    )


def workday(payloads: DataFrame, details: DataFrame, as_of="1970-01-01") -> DataFrame:
    """US or remote postings; the detail fills description, type, date and reference.

    ``as_of`` is the day relative dates count from, usually the capture day.
    """
    df = us_or_remote(settled(_listed(payloads), "title").filter(~is_blank("title")))
    df = fixed(with_detail(df, details, "detail_api_url"), "d", F.from_json("detail", _DETAIL))
    reference = first_non_empty(_detail_reference(0), _detail_reference(1))
    listed_date = relative_date(first_non_empty(_t("startDate"), _t("postedOn")), as_of)
    return finish(
        df.withColumns(
            {
                "external_id": prefer_detail_reference("_reference", reference),
                "company": company_from_tenant("tenant", "domain"),
                "location": or_remote("location", F.col("is_remote")),
                "description": _detail_description(),
                "date_posted": F.coalesce(listed_date, _detail_date(as_of, 0), _detail_date(as_of, 1)),
                "job_type": first_non_empty(F.coalesce(_t("timeType"), _t("employmentType")), _detail_type()),
            }
        ),
        "Workday",
        "url_first",
    )


def workday_tenants(payloads: DataFrame, details: DataFrame, as_of="1970-01-01") -> DataFrame:
    """The older per-tenant form: every posting, dates from the detail first."""
    df = with_detail(_listed(payloads), details, "detail_api_url")
    df = fixed(df, "d", F.from_json("detail", _DETAIL))
    info = lambda f: scalar(F.col(f"d.jobPostingInfo.{f}"))
    posted = first_non_empty(info("startDate"), _t("startDate"), info("postedOn"), _t("postedOn"))
    return finish(
        df.withColumns(
            {
                "external_id": _t("jobReqId"),
                "company": F.col("company_name"),
                "description": strip_tags(F.coalesce(info("jobDescription"), F.lit(""))),
                "is_remote": F.contains(F.lower("location"), F.lit("remote")),
                "date_posted": relative_date(posted, as_of),
                "job_type": first_non_empty(_t("timeType"), info("timeType"), info("employmentType")),
                "category": F.lit(None).cast("string"),
            }
        ),
        "Workday",
    )


def workday_export(payloads: DataFrame, details: DataFrame, as_of="1970-01-01",
                   index_id: str = "") -> DataFrame:
    """Every listed posting with flags and the status of its detail response (29 columns).

    ``details`` keeps failed captures: their status says why a posting is gone.
    """
    df = _listed(payloads)
    one = cap_per_group(
        details.select("url", "payload_seq", "status_code", "body"), ["url"], ["payload_seq"], 1
    )
    right = one.select(
        F.col("url").alias("_url"), F.col("status_code").cast("string").alias("_status"), F.col("body").alias("detail")
    )
    df = df.join(right, df["detail_api_url"] == right["_url"], "left").drop("_url")
    readable = F.when(F.col("_status").rlike("^2"), F.col("detail"))
    df = fixed(df, "d", F.from_json(readable, _DETAIL))
    # from_json gives an all-NULL struct for a broken body; such a body is an error
    broken = F.col("_status").rlike("^2") & F.try_parse_json("detail").isNull()
    has_posting = F.when(~broken, F.col("d.jobPostingInfo").isNotNull())
    df = df.withColumn(
        "availability_status", availability("_status", has_posting, scalar(F.col("d.jobPostingInfo.title")))
    )
    reference = prefer_detail_reference("_reference", _detail_reference(0))
    df = df.withColumn("_reference1", reference)
    df = df.withColumns(
        {
            "description": F.coalesce(_detail_description(), F.lit("")),
            "job_type": first_non_empty(F.coalesce(_t("timeType"), _t("employmentType")), _detail_type()),
            "job_reference": prefer_detail_reference("_reference1", _detail_reference(1)),
            "_date": F.coalesce(
                relative_date(first_non_empty(_t("startDate"), _t("postedOn")), as_of),
                _detail_date(as_of, 0), _detail_date(as_of, 1),
            ),
        }
    )
    flag = lambda c: F.when(c, F.lit("True")).otherwise("False")
    score = it_score("title", "category", "description")
    values = {
        "source": F.lit("workday_commoncrawl"),
        "source_id": F.lit("99"),
        "wd_server": F.split_part("domain", F.lit("."), F.lit(2)),
        "api_url": workday_api_url("domain", "tenant", "site"),
        "company": company_from_tenant("tenant", "domain"),
        "is_us": flag(is_us("location")),
        "is_remote": flag(F.col("is_remote")),
        "date_posted": F.coalesce(F.date_format("_date", "yyyy-MM-dd"), F.lit("")),
        "detail_status_code": F.coalesce("_status", F.lit("")),
        "still_available": flag(F.col("availability_status") == "live"),
        "is_it": flag(score > 0),
        "it_score": score.cast("string"),
        "description_length": F.when(is_blank("description"), F.lit("0")).otherwise(
            F.length("description").cast("string")
        ),
        "commoncrawl_index": F.lit(index_id),
        "commoncrawl_url": F.lit(""),
        "error": F.when(F.col("_status").isNull(), F.lit("no detail response")).otherwise(""),
    }
    return df.select(*[values.get(c, F.col(c)).alias(c) for c in EXPORT_COLUMNS])
