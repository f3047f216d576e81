"""Payload normalisers over payloads rendered from the jobs-like view.

Each posting becomes one captured response in the shape of a system; the SQL twin says what
the standard record must hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave import rules
from jobweave.functions.url import oracle_detail_url
from jobweave.queries.base import (
    q, query, s_any, s_blank, s_category, s_digest, s_is_us, s_it_score, s_match, s_rules, table,
)
from jobweave.queries.jobsview import JOBS_CTE, jobs
from jobweave.operators import reports
from jobweave.operators.rows import settled
from jobweave.schema import EXPORT_COLUMNS, PAYLOADS, conform
from jobweave.plans import export
from jobweave.sources import registry
from jobweave.sources.catalog_csv import read_catalog_csv
from jobweave.sources.normalizers import feeds, html_pages, list_detail, lists, workday
from jobweave.sources.normalizers.common import payload_of
from jobweave.sources.payloads import read_payloads, read_text_payloads
from jobweave.session import shared_folder

J = "WITH " + JOBS_CTE
US = s_is_us("location")
AS_OF = "2024-06-01"


def payloads(df: DataFrame, body: Column, url: Column | None = None, status=200, site=None, domain="d.example.com",
             source="x", kind="list") -> DataFrame:
    """One captured response per row; the arrival number is the row's seq."""
    text = lambda v: v if isinstance(v, Column) else F.lit(v)
    return conform(
        settled(df.select(
            F.col("seq").alias("payload_seq"), text(source).alias("source"), F.lit("acme-corp").alias("tenant"),
            text(site or "CX").alias("site"), text(domain).alias("domain"), F.lit("Acme").alias("company"),
            (url if url is not None else F.lit("https://d.example.com/list")).alias("url"), text(kind).alias("kind"),
            F.lit(1).alias("attempt"), text(status).alias("status_code"), body.alias("body"),
        ), "body"),
        PAYLOADS,
    )


def js(**fields) -> Column:
    return F.struct(*[(v if isinstance(v, Column) else F.col(v)).alias(k) for k, v in fields.items()])


def one(path: str, item: Column) -> Column:
    """JSON body with a one-item list under ``path`` (or at the root)."""
    value = F.array(item)
    for name in reversed(path.split(".")) if path else []:
        value = F.struct(value.alias(name))
    return F.to_json(value)


def out(df: DataFrame, *columns: str) -> DataFrame:
    """Posting number (from the arrival number) and the compared columns."""
    n = payload_of("seq").alias("n")
    return df.select(n, *columns)


def day(fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format("date_posted", fmt)


def lit(v: str | None) -> Column:
    return F.lit(v).cast("string")


def norm(name: str, sql: str, columns: list[str]):
    """Register norm_<name>; the function returns standard postings."""

    def add(fn):
        query(f"norm_{name}", f"{J} SELECT seq AS n, {sql}")(lambda s, d: out(fn(jobs(s, d, spread=True)), *columns))
        return fn

    return add


FULL = ["external_id", "title", "company", "location", "description", "job_url", "job_type", "is_remote", "category",
        "date_posted", "source_id"]


def full(external="external_id", title="title", company="company", location="location", description="description",
         job_url="job_url", job_type="job_type", is_remote="is_remote", category="category", posted="date_posted",
         source_id=0, where="TRUE") -> str:
    return f"""{external} AS external_id, {title} AS title, {company} AS company, {location} AS location,
    {description} AS description, {job_url} AS job_url, {job_type} AS job_type, {is_remote} AS is_remote,
    {category} AS category, {posted} AS date_posted, {source_id} AS source_id FROM jobs WHERE {where}"""


# --- list-only JSON systems ---------------------------------------------------------------------------


@norm("jobicy", full(is_remote="TRUE", source_id=50), FULL)
def _jobicy(j):
    item = js(id="external_id", jobTitle="title", companyName="company", jobGeo="location", jobExcerpt="description",
              url="job_url", jobType="job_type", jobIndustry="category", pubDate=day())
    return lists.jobicy(payloads(j, one("jobs", item)))


@norm("remotive", full(external="CAST(seq AS VARCHAR)", is_remote="TRUE", source_id=51,
                       description="description || ' & more'", where=s_any("location", rules.REMOTIVE_GEO)), FULL)
def _remotive(j):
    item = js(id="seq", title="title", company_name="company", candidate_required_location="location",
              description=F.concat(lit("<p>"), "description", lit("</p>&amp; more ")), url="job_url", job_type="job_type",
              category="category", publication_date=day())
    return lists.remotive(payloads(j, one("jobs", item)))


@norm("arbeitnow", full(source_id=53, job_type="NULL", category="category || ', ' || job_type"), FULL)
def _arbeitnow(j):
    item = js(slug="external_id", title="title", company_name="company", location="location", description="description",
              url="job_url", remote="is_remote", created_at=F.unix_timestamp("date_posted"), tags=F.array("category", "job_type"))
    return lists.arbeitnow(payloads(j, one("data", item)))


_GH_TYPE = f"""CASE WHEN {s_blank('job_type')} THEN 'Contract' WHEN {s_match('job_type', '(?i)' + rules.FULL_TIME_PATTERN)}
    THEN 'Full time' ELSE {s_rules('job_type', rules.JOB_TYPE_RULES)} END"""
_GH_CAT = f"CASE WHEN category = '' THEN {s_rules('title', rules.BOARD_CATEGORY_RULES)} ELSE category END"


@norm("greenhouse", full(external="CAST(seq AS VARCHAR)", company="'Acme'", job_type=_GH_TYPE, category=_GH_CAT, source_id=54,
                         is_remote="contains(location, 'Remote')", where=f"{US} OR contains(location, 'Remote')"), FULL)
def _greenhouse(j):
    meta = F.array(js(name=lit("Time type"), value=lit("contractor")), js(name=lit("Team"), value="category"))
    item = js(id="seq", title="title", location=js(name="location"), content=F.concat(lit("<b>"), "description", lit("</b>")),
              absolute_url="job_url", updated_at=day(), employment_type="job_type", metadata=meta)
    return lists.greenhouse(payloads(j, one("jobs", item)))


_TALEO_URL = "'https://acme-corp.taleo.net/careersection/CX/jobdetail.ftl?job=C' || seq || '&lang=en'"


@norm("positional", full(external="'C' || seq", company="'Acme'", job_url=_TALEO_URL, job_type="NULL", is_remote="FALSE",
                         category="NULL", source_id=55, where=US), FULL)
def _taleo(j):
    row = js(column=F.array("title", "location", F.concat(lit("C"), F.col("seq").cast("string")), day(), "description"), jobId="seq")
    body = F.struct(F.array(*[lit(x) for x in ("Title", "Location", "ContestNo", "PostingDate", "Description")]).alias("fields"),
                    F.array(row).alias("requisitionList"))
    return lists.taleo(payloads(j, F.to_json(body)))


@norm("lever", full(external="CAST(seq AS VARCHAR)", company="'Acme'", source_id=57, is_remote="contains(location, 'Remote')",
                    where=f"{US} OR contains(location, 'Remote')"), FULL)
def _lever(j):
    item = js(id="seq", text="title", categories=js(location="location", team="category", commitment="job_type"),
              createdAt=F.unix_timestamp("date_posted") * 1000, descriptionPlain="description", hostedUrl="job_url")
    return lists.lever(payloads(j, one("", item)))


@norm("ashby", full(external="CAST(seq AS VARCHAR)", company="'Acme'", location="location || ', ' || company", source_id=58,
                    description="description || chr(10) || chr(10) || 'Compensation: $1'", category="CASE WHEN category = '' THEN title ELSE category || ' / ' || title END",
                    is_remote="is_remote OR contains(location, 'Remote')",
                    where=f"o_orderstatus <> 'P' AND ({US} OR is_remote)"), FULL)
def _ashby(j):
    item = js(id="seq", title="title", isListed=F.col("o_orderstatus") != "P", location="location",
              secondaryLocations=F.array(js(name="company"), js(name=F.upper("company"))), isRemote="is_remote",
              descriptionHtml="description", compensation=js(summary=lit("$1")), jobUrl="job_url", publishedDate=day(),
              employmentType="job_type", department="category", team="title")
    return lists.ashby(payloads(j, one("jobs", item)))


@norm("recruitee", full(external="CAST(seq AS VARCHAR)", location="location || '; ' || company || ', US'", source_id=61,
                        is_remote="is_remote OR contains(location, 'Remote')", where=f"{US} OR is_remote",
                        description="description || chr(10) || chr(10) || 'Needs'"), FULL)
def _recruitee(j):
    item = js(id="seq", company_name="company", locations=F.array(js(name="location", city=lit(None), country=lit(None)), js(name=lit(None), city="company", country=lit("US"))),
              remote="is_remote", translations=js(de=js(title=lit("x")), en=js(title="title", description="description")),
              requirements=lit("<p>Needs</p>"), careers_url="job_url", published_at=day(), employment_type_code="job_type",
              department="category")
    return lists.recruitee(payloads(j, one("offers", item)))


_JS_REMOTE = "o_orderstatus = 'O'"


@norm("jobsoid", full(external="'91:' || seq", source_id=91, location="location", is_remote=_JS_REMOTE,
                      description="description || CASE WHEN o_orderstatus = 'O' THEN ' virtual' ELSE '' END",
                      job_url="'https://d.example.com/j/' || seq", where=f"{US} OR {_JS_REMOTE}"), FULL)
def _jobsoid(j):
    text = F.concat("description", F.when(F.col("o_orderstatus") == "O", " virtual").otherwise(""))
    item = js(id="seq", title="title", company="company", location=js(title="location", country=lit("USA")), type="job_type",
              description=text, postedDate=day(), function=js(title="category"))
    return lists.jobsoid(payloads(j, one("", item)))


_DAY_KEY = "CASE WHEN job_url <> '' THEN 'u' || lower(job_url) ELSE 'i' || seq END"


@query(
    "norm_dayforce",
    f"""{J}, k AS (SELECT *, {_DAY_KEY} AS k, title || ', TX, United States' AS place FROM jobs)
    SELECT k.k AS key, arg_max(company, (length(place), length(description), -seq)) AS company,
        count(DISTINCT place) AS n,
        bool_or(o_orderstatus = 'P') AS is_remote, arg_max(description, (length(description), -seq)) AS description
    FROM k GROUP BY 1""",
)
def _dayforce(s, d):
    item = js(ReferenceNumber="seq", Title="title", CompanyName="company", City="title", State=lit("TX"), Country=lit("US"),
              TelecommutePercentage=F.when(F.col("o_orderstatus") == "P", "50").otherwise("0"), Description="description",
              JobDetailsUrl="job_url", DatePosted=day())
    got = lists.dayforce(payloads(jobs(s, d), one("", item)))
    key = F.when(F.col("job_url") != "", F.concat(lit("u"), F.lower("job_url"))).otherwise(F.concat(lit("i"), "external_id"))
    return got.select(key.alias("key"), "company", F.size(F.split("location", "; ")).cast("bigint").alias("n"), "is_remote", "description")


# --- feeds ------------------------------------------------------------------------------------------------


@norm("weworkremotely", "title, company, location, description, job_url, is_remote_ AS is_remote, date_posted FROM (SELECT *, TRUE AS is_remote_ FROM jobs) "
      f"WHERE {s_any('location', rules.WWR_GEO)}",
      ["title", "company", "location", "description", "job_url", "is_remote", "date_posted"])
def _wwr(j):
    xml = F.concat(lit("<rss><channel><item><title>"), "title", lit(" at "), "company", lit("</title><region>"), "location",
                   lit("</region><link>"), "job_url", lit("</link><pubDate>"), day("'Mon,' dd MMM yyyy HH:mm:ss 'GMT'"),
                   lit("</pubDate><description><![CDATA[<p>"), "description", lit("</p>]]></description></item></channel></rss>"))
    return feeds.weworkremotely(payloads(j, xml))


_SF = f"""us AS (SELECT * FROM jobs WHERE {US}), listed AS (SELECT * FROM us WHERE o_orderstatus = 'F')"""
_SF_LABEL = "rtrim(trim(regexp_extract(replace(location, '_', ' '), '^[^;|]*')), '.,')"  # a label ends at the first separator
query(
    "norm_successfactors",
    f"""{J}, {_SF} SELECT seq AS n, CAST(seq AS VARCHAR) AS external_id, title, location, description,
        'https://' || company || '/careers/job/' || seq AS job_url, date_posted FROM listed
    UNION ALL SELECT seq, CAST(seq AS VARCHAR), title, {_SF_LABEL}, 'Location: ' || replace(location, '_', ' ') || '; ' || description,
        'https://x/?career_job_req_id=' || seq, date_posted FROM jobs
        WHERE company NOT IN (SELECT company FROM listed) AND {s_is_us(_SF_LABEL)}""",
)(
    lambda s, d: out(
        feeds.successfactors(
            payloads(
                jobs(s, d).filter("o_orderstatus = 'F'"),
                one("data.jobs", js(jobId="seq", jobTitle="title", jobLocation="location", description="description", datePosted=day())),
                domain=F.col("company"),
            ),
            payloads(
                jobs(s, d),
                F.concat(lit("<rss><channel><item><title>"), "title", lit("</title><link>https://x/?career_job_req_id="), F.col("seq").cast("string"),
                         lit("</link><guid>g</guid><pubDate>"), day("dd MMM yyyy HH:mm:ss"), lit("</pubDate><description>&lt;b&gt;Location:&lt;/b&gt; "),
                         F.replace("location", lit("_"), lit(" ")), lit("; "), "description", lit("</description></item></channel></rss>")),
                domain=F.col("company"), kind="feed",
            ),
        ),
        "external_id", "title", "location", "description", "job_url", "date_posted",
    )
)

_P_REMOTE = "contains(lower(location), 'remote')"


@norm("xml", full(external="'93:' || seq", description="'Tasks: ' || description || ' tail'", location="location || ' | ' || company",
                  job_url="'https://d.example.com/job/' || seq", is_remote=_P_REMOTE, source_id=93, where=f"{US} OR {_P_REMOTE}"), FULL)
def _personio(j):
    tag = lambda n, v: F.concat(lit(f"<{n}>"), v, lit(f"</{n}>"))
    desc = lambda n, v: tag("jobDescription", F.concat(tag("name", lit(n)), lit("<value><![CDATA[<p>"), v, lit("</p>]]></value>")))
    xml = F.concat(
        lit("<jobs><position>"), tag("id", F.col("seq").cast("string")), tag("name", F.col("title")), tag("office", F.col("location")),
        tag("additionalOffices", F.col("company")), tag("subcompany", F.col("company")), tag("department", F.col("category")),
        tag("schedule", F.col("job_type")), tag("createdAt", day()),
        tag("jobDescriptions", F.concat(desc("Tasks", F.col("description")), desc(" ", lit("tail")))), lit("</position></jobs>"),
    )
    return feeds.personio(payloads(j, xml))


_UUID = "'0000000a-00bb-0ccc-dddd-' || lpad(CAST(seq AS VARCHAR), 12, '0')"


def _uuid() -> Column:
    return F.concat(lit("0000000a-00bb-0ccc-dddd-"), F.lpad(F.col("seq").cast("string"), 12, "0"))


def ld_page(**fields) -> Column:
    posting = F.to_json(F.struct(lit("JobPosting").alias("@type"), *[(v if isinstance(v, Column) else F.col(v)).alias(k) for k, v in fields.items()]))
    return F.concat(lit('<html><head><script type="application/ld+json">'), posting, lit("</script></head><body><h1>Other</h1></body></html>"))


def place_ld(locality="location") -> Column:
    return F.array(js(address=js(addressLocality=locality)))


_PP_URL = "'https://d.example.com/en/postings/' || seq"


@norm("pinpointhq", full(external=f"'94:' || {_UUID}", job_url=_PP_URL, source_id=94, is_remote=s_any("location || ' ' || title", ["remote"]),
                         where=f"{US} OR contains(location, 'Remote')",
                         category="CASE WHEN category = '' THEN " + s_rules("title || ' ' || description", rules.TECH_CATEGORY_RULES) + " ELSE category END"), FULL)
def _pinpoint(j):
    url = F.concat(lit("https://d.example.com/en/postings/"), F.col("seq").cast("string"))
    rss = F.concat(lit("<rss><channel><item><title>"), "title", lit("</title><link>"), url, lit("</link><pubDate>"), day("dd MMM yyyy HH:mm:ss"),
                   lit("</pubDate></item></channel></rss>"))
    page = ld_page(title="title", description="description", hiringOrganization=js(name="company"), jobLocation=place_ld(),
                   occupationalCategory="category", employmentType="job_type", identifier=js(value=F.upper(_uuid())))
    return feeds.pinpointhq(payloads(j, rss), payloads(j, page, url))


# --- list and detail ------------------------------------------------------------------------------------------


@norm("smartrecruiters", full(external="CAST(seq AS VARCHAR)", description="'About' || chr(10) || description", source_id=59,
                              is_remote="is_remote OR contains(location, 'Remote')", where=f"{US} OR is_remote",
                              category="CASE WHEN category = '' THEN title ELSE category || ' / ' || title END"), FULL)
def _smartrecruiters(j):
    ref = F.concat(lit("https://api/"), F.col("seq").cast("string"))
    place = js(fullLocation="location", remote="is_remote")
    listed = js(id="seq", ref=ref, name="title", location=place)
    detail = js(id="seq", name="title", location=place, company=js(name="company"), postingUrl="job_url", releasedDate=day(),
                typeOfEmployment=js(label="job_type"), department=js(label="category"), function=js(label="title"),
                jobAd=js(sections=js(a=js(title=lit("About"), text=F.concat(lit("<p>"), "description", lit("</p>"))), b=js(title=lit("None"), text=lit(" ")))))
    return list_detail.smartrecruiters(payloads(j, one("content", listed)), payloads(j, F.to_json(detail), ref))


_ORA_URL = "'https://d.example.com/hcmUI/CandidateExperience/en/sites/CX/job/' || seq"
_ORA_REMOTE = s_any("location || ' ' || title", ["remote"])


@norm("oraclecloud", full(external=f"'95:h' || {s_digest(chr(39) + 'd.example.com|cx|' + chr(39) + ' || seq')}", job_url=_ORA_URL, source_id=95,
                          company="company", location="location || ' | ' || company", description="CASE WHEN o_orderstatus = 'F' THEN description || ' must' ELSE 'short' END",
                          category="CASE WHEN category = '' THEN 'Facet' ELSE category END", is_remote=_ORA_REMOTE, where=f"{US} OR {_ORA_REMOTE}")
      .replace("location || ' | ' || company AS location", "CASE WHEN o_orderstatus = 'F' THEN location || ' | ' || company ELSE location END AS location")
      .replace("company AS company", "CASE WHEN o_orderstatus = 'F' THEN company ELSE 'Org' END AS company"), FULL)
def _oracle(j):
    item = js(Id="seq", Title="title", Category="category", JobFamilyId=lit("7"), PrimaryLocation="location", PostedDate=day(),
              JobSchedule="job_type", ShortDescriptionStr=lit("<p>short</p>"))
    search = js(TotalJobsCount=lit("1"), organizationsFacet=F.array(js(Id=lit("1"), Name=lit("Org"))),
                categoriesFacet=F.array(js(Id=lit("7"), Name=lit("Facet"))), requisitionList=F.array(item))
    detail = js(ExternalDescriptionStr="description", ExternalQualificationsStr=lit("<b>must</b>"), PrimaryLocation="location",
                secondaryLocations=F.array(js(Name="company", LocationName=lit(None)), js(Name=lit(None), LocationName=F.upper("company"))), Organization="company")
    url = oracle_detail_url(lit("d.example.com"), lit("CX"), F.col("seq").cast("string"))
    done = j.filter("o_orderstatus = 'F'")
    return list_detail.oraclecloud(payloads(j, one("items", search)), payloads(done, one("items", detail), url))


# the detail of an order comes from its line items
_LINES = "lines AS (SELECT l_orderkey AS k, count(*) AS n, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1)"
_BAMBOO_ID = f"'96:h' || {s_digest(chr(39) + 'bamboohr|d.example.com|' + chr(39) + ' || seq')}"


@query(
    "norm_list_detail",
    f"""{J}, {_LINES} SELECT seq AS n, {_BAMBOO_ID} AS external_id, title, 'D' AS company, location, 'lines ' || n AS description,
    'https://d.example.com/careers/' || seq AS job_url, job_type, contains(lower(location), 'remote') AS is_remote,
    CASE WHEN category <> '' THEN category WHEN {s_it_score('title', 'category', q(''))} > 0 THEN
        {s_rules("title || ' lines ' || n", rules.BAMBOO_CATEGORY_RULES)} ELSE '' END AS category, shipped AS date_posted
    FROM jobs JOIN lines ON seq = k WHERE {US} OR contains(location, 'Remote')""",
)
def _bamboo(s, d):
    j = jobs(s, d)
    lines = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("seq")).agg(
        F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("shipped"))
    listed = js(id="seq", jobOpeningName="title", departmentLabel="category", employmentStatusLabel="job_type", location=js(city="location"))
    opening = js(description=F.concat(lit("<p>lines "), F.col("n").cast("string"), lit("</p>")), datePosted=F.date_format("shipped", "yyyy-MM-dd"))
    url = F.concat(lit("https://d.example.com/careers/"), F.col("seq").cast("string"), lit("/detail"))
    got = list_detail.bamboohr(
        payloads(j, one("result", listed)), payloads(lines, F.to_json(js(result=js(jobOpening=opening))), url)
    )
    return out(got, "external_id", "title", "company", "location", "description", "job_url", "job_type", "is_remote", "category", "date_posted")


_AP_REMOTE = s_any("location || ' ' || title", ["remote"])


@norm("applicantpro", full(external=f"'97:h' || {s_digest(chr(39) + 'applicantpro|d.example.com|' + chr(39) + ' || seq')}", company="'D'", source_id=97,
                           job_url="'https://d.example.com/jobs/' || seq", description="CASE WHEN o_orderstatus = 'F' THEN description ELSE '' END",
                           category="CASE WHEN category <> '' THEN category ELSE "
                           + s_category(q(""), "title", "CASE WHEN o_orderstatus = 'F' THEN description ELSE '' END") + " END",
                           is_remote=_AP_REMOTE, where=f"{US} OR {_AP_REMOTE}"), FULL)
def _applicantpro(j):
    item = js(id="seq", title="title", city="location", startDateRef=day(), employmentType="job_type", jobCategory="category")
    url = F.concat(lit("https://d.example.com/core/jobs/77/"), F.col("seq").cast("string"), lit("/job-details"))
    done = j.filter("o_orderstatus = 'F'")
    detail = F.to_json(js(data=js(advertisingDescription="description")))
    return list_detail.applicantpro(payloads(j, one("data.jobs", item), site="77"), payloads(done, detail, url))


_BREEZY_CAT = "CASE WHEN category <> '' THEN category WHEN o_orderstatus = 'F' THEN " + s_rules("title || ' ' || description", rules.TECH_CATEGORY_RULES) + " ELSE '' END"


@norm("breezyhr", full(external=f"'98:h' || {s_digest(chr(39) + 'breezyhr|d.example.com|' + chr(39) + ' || seq')}", source_id=98,
                       job_url="'https://d.example.com/p/' || seq", description="CASE WHEN o_orderstatus = 'F' THEN description ELSE '' END",
                       location="CASE WHEN o_orderstatus = 'F' THEN 'Salem, OR' ELSE location || ' | ' || title END",
                       category=_BREEZY_CAT, is_remote="contains(location, 'Remote')",
                       where=f"{US} OR contains(location, 'Remote')"), FULL)
def _breezy(j):
    url = F.concat(lit("https://d.example.com/p/"), F.col("seq").cast("string"))
    item = js(id="seq", friendly_id="seq", name="title", locations=F.array(js(name="location", city=lit(None)), js(name=lit(None), city="title"), js(name=F.upper("location"), city=lit(None))),
              company=js(name="company"), type=js(name="job_type"), department="category", published_date=day())
    page = ld_page(description="description", jobLocation=F.array(js(address=js(addressLocality=lit("Salem"), addressRegion=lit("OR")))))
    return list_detail.breezyhr(payloads(j, one("", item)), payloads(j.filter("o_orderstatus = 'F'"), page, url))


# --- HTML pages -----------------------------------------------------------------------------------------------------

_FT_URL = "'https://d.example.com/jobs/' || seq || '/role'"


@norm("freshteam", full(external="'92:' || seq", company="CASE WHEN o_orderstatus = 'F' THEN company ELSE 'D' END", source_id=92, job_url=_FT_URL,
                        job_type="'Contractor'", posted="CASE WHEN o_orderstatus = 'F' THEN date_posted END",
                        category="CASE WHEN o_orderstatus = 'F' THEN " + s_rules("title || ' ' || description", rules.FRESHTEAM_CATEGORY_RULES) + " ELSE '' END",
                        where=f"{US} OR is_remote"), FULL)
def _freshteam(j):
    seq = F.col("seq").cast("string")
    body = F.concat(
        lit('<select id="work_type_id"><option value="">All</option><option value="3">Contractor</option></select>'),
        lit('<a class="c" href="/jobs/'), seq, lit('/role" data-portal-location="'), "location",
        lit('" data-portal-job-type=3 data-portal-remote-location="'), F.col("is_remote").cast("string"),
        lit('"><div class="job-title">'), "title", lit('</div><div class="job-desc"><p>'), "description", lit("</p></div></a>"))
    url = F.concat(lit("https://d.example.com/jobs/"), seq, lit("/role"))
    page = F.concat(lit('<script>{"title":"Hiring for '), "title", lit('","datePosted":"'), day(), lit('","hiringOrganization":"'), "company", lit('"}</script>'))
    return html_pages.freshteam(payloads(j, body), payloads(j.filter("o_orderstatus = 'F'"), page, url))


_ICIMS_URL = "'https://d.example.com/jobs/' || seq || '/' || replace(lower(title), ' ', '-') || '/job'"


@norm("icims", full(external=f"'98:h' || {s_digest(chr(39) + 'icims|d.example.com|' + chr(39) + ' || seq')}", job_url=_ICIMS_URL, source_id=98,
                    is_remote=s_any("location || ' ' || title", ["remote"]),
                    where=f"({US} OR contains(location, 'Remote')) AND {s_it_score('lower(title)', q(''), q(''))} > 0 AND {s_it_score('title', 'category', q(''))} > 0"), FULL)
def _icims(j):
    url = F.concat(lit("https://d.example.com/jobs/"), F.col("seq").cast("string"), lit("/"), F.replace(F.lower("title"), lit(" "), lit("-")), lit("/job"))
    page = ld_page(title="title", description="description", hiringOrganization=js(name="company"), jobLocation=place_ld(),
                   occupationalCategory="category", employmentType="job_type", datePosted=day())
    return html_pages.icims(payloads(j, page, url))


_JAZZ_URL = "'https://d.example.com/apply/A' || seq || '/role'"


@norm("jazzhr", full(external=f"'97:h' || {s_digest(chr(39) + 'jazzhr|d.example.com|A' + chr(39) + ' || seq')}", job_url=_JAZZ_URL, source_id=97,
                     job_type="''", posted="NULL", is_remote=s_any("location || ' ' || title", ["remote"]),
                     category="CASE WHEN category <> '' THEN category ELSE " + s_rules("title || ' ' || description", rules.TECH_CATEGORY_RULES) + " END",
                     where=f"{US} OR contains(location, 'Remote')"), FULL)
def _jazzhr(j):
    url = F.concat(lit("https://d.example.com/apply/A"), F.col("seq").cast("string"), lit("/role"))
    page = F.concat(F.lit("<html><h1>"), "title", lit(" - "), "company", lit(' - Career Page</h1><span class="job-location">'), "location",
                    lit('</span><span class="department">'), "category", lit('</span><div id="job-description"><p>'), "description", lit("</p></div></html>"))
    return html_pages.jazzhr(payloads(j, page, url))


_CATS_URL = "'https://d.example.com/careers/5/jobs/' || seq || '-role'"


@norm("catsone", full(external=f"'98:h' || {s_digest(chr(39) + 'catsone|d.example.com|' + chr(39) + ' || seq')}", company="'D'", job_url=_CATS_URL, source_id=98,
                      job_type="''", posted="NULL", location="location || ', TX, US'", category=s_category(q(""), "title", "description"),
                      is_remote=s_any("location || ' ' || title", ["remote"])), FULL)
def _catsone(j):
    url = F.concat(lit("https://d.example.com/careers/5/jobs/"), F.col("seq").cast("string"), lit("-role"))
    page = F.concat(lit('<script>var x = {"title":"'), "title", lit(' | Portal","description":"<p>'), "description",
                    lit('<\\/p>","location":{"city":"'), "location", lit('","state":"TX","country_code":"US"}}</script>'))
    return html_pages.catsone(payloads(j, page, url))


_ZOHO_URL = "'https://d.example.com/recruit/PortalDetail.na?jobid=A' || lpad(CAST(seq AS VARCHAR), 9, '0')"


@norm("zohorecruit", full(external=f"'99:h' || {s_digest(chr(39) + 'zohorecruit|d.example.com|A' + chr(39) + ' || lpad(CAST(seq AS VARCHAR), 9, ' + chr(39) + '0' + chr(39) + ')')}",
                          company="'D'", job_url=_ZOHO_URL, source_id=99, job_type="'Contract'", posted="NULL",
                          location="location || ', TX'", description="'contract ' || description",
                          category=s_category(q(""), "title", "'contract ' || description"), is_remote=s_any("location || ' ' || title", ["remote"]))
, FULL)
def _zoho(j):
    number = F.lpad(F.col("seq").cast("string"), 9, "0")
    href = F.concat(lit("/recruit/PortalDetail.na?jobid=A"), number)
    row = F.concat(lit('<table><tr class="jobDetailRow"><td><a class="jobdetail" href="'), href, lit('">'), "title",
                   lit("</a></td><td>ZR_1_JOB</td><td>Full time</td><td>"), "location", lit("</td><td>TX</td><td>APPLY NOW</td></tr></table>"))
    url = F.concat(lit("https://d.example.com"), href)
    page = F.concat(lit("<p>contract "), "description", lit("</p>"))
    return html_pages.zohorecruit(payloads(j, row, lit("https://d.example.com/recruit/Portal.na")), payloads(j, page, url))


@query(
    "norm_zoho_jsonld",
    f"""{J} SELECT seq AS n, title, company, location, description, 'https://d.example.com/jobs/x' || seq AS job_url FROM jobs
    WHERE {US} OR contains(location, 'Remote')""",
)
def _zoho_ld(s, d):
    j = jobs(s, d, spread=True)
    url = F.concat(lit("https://d.example.com/jobs/x"), F.col("seq").cast("string"))
    page = ld_page(title="title", description="description", hiringOrganization=js(name="company"), jobLocation=place_ld(), identifier=js(value="seq"))
    got = html_pages.zohorecruit(payloads(j, F.concat(lit("<p>none</p>"), F.col("seq").cast("string"))), payloads(j, page, url))
    return out(got, "title", "company", "location", "description", "job_url")


@query("norm_html")
def _norm_html(s, d):
    """The page readers on the raw pages: most have no US location, so the fields are read
    with a location added."""
    pages = table(s, d, "pages").withColumn("seq", F.col("page_id"))
    body = F.concat(lit('<span class="job-location">Austin, TX</span>'), "html")
    url = F.concat(lit("https://d.example.com/apply/A"), F.col("page_id").cast("string"))
    return out(html_pages.jazzhr(payloads(pages, body, url)), "title", "company", "location", "description", "job_url", "category")


@query("norm_json", f"""SELECT event_id AS n, CAST(event_id AS VARCHAR) AS external_id, event_type AS title,
    'user ' || user_id AS company, 'USA' AS location, regexp_extract(props, ':\\s*([0-9]+)', 1) AS category, TRUE AS is_remote FROM events""")
def _norm_json(s, d):
    events = table(s, d, "events").withColumn("seq", F.col("event_id"))
    item = js(id="event_id", title="event_type", company_name=F.concat(lit("user "), F.col("user_id").cast("string")),
              candidate_required_location=lit("USA"), category=F.from_json("props", "k string")["k"], url=lit(""))
    return out(lists.remotive(payloads(events, one("jobs", item))), "external_id", "title", "company", "location", "category", "is_remote")


# --- Workday ------------------------------------------------------------------------------------------------------------

_WD_PATH = "'/job/Any/Role_R-' || seq"
_WD_URL = f"'https://d.example.com/en-US/CX' || {_WD_PATH}"
_WD_REMOTE = "contains(lower(location), 'remote')"


def _wd(j):
    seq = F.col("seq").cast("string")
    path = F.concat(lit("/job/Any/Role_R-"), seq)
    listed = js(title="title", externalPath=path, locationsText="location", postedOn=lit("Posted 3 Days Ago"),
                bulletFields=F.array("category", "company"))
    info = js(title="title", jobDescription=F.concat(lit("<p>"), "description", lit("</p>")), timeType=js(descriptor="job_type"), id=lit("zz"))
    url = F.concat(lit("https://d.example.com/wday/cxs/acme-corp/CX/job/Any/Role_R-"), seq)
    status = F.expr("CASE o_orderstatus WHEN 'F' THEN 200 WHEN 'O' THEN 404 ELSE 429 END")
    return payloads(j, one("jobPostings", listed)), payloads(j, F.to_json(js(jobPostingInfo=info)), url, status)


# bullets are joined with ' | '; a company name holds a number, so the ladder takes the id in the category text
_WD_CAT = "CASE WHEN category = '' THEN company ELSE category || ' | ' || company END"
_WD_REF = "CASE WHEN category = '' THEN company ELSE 'R-' || seq END"


@norm("workday", full(external=_WD_REF, company="'Acme corp'", description="CASE WHEN o_orderstatus = 'F' THEN description ELSE '' END", job_url=_WD_URL,
                      job_type="CASE WHEN o_orderstatus = 'F' THEN job_type ELSE '' END", is_remote=_WD_REMOTE, category=_WD_CAT,
                      posted="TIMESTAMP '2024-05-29'", source_id=99, where=f"{US} OR {_WD_REMOTE}"), FULL)
def _workday(j):
    listed, details = _wd(j)
    return workday.workday(listed, details, AS_OF)


@norm("workday_tenants", "title, 'Acme' AS company, location, CASE WHEN o_orderstatus = 'F' THEN description ELSE '' END AS description, "
      f"{_WD_REMOTE} AS is_remote, TIMESTAMP '2024-05-29' AS date_posted FROM jobs",
      ["title", "company", "location", "description", "is_remote", "date_posted"])
def _workday_tenants(j):
    listed, details = _wd(j)
    return workday.workday_tenants(listed, details, AS_OF)


_FLAG = lambda c: f"CASE WHEN {c} THEN 'True' ELSE 'False' END"
_XDESC = "CASE WHEN o_orderstatus = 'F' THEN description ELSE '' END"
_XSCORE = s_it_score("title", _WD_CAT, _XDESC)
_EXPORT = f"""SELECT 'workday_commoncrawl' AS source, '99' AS source_id, 'd.example.com' AS domain, 'acme-corp' AS tenant, 'example' AS wd_server,
    'CX' AS site, 'https://d.example.com/wday/cxs/acme-corp/CX/jobs' AS api_url, 'Acme corp' AS company, title, location,
    {_FLAG(US)} AS is_us, {_FLAG(_WD_REMOTE)} AS is_remote, CASE WHEN o_orderstatus = 'F' THEN job_type ELSE '' END AS job_type,
    {_WD_CAT} AS category, '2024-05-29' AS date_posted, {_WD_REF} AS job_reference, {_WD_URL} AS job_url,
    'https://d.example.com/wday/cxs/acme-corp/CX/job/Any/Role_R-' || seq AS detail_api_url,
    CASE o_orderstatus WHEN 'F' THEN '200' WHEN 'O' THEN '404' ELSE '429' END AS detail_status_code,
    {_FLAG("o_orderstatus = 'F'")} AS still_available,
    CASE o_orderstatus WHEN 'F' THEN 'live' WHEN 'O' THEN 'not_found' ELSE 'throttled' END AS availability_status,
    {_FLAG(_XSCORE + ' > 0')} AS is_it, CAST({_XSCORE} AS VARCHAR) AS it_score, CAST(length({_XDESC}) AS VARCHAR) AS description_length,
    {_XDESC} AS description, {_WD_PATH} AS external_path, 'archive-1' AS commoncrawl_index, '' AS commoncrawl_url, '' AS error FROM jobs"""


def _exported(s, d):
    listed, details = _wd(jobs(s, d))
    return workday.workday_export(listed, details, AS_OF, "archive-1")


query("export_jobs", f"{J} {_EXPORT}")(_exported)
query("export_projection", f"{J} SELECT {', '.join(EXPORT_COLUMNS[:12])} FROM ({_EXPORT})")(
    lambda s, d: _exported(s, d).select(*EXPORT_COLUMNS[:12])
)
query(
    "export_summary",
    f"""{J} SELECT count(*) AS total, count_if(still_available = 'True') AS live, count_if(CAST(description_length AS INTEGER) > 0) AS described,
    count_if(is_us = 'True') AS us, count_if(is_remote = 'True') AS remote, count_if(is_it = 'True') AS it FROM ({_EXPORT})""",
)(lambda s, d: reports.export_summary(_exported(s, d)))


@query(
    "export_files",
    f"""{J} SELECT {', '.join(f"coalesce({c}, '') AS {c}" for c in EXPORT_COLUMNS)} FROM ({_EXPORT})""",
)
def export_files(s, d):
    """The export plan: postings of validated sites as a catalogue file, read back."""
    listed, details = _wd(jobs(s, d))
    other = listed.withColumn("site", F.lit("Closed"))
    sites = s.createDataFrame([("d.example.com", "CX", "True", "a"), ("d.example.com", "CX", "True", "b"), ("d.example.com", "Closed", "False", "c")], "domain string, site string, validated string, api_url string")
    path = shared_folder(s, "export")
    export.export_jobs(sites, listed.unionByName(other), details, path, AS_OF, "archive-1")
    return read_catalog_csv(s, path).select(*EXPORT_COLUMNS)

# --- payload table and source choice ----------------------------------------------------------------------------------------


def mixed_payloads(s, d) -> DataFrame:
    """A payload table with two sources, an unknown one, failed captures and broken bodies."""
    j = jobs(s, d)
    jobicy = js(id="external_id", jobTitle="title", companyName="company", jobGeo="location", url="job_url")
    lever = js(id="seq", text="title", categories=js(location="location"), hostedUrl="job_url")
    status = F.expr("CASE o_orderstatus WHEN 'P' THEN 500 ELSE 200 END")
    unknown = payloads(j, lit("{}"), source="Nobody")
    broken = payloads(j, F.concat(lit('{"jobs":['), "title"), source="Ashby")
    error = payloads(j, lit('{"error":"gone"}'), source="Greenhouse").unionByName(payloads(j, lit('{"data":[]}'), source="Lever"))
    blocked = payloads(j, F.lit("<html><body>blocked</body></html>"), source="Personio", kind="feed")
    other = payloads(j, lit("[]"), source="Lever", kind="page")
    return (
        payloads(j, one("jobs", jobicy), source="Jobicy", status=status)
        .unionByName(payloads(j, one("", lever), source="Lever"))
        .unionByName(unknown)
        .unionByName(broken)
        .unionByName(error)
        .unionByName(blocked)
        .unionByName(other)
    )


@query(
    "text_payloads",
    "SELECT page_id % 8 AS payload_seq, CAST(sum(length(url) + 1) AS BIGINT) AS n_chars, count(*) AS lines FROM pages GROUP BY 1",
)
def text_payloads(s, d):
    """Files of one response each: the page URLs of a folder's number, as lines."""
    path = shared_folder(s, "text")
    pages = table(s, d, "pages").select((F.col("page_id") % 8).alias("folder"), "url")
    pages.repartition("folder").write.partitionBy("folder").text(path)
    seq = F.regexp_extract("file_path", r"folder=(\d+)", 1).cast("bigint")
    found = read_text_payloads(s, path, "Lever", "list", seq).groupBy("payload_seq")
    return found.agg(F.sum(F.length("body")).alias("n_chars"), F.sum(F.size(F.split("body", "\n")) - 1).alias("lines"))


@query(
    "payload_scan",
    f"{J} SELECT source, kind, count(*) AS n FROM (SELECT 'Lever' AS source, 'list' AS kind FROM jobs UNION ALL SELECT 'Lever', 'list' FROM jobs) GROUP BY 1, 2",
)
def payload_scan(s, d):
    path = shared_folder(s, "payloads")
    mixed_payloads(s, d).write.partitionBy("source").parquet(path)
    return read_payloads(s, path, "Lever", "list").groupBy("source", "kind").agg(F.count(F.lit(1)).alias("n"))


query(
    "rejects",
    f"""{J} SELECT 'Jobicy' AS source, 'status' AS reason, count(*) AS n FROM jobs WHERE o_orderstatus = 'P' GROUP BY 1, 2
    UNION ALL SELECT 'Nobody', 'unknown source', count(*) FROM jobs UNION ALL SELECT 'Ashby', 'broken json', count(*) FROM jobs
    UNION ALL SELECT 'Greenhouse', 'wrong shape', count(*) FROM jobs UNION ALL SELECT 'Lever', 'wrong shape', count(*) FROM jobs
    UNION ALL SELECT 'Personio', 'wrong shape', count(*) FROM jobs UNION ALL SELECT 'Lever', 'unknown kind', count(*) FROM jobs""",
)(
    lambda s, d: registry.rejects(mixed_payloads(s, d)).groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))
)

# Every source and kind gets a page in front of the site, a page of another kind, and, from
# supplier 0 on, an empty page where its system has one.
_KINDS = [(name, kind) for name, entry in registry.NORMALIZERS.items() for kind in entry.kinds]
_KIND_SQL = "(VALUES " + ", ".join(f"({q(n)}, {q(k)})" for n, k in _KINDS) + ") AS k(source, kind)"
_NO_JOBS = [("Freshteam", "list"), ("ZohoRecruit", "list")]


def blocked_payloads(s, d):
    rows = table(s, d, "supplier").select(F.col("s_suppkey").alias("seq"))
    pairs = F.array(*[F.struct(F.lit(n).alias("source"), F.lit(k).alias("kind")) for n, k in _KINDS])
    rows = rows.select("seq", F.explode(pairs).alias("p")).select("seq", "p.*")
    wall = rows.withColumn("body", F.lit("<html><head><title>Just a moment...</title></head><body><a href='/jobs/1/x'>a</a></body></html>"))
    other = rows.withColumn("body", F.lit("<html><body><p>Welcome to our company</p></body></html>"))
    empty = rows.filter(F.concat_ws("|", "source", "kind").isin(*["|".join(p) for p in _NO_JOBS])).withColumn("body", F.lit("<html><p>There are no open positions.</p></html>"))
    return conform(wall.unionByName(other).unionByName(empty).withColumns({"payload_seq": F.col("seq"), "status_code": F.lit(200)}), PAYLOADS)


query(
    "rejects_by_kind",
    f"""SELECT source, kind, 'blocked page' AS reason, count(*) AS n FROM supplier, {_KIND_SQL} GROUP BY 1, 2
    UNION ALL SELECT source, kind, 'wrong shape', count(*) FROM supplier, {_KIND_SQL} GROUP BY 1, 2""",
)(lambda s, d: registry.rejects(blocked_payloads(s, d)).groupBy("source", "kind", "reason").agg(F.count(F.lit(1)).alias("n")))

@query(
    "payload_outcomes",
    f"""{J} SELECT kind, outcome, count(*) AS payloads, CAST(sum(n) AS BIGINT) AS postings FROM (
        SELECT 'list' AS kind, CASE WHEN {US} OR contains(location, 'Remote') THEN 'postings' ELSE 'none kept' END AS outcome,
            CAST({US} OR contains(location, 'Remote') AS INTEGER) AS n FROM jobs
        UNION ALL SELECT 'list', 'wrong shape', 0 FROM jobs UNION ALL SELECT 'page', 'unknown kind', 0 FROM jobs) GROUP BY 1, 2""",
)
def payload_outcomes(s, d):
    # the three kinds of Lever payloads have arrival numbers of their own
    mixed = mixed_payloads(s, d).filter("source = 'Lever'")
    shift = F.expr("CASE WHEN kind = 'page' THEN 2 WHEN body LIKE '{%' THEN 1 ELSE 0 END")
    mixed = mixed.withColumn("payload_seq", F.col("payload_seq") * 3 + shift)
    postings = registry.normalize_payloads(mixed, only="Lever", as_of=AS_OF)
    found = registry.outcomes(mixed, postings)
    return found.groupBy("kind", "outcome").agg(F.count(F.lit(1)).alias("payloads"), F.sum("postings").alias("postings"))


query(
    "normalize_payloads",
    f"""{J} SELECT 'Jobicy' AS source_name, title, location FROM jobs WHERE o_orderstatus <> 'P' AND {US}
    UNION ALL SELECT 'Lever', title, location FROM jobs WHERE {US} OR contains(location, 'Remote')""",
)(
    lambda s, d: registry.normalize_payloads(mixed_payloads(s, d), as_of=AS_OF)
    .filter(F.col("source_name").isin("Jobicy", "Lever"))
    .select("source_name", "title", "location")
)

query(
    "union_sources",
    "SELECT 'customer' AS source_name, c_custkey AS seq, c_name AS company FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier",
)(
    lambda s, d: registry.union_sources(
        [
            table(s, d, "customer").select(lit("customer").alias("source_name"), F.col("c_custkey").alias("seq"), F.col("c_name").alias("company")),
            table(s, d, "supplier").select(lit("supplier").alias("source_name"), F.col("s_suppkey").alias("seq"), F.col("s_name").alias("company")),
        ]
    )
)

query(
    "pick_source",
    f"""{J} SELECT 'Lever' AS source_name, title FROM jobs WHERE {US} OR contains(location, 'Remote')""",
)(lambda s, d: registry.normalize_payloads(mixed_payloads(s, d), only=" LEVER ").select("source_name", "title"))
