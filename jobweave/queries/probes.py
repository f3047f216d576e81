"""Probes of career sites: candidates in order, count readers, and patterns as a join."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobweave import rules
from jobweave.operators import patterns, probes
from jobweave.queries.base import q, query, table
from jobweave.queries.catalogue import _JOB_PAGES, job_pages

# --- patterns ------------------------------------------------------------------------------

# The archive patterns against job URLs, and one pattern per second-level domain against pages.
_PATTERN_LIST = ", ".join(q(p) for p in rules.ARCHIVE_URL_PATTERNS)
_BARE = "lower(regexp_replace({}, '(?i)^https?://', ''))"
_HOST2 = r"regexp_extract(lower(regexp_replace(page_url, '(?i)^https?://', '')), '^[^/?#]*?([^./?#]+\.[^./?#]+)(?:[/?#]|$)', 1)"


def _half(x: str, part: str) -> str:
    bare = _BARE.format(x)
    return f"regexp_extract({bare}, '^[^/?#]*')" if part == "host" else f"regexp_replace({bare}, '^[^/?#]*', '')"


@query(
    "pattern_join",
    f"""WITH {_JOB_PAGES}, urls AS (SELECT page_id, url FROM jobpages UNION ALL SELECT page_id, page_url FROM jobpages),
    pats AS (SELECT unnest([{_PATTERN_LIST}]) AS pattern UNION SELECT DISTINCT '*.' || {_HOST2} || '/e*/*' FROM jobpages WHERE {_HOST2} <> '')
    SELECT page_id, url, pattern FROM urls JOIN pats ON {_half('url', 'host')} LIKE replace({_half('pattern', 'host')}, '*', '%')
        AND {_half('url', 'rest')} LIKE replace({_half('pattern', 'rest')}, '*', '%')""",
)
def pattern_join(s, d):
    pages = job_pages(s, d)
    urls = pages.select("page_id", "url").unionAll(pages.select("page_id", F.col("page_url")))
    bare = F.lower(F.regexp_replace("page_url", "(?i)^https?://", ""))
    host = F.regexp_extract(bare, r"^[^/?#]*?([^./?#]+\.[^./?#]+)(?:[/?#]|$)", 1)
    own = pages.select(host.alias("h")).filter("h <> ''").select(F.concat(F.lit("*."), "h", F.lit("/e*/*")).alias("pattern"))
    fixed = s.createDataFrame([(p,) for p in rules.ARCHIVE_URL_PATTERNS], "pattern string")
    return patterns.pattern_matches(urls, "url", own.union(fixed).distinct()).select("page_id", "url", "pattern")


# --- candidates ----------------------------------------------------------------------------

_SYSTEM = "CASE c_custkey % 5 WHEN 0 THEN 'Workday' WHEN 1 THEN 'iCIMS' WHEN 2 THEN 'JazzHR' WHEN 3 THEN 'OracleCloud' ELSE 'ZohoRecruit' END"
_DOMAIN = """concat('c', CAST(c_custkey AS VARCHAR(20)), CASE c_custkey % 5 WHEN 0 THEN '.wd3.myworkdayjobs.com' WHEN 1 THEN '.icims.com'
    WHEN 2 THEN '.applytojob.com' WHEN 3 THEN '.fa.oraclecloud.com' ELSE '.zohorecruit.com' END)"""
_CAPTURED = "(k + 3 * attempt) % 4 <> 0"
_STATUS = "CASE WHEN (k + attempt) % 11 = 0 THEN 500 ELSE 200 END"
_GOOD = "(7 * k + attempt * attempt) % 3 = 0"
_BODY = """CASE WHEN NOT good THEN '<html>nothing here</html>' WHEN system = 'Workday' THEN '{"total":3,"jobPostings":[{"title":"Clerk"}]}'
    WHEN system = 'iCIMS' THEN '<a href="/jobs/77/clerk/job">x</a>' WHEN system = 'JazzHR' THEN '<p>Powered by Resumator</p>'
    WHEN system = 'OracleCloud' THEN '<body data-siteNumber="CX_9">' ELSE '<a href="/jobs/Careers/123456/clerk">x</a>' END"""
_LISTS = " UNION ALL ".join(
    f"SELECT {q(system)} AS system, unnest([{', '.join(q(v) for v in values)}]) AS candidate, unnest(range(1, {len(values) + 1})) AS attempt"
    for system, (values, _) in probes.CANDIDATES.items()
)


def _sites(s, d):
    return table(s, d, "customer").select("c_custkey", F.expr(_SYSTEM).alias("system"), F.expr(_DOMAIN.replace("VARCHAR(20)", "STRING")).alias("domain"))


def _captures(sites):
    """Responses to some of the candidates, some of them failed or of another kind."""
    tried = probes.candidate_urls(sites).join(sites.select("domain", F.col("c_custkey").alias("k")), "domain").filter(_CAPTURED)
    made = tried.withColumn("good", F.expr(_GOOD)).select(F.col("probe_url").alias("url"), F.expr(_STATUS).alias("status_code"), F.expr(_BODY).alias("body"))
    return made.unionAll(made.filter("status_code = 200"))  # captured twice


@query(
    "candidate_probes",
    f"""WITH sites AS (SELECT c_custkey AS k, {_SYSTEM} AS system, {_DOMAIN} AS domain FROM customer), lists AS ({_LISTS}),
    tried AS (SELECT k, system, domain, candidate, attempt, {_CAPTURED} AND {_STATUS} = 200 AND {_GOOD} AS ok FROM sites JOIN lists USING (system)),
    hit AS (SELECT domain, min(attempt) AS n FROM tried WHERE ok GROUP BY domain)
    SELECT system, domain, CAST(n AS INTEGER) AS attempt, max(CASE WHEN attempt = n THEN candidate END) AS candidate,
        string_agg(candidate, ';' ORDER BY attempt) AS attempted
    FROM tried JOIN hit USING (domain) WHERE attempt <= n GROUP BY system, domain, n""",
)
def candidate_probes(s, d):
    sites = _sites(s, d)
    return probes.first_valid_candidates(sites, _captures(sites)).select("system", "domain", "attempt", "candidate", "attempted")


@query(
    "workday_candidates",
    f"""WITH sites AS (SELECT c_custkey AS k, {_SYSTEM} AS system, {_DOMAIN} AS domain FROM customer), lists AS ({_LISTS}),
    hit AS (SELECT domain, min_by(candidate, attempt) AS site FROM sites JOIN lists USING (system)
        WHERE system = 'Workday' AND {_CAPTURED} AND {_STATUS} = 200 AND {_GOOD} GROUP BY domain)
    SELECT domain, split_part(domain, '.', 1) AS tenant, 'wd3' AS wd_server, site,
        'https://' || domain || '/wday/cxs/' || split_part(domain, '.', 1) || '/' || site || '/jobs' AS api_url,
        'https://' || domain || '/en-US/' || site AS careers_url, '3' AS total_jobs, 'Clerk' AS sample_title FROM hit""",
)
def workday_candidates(s, d):
    sites = _sites(s, d)
    found = probes.workday_sites(probes.first_valid_candidates(sites, _captures(sites)))
    return found.select("domain", "tenant", "wd_server", "site", "api_url", "careers_url", "total_jobs", "sample_title")


@query(
    "oracle_site_numbers",
    f"""WITH sites AS (SELECT c_custkey AS k, {_SYSTEM} AS system, {_DOMAIN} AS domain FROM customer), lists AS ({_LISTS})
    SELECT DISTINCT domain, 'CX_9' AS site FROM sites JOIN lists USING (system)
    WHERE system = 'OracleCloud' AND {_CAPTURED} AND {_STATUS} = 200 AND {_GOOD}""",
)
def oracle_site_numbers(s, d):
    sites = _sites(s, d)
    return probes.oracle_sites(probes.first_valid_candidates(sites, _captures(sites)))


# --- readers -------------------------------------------------------------------------------

_SYSTEMS = ["BambooHR", "BreezyHR", "OracleCloud", "Jobsoid", "ApplicantPro", "PinpointHQ", "Personio", "Freshteam", "CATSOne", "ZohoRecruit"]
_READ_SYSTEM = f"[{', '.join(q(x) for x in _SYSTEMS)}][1 + c_custkey % 10]"


def _lists(s, d):
    """A list response per customer, with an item for each order."""
    key, title = F.col("o_orderkey").cast("string"), F.concat(F.lit("Clerk "), "o_orderpriority")
    item = F.struct("o_orderkey", key.alias("id"), title.alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    orders = table(s, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    rows = table(s, d, "customer").join(orders, "c_custkey", "left").withColumn("items", F.coalesce("items", F.array().cast(orders.schema["items"].dataType)))
    system = F.get(F.array(*[F.lit(x) for x in _SYSTEMS]), (F.col("c_custkey") % 10).cast("int"))
    rows = rows.select("c_custkey", "items", system.alias("system"), F.concat(F.lit("t"), F.col("c_custkey").cast("string"), F.lit(".site")).alias("domain"))
    json = lambda **fields: F.to_json(F.transform("items", lambda i: F.struct(*[f(i).alias(n) for n, f in fields.items()])))
    text = lambda f: F.array_join(F.transform("items", f), "")
    of = lambda name: lambda i: i[name]
    wrap = lambda a, b, c: F.concat(F.lit(a), b, F.lit(c))
    total = F.size("items").cast("string")
    bodies = {
        "BambooHR": F.concat(F.lit('{"result":'), json(id=of("id")), F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit(',"meta":{"totalCount":'), (F.size("items") * 2).cast("string"), F.lit("}"))).otherwise(""), F.lit("}")),
        "BreezyHR": json(url=lambda i: F.concat(F.lit("https://x/p/"), i["id"]), name=of("title")),
        "OracleCloud": F.concat(F.lit('{"items":[{"TotalJobsCount":'), total, F.lit(',"organizationsFacet":[{"Name":"Org"}],"requisitionList":'), json(Id=of("id"), Title=of("title")), F.lit("}]}")),
        "Jobsoid": json(hostedUrl=lambda i: F.concat(F.lit("https://x/j/"), i["id"]), title=of("title"), postedDate=of("date")),
        "ApplicantPro": wrap('{"data":{"jobs":', json(id=of("id"), title=of("title")), "}}"),
        "PinpointHQ": wrap("<rss><channel>", text(lambda i: F.concat(F.lit("<item><title>"), i["title"], F.lit("</title><link>https://x/j/"), i["id"], F.lit("</link><pubDate>"), i["date"], F.lit("</pubDate></item>"))), "</channel></rss>"),
        "Personio": wrap("<workzag-jobs>", text(lambda i: F.concat(F.lit("<position><id>"), i["id"], F.lit("</id><name> "), i["title"], F.lit("</name><createdAt>"), i["date"], F.lit("</createdAt></position>"))), "</workzag-jobs>"),
        "Freshteam": wrap("<div>", text(lambda i: F.concat(F.lit('<a class="c" href="/jobs/'), i["id"], F.lit('/clerk"><div class="job-title">'), i["title"], F.lit("</div></a>"))), "</div>"),
        "CATSOne": wrap("<h1>Careers</h1>", text(lambda i: F.concat(F.lit('<a href="/careers/9/jobs/'), i["id"], F.lit('-clerk">x</a>'))), '<a href="/careers/9/jobs">all</a>'),
        "ZohoRecruit": wrap("<table>", text(lambda i: F.concat(F.lit('<tr class="jobDetailRow"><td><a class="jobdetail" href="/jobs/Careers/'), i["id"], F.lit('00/clerk">'), i["title"], F.lit("</a></td><td>Town</td></tr>"))), "</table>"),
    }
    body = F.lit(None).cast("string")
    for name, value in bodies.items():
        body = F.when(F.col("system") == name, value).otherwise(body)
    path = F.when(F.col("system") == "CATSOne", "/careers/9/jobs").otherwise("/list")
    status = F.when(F.col("c_custkey") % 7 == 0, 503).otherwise(200)
    return rows.select("system", "domain", F.lit("CX").alias("site"), F.concat(F.lit("https://"), "domain", path).alias("url"), status.alias("status_code"), body.alias("body"))


@query(
    "probe_readers",
    f"""WITH o AS (SELECT o_custkey AS c_custkey, count(*) AS n, CAST(min(o_orderkey) AS VARCHAR) AS id,
        'Clerk ' || min_by(o_orderpriority, o_orderkey) AS title, strftime(min_by(o_orderdate, o_orderkey), '%Y-%m-%d') AS date FROM orders GROUP BY 1),
    r AS (SELECT *, {_READ_SYSTEM} AS system, 't' || c_custkey || '.site' AS domain FROM customer JOIN o USING (c_custkey) WHERE c_custkey % 7 <> 0)
    SELECT system, domain, CAST(CASE WHEN system = 'BambooHR' AND c_custkey % 4 = 0 THEN 2 * n ELSE n END AS INTEGER) AS job_links_found,
        CASE system WHEN 'BambooHR' THEN 'https://' || domain || '/careers/' || id WHEN 'BreezyHR' THEN 'https://x/p/' || id
            WHEN 'OracleCloud' THEN 'https://' || domain || '/hcmUI/CandidateExperience/en/sites/CX/job/' || id
            WHEN 'ApplicantPro' THEN 'https://' || domain || '/jobs/' || id WHEN 'Personio' THEN 'https://' || domain || '/job/' || id
            WHEN 'Freshteam' THEN 'https://' || domain || '/jobs/' || id || '/clerk' WHEN 'CATSOne' THEN 'https://' || domain || '/careers/9/jobs/' || id || '-clerk'
            WHEN 'ZohoRecruit' THEN 'https://' || domain || '/jobs/Careers/' || id || '00/clerk' ELSE 'https://x/j/' || id END AS sample_job_url,
        CASE WHEN system IN ('BambooHR', 'CATSOne') THEN '' ELSE title END AS sample_title,
        CASE WHEN system IN ('Jobsoid', 'PinpointHQ', 'Personio') THEN date ELSE '' END AS sample_posted_at,
        CASE system WHEN 'OracleCloud' THEN 'Org' ELSE '' END AS sample_company, CASE system WHEN 'CATSOne' THEN '9' ELSE '' END AS portal_id FROM r""",
)
def probe_readers(s, d):
    found = probes.read_probes(_lists(s, d))
    return found.select("system", "domain", *probes.SAMPLE, "portal_id")
