"""Site catalogues: CSV and archive files, routing, probing, discovery and ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobweave import rules
from jobweave.functions.url import host_if_suffix, matches_pattern, normalize_domain
from jobweave.operators import discovery, ordering, reports
from jobweave.operators.dedupe import first_per_key
from jobweave.plans import discovery as plans
from jobweave.queries.base import q, query, s_host, s_match, s_trim, s_url_path, table
from jobweave.session import shared_folder
from jobweave.sources.archive import read_cdx_jsonl
from jobweave.sources.catalog_csv import read_catalog_csv, write_catalog_csv

# --- files -------------------------------------------------------------------------------

_SUPPLIER = ["s_suppkey", "s_name", "s_acctbal", "note"]


def _catalog(s, d):
    return table(s, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_name",
        F.col("s_acctbal").cast("decimal(18,2)").cast("string").alias("s_acctbal"),
        F.concat(F.lit('a "quoted", value '), "s_name").alias("note"),
    )


@query(
    "catalog_roundtrip",
    """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS s_acctbal,
    'a "quoted", value ' || s_name AS note, '' AS missing FROM supplier""",
)
def catalog_roundtrip(s, d):
    path = shared_folder(s, "catalog")
    write_catalog_csv(_catalog(s, d), path, [*_SUPPLIER, "missing"])
    return read_catalog_csv(s, path)


@query("cdx_urls", "SELECT url FROM pages")
def cdx_urls(s, d):
    path = shared_folder(s, "cdx")
    pages = table(s, d, "pages")
    good = pages.select(F.to_json(F.struct("url", "page_id")).alias("line"))
    broken = pages.select(F.concat(F.lit('{"url": "'), "url").alias("line"))
    blank = pages.select(F.to_json(F.struct(F.lit(" ").alias("url"), "page_id")).alias("line"))
    good.unionByName(broken).unionByName(blank).write.text(path)
    return read_cdx_jsonl(s, path)


# --- domains ---------------------------------------------------------------------------------

_HOST = f"regexp_replace(trim(trim(split_part(regexp_replace(rtrim(lower({s_trim('url')}), '/'), '^https?://', ''), '/', 1)), '.'), '^www\\.', '')"
def _block():
    return F.expr("page_id div 65536")



@query(
    "site_domains",
    f"""SELECT CAST(row_number() OVER (ORDER BY p) + 1 AS BIGINT) AS source_row, domain FROM
    (SELECT {_HOST} AS domain, min(page_id) AS p FROM pages GROUP BY 1) WHERE domain <> ''""",
)
def site_domains(s, d):
    pages = table(s, d, "pages")
    return discovery.site_domains(pages, F.col("url"), "page_id", _block())


query(
    "catalog_domains",
    f"""SELECT CAST(row_number() OVER (ORDER BY p) + 1 AS BIGINT) AS source_row, domain FROM
    (SELECT {_HOST} AS domain, min(page_id) AS p FROM pages GROUP BY 1) WHERE domain <> ''""",
)(
    # every second row has its domain in the second of the domain columns only
    lambda s, d: discovery.site_domains(
        (rows := table(s, d, "pages").select(
            F.lit(" ").alias("Original_Domain"), F.when(F.col("page_id") % 2 == 0, F.col("url")).alias("domain"),
            F.when(F.col("page_id") % 2 == 1, F.col("url")).alias("normalized_domain"), "page_id",
        )),
        discovery.catalog_domain(rows), "page_id", _block(),
    )
)

query(
    "source_row",
    "SELECT page_id, CAST(row_number() OVER (ORDER BY page_id) + 1 AS BIGINT) AS source_row FROM pages",
)(
    lambda s, d: ordering.number_rows(
        table(s, d, "pages").select("page_id"), F.col("page_id"), _block(), "source_row", start=2
    )
)

# Recruiting-system hosts built from the pages' own hosts.
_SUFFIXES = [
    "bamboohr.com", "breezy.hr", "icims.com", "applytojob.com", "wd5.myworkdayjobs.com", "oraclecloud.com",
    "pinpointhq.com", "jobs.personio.de", "freshteam.com", "jobsoid.com", "applicantpro.com", "catsone.com",
    "zohorecruit.in", "example.com",
]


def _system_hosts(s, d):
    label = F.split_part(normalize_domain("url"), F.lit("."), F.lit(1))
    return table(s, d, "pages").select(
        "page_id", F.explode(F.array(*[F.concat(label, F.lit("." + x)) for x in _SUFFIXES])).alias("domain")
    )


_SYSTEM_HOSTS = f"""(SELECT page_id, split_part({_HOST}, '.', 1) || '.' || x AS domain
    FROM pages, (SELECT unnest([{', '.join(q(x) for x in _SUFFIXES)}]) AS x))"""
query(
    "route_source",
    "SELECT page_id, domain, CASE "
    + " ".join(f"WHEN {s_match('domain', '(?i)' + r.pattern)} THEN {q(r.label)}" for r in rules.HOST_ROUTES)
    + f" END AS source FROM {_SYSTEM_HOSTS}",
)(lambda s, d: _system_hosts(s, d).withColumn("source", discovery.route_source("domain")))

query(
    "url_pattern",
    "SELECT page_id, url FROM pages WHERE lower(regexp_replace(url, '(?i)^https?://', '')) LIKE '%.example.com/%/%'",
)(lambda s, d: table(s, d, "pages").filter(matches_pattern("url", "*.example.com/*/*")).select("page_id", "url"))

# --- archive candidates ---------------------------------------------------------------------------
# A Workday-like job URL per page: tenant and site from the page's host and path.  Pages with a
# query string become URLs without a job segment, so some do not parse.
_TENANT = f"regexp_extract({s_host('url')}, '([a-z-]+)\\.example\\.[a-z]+$', 1)"
_LANG = f"split_part({s_url_path('url')}, '/', 2)"
_JOB_URL = f"""'https://' || {_TENANT} || '.wd' || length({_TENANT}) || '.myworkdayjobs.com/en-US/' || {_LANG}
    || CASE WHEN contains(url, '?page=') THEN '/search/' ELSE '/job/' END || split_part({s_url_path('url')}, '/', 3)"""
_JOB_PAGES = f"jobpages AS (SELECT page_id, {_JOB_URL} AS url, url AS page_url FROM pages)"


def job_pages(s, d):
    host = F.lower(F.parse_url("url", F.lit("HOST")))
    tenant = F.regexp_extract(host, r"([a-z-]+)\.example\.[a-z]+$", 1)
    path = F.parse_url("url", F.lit("PATH"))
    segment = lambda n: F.split_part(path, F.lit("/"), F.lit(n))
    step = F.when(F.contains("url", F.lit("?page=")), "/search/").otherwise("/job/")
    url = F.concat(
        F.lit("https://"), tenant, F.lit(".wd"), F.length(tenant).cast("string"), F.lit(".myworkdayjobs.com/en-US/"),
        segment(2), step, segment(3),
    )
    return table(s, d, "pages").select("page_id", url.alias("url"), F.col("url").alias("page_url"))


_SEGS = f"list_filter(string_split({s_url_path('url')}, '/'), lambda x: x <> '')"
_CAND = f"""parsed AS (SELECT page_id, url, {s_host('url')} AS domain, {_SEGS} AS segs,
        list_position(list_transform({_SEGS}, lambda x: lower(x)), 'job') AS at_ FROM jobpages),
    cand AS (SELECT page_id, url, domain, regexp_extract(domain, {q(rules.WORKDAY_HOST)}, 1) AS tenant,
        regexp_extract(domain, {q(rules.WORKDAY_HOST)}, 2) AS server, segs[at_ - 1] AS site FROM parsed
        WHERE {s_match('domain', rules.WORKDAY_HOST)} AND at_ >= 3 AND at_ < len(segs))"""
_W = "WITH " + _JOB_PAGES + "," + _CAND

query("url_candidate", _W + " SELECT page_id, domain, tenant, server, site FROM cand")(
    lambda s, d: job_pages(s, d)
    .select("page_id", discovery.archive_candidate("url").alias("c"))
    .filter("c IS NOT NULL")
    .select("page_id", "c.*")
)

_SEED = f"""parsed AS (SELECT page_id, url, {s_host('url')} AS domain, {_SEGS} AS segs, list_position({_SEGS}, 'job') AS at_ FROM jobpages),
    cand AS (SELECT page_id, url, domain, split_part(domain, '.', 1) AS tenant, split_part(domain, '.', 2) AS server,
        CASE WHEN {s_match('segs[at_ - 1]', rules.LOCALE_SEGMENT)} AND at_ >= 3 THEN segs[at_ - 2] ELSE segs[at_ - 1] END AS site
        FROM parsed WHERE domain LIKE '%.myworkdayjobs.com' AND at_ >= 2)"""
_WSEED = "WITH " + _JOB_PAGES + "," + _SEED
query("url_candidate_seed", _WSEED + " SELECT page_id, domain, tenant, server, site FROM cand")(
    lambda s, d: job_pages(s, d)
    .select("page_id", discovery.seed_candidate("url").alias("c"))
    .filter("c IS NOT NULL")
    .select("page_id", "c.*")
)

# Known domains: tenants of the pages with a fragment.  Skipped pairs: German sites.
_KNOWN = "known AS (SELECT DISTINCT domain FROM cand JOIN jobpages USING (page_id) WHERE contains(page_url, '#'))"
_FIRST = """firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(domain || '|' || site) ORDER BY page_id) AS rn
    FROM cand) WHERE rn = 1)"""


def _known(s, d, parse=discovery.archive_candidate):
    rows = job_pages(s, d).filter(F.contains("page_url", F.lit("#")))
    return rows.select(parse("url").alias("c")).filter("c IS NOT NULL").select("c.domain").distinct()


def _skip(s, d, parse=discovery.archive_candidate):
    rows = job_pages(s, d).select(parse("url").alias("c")).filter("c.site = 'de'")
    return rows.select("c.domain", "c.site")


query(
    "distinct_candidates",
    _W + "," + _FIRST + " SELECT page_id, domain, tenant, server, site, url FROM firsts",
)(lambda s, d: discovery.candidates(job_pages(s, d), "url", "page_id"))

query(
    "exclude_known",
    _W + "," + _KNOWN + "," + _FIRST + """ SELECT page_id, domain, site FROM firsts
    WHERE domain NOT IN (SELECT domain FROM known) AND site <> 'de'""",
)(
    lambda s, d: discovery.exclude(
        discovery.candidates(job_pages(s, d), "url", "page_id"), _known(s, d), _skip(s, d)
    ).select("page_id", "domain", "site")
)

query(
    "flag_known",
    _W + "," + _KNOWN + "," + _FIRST
    + " SELECT page_id, domain, site, domain IN (SELECT domain FROM known) AS known_from_jobsites FROM firsts",
)(
    lambda s, d: discovery.flag_known(
        discovery.candidates(job_pages(s, d), "url", "page_id"), _known(s, d)
    ).select("page_id", "domain", "site", "known_from_jobsites")
)


def _probes(s, d):
    """Captured list and detail responses for the candidates, written from the pages: the
    job count is the page number in the URL; spam hosts have lost their sample."""
    cands = discovery.candidates(job_pages(s, d), "url", "page_id")
    pages = table(s, d, "pages").select("page_id", F.length("html").alias("total"))
    rows = cands.join(pages, "page_id")
    path = F.concat(F.lit("/job/"), F.col("page_id").cast("string"))
    posting = F.struct(F.concat(F.lit("Engineer "), "site").alias("title"), path.alias("externalPath"))
    lists = rows.select(
        "domain", "site", F.lit(200).alias("status_code"),
        F.to_json(F.struct(F.col("total").alias("total"), F.array(posting).alias("jobPostings"))).alias("body"),
    )
    info = F.struct(F.struct(posting["title"].alias("title")).alias("jobPostingInfo"))
    gone = F.contains("domain", F.lit("spam"))
    details = rows.select(
        "domain", "site", F.when(gone, 404).otherwise(200).alias("status_code"), F.to_json(info).alias("body")
    )
    return cands, lists, details


_VALID = """valid AS (SELECT firsts.*, length(html) AS total FROM firsts JOIN pages USING (page_id) WHERE NOT contains(domain, 'spam'))"""


@query(
    "discover",
    _W + "," + _KNOWN + "," + _FIRST + "," + _VALID + """ SELECT domain, tenant, server AS wd_server, site, CAST(total AS VARCHAR) AS total_jobs,
    'Engineer ' || site AS sample_title, 'https://' || domain || '/en-US/' || site || '/job/' || page_id AS sample_job_url,
    'https://' || domain || '/wday/cxs/' || tenant || '/' || site || '/jobs' AS api_url, 'False' AS known_from_jobsites
    FROM valid WHERE domain NOT IN (SELECT domain FROM known) AND site <> 'de'""",
)
def discover(s, d):
    _, lists, details = _probes(s, d)
    lists = lists.unionByName(lists)  # every list captured twice
    return plans.discover_sites(job_pages(s, d), _known(s, d), _skip(s, d), lists, details, "page_id", "archive-1").select(
        "domain", "tenant", "wd_server", "site", "total_jobs", "sample_title", "sample_job_url", "api_url",
        "known_from_jobsites",
    )


@query(
    "discovery_summary",
    _W + "," + _KNOWN + "," + _FIRST + "," + _VALID + """ SELECT count(*) AS sites, CAST(sum(total) AS BIGINT) AS total_jobs,
    count(*) AS live, count_if(domain IN (SELECT domain FROM known)) AS known FROM valid""",
)
def discovery_summary(s, d):
    cands, lists, details = _probes(s, d)
    flagged = discovery.flag_known(cands, _known(s, d))
    return reports.discovery_summary(discovery.validate(flagged, lists, details))


query(
    "seed_candidates",
    _WSEED + "," + _KNOWN + "," + _FIRST + """ SELECT page_id, domain, site FROM firsts
    WHERE domain NOT IN (SELECT domain FROM known) AND site <> 'de'""",
)(
    lambda s, d: plans.seed_sites(
        job_pages(s, d), _known(s, d, discovery.seed_candidate), _skip(s, d, discovery.seed_candidate), "page_id"
    ).select("page_id", "domain", "site")
)

_SLICES = ["*.wd7.myworkdayjobs.com/*/job/*", "*.wd6.myworkdayjobs.com/*/job/*", "*.myworkdayjobs.com/*/job/*"]
query(
    "discover_slices",
    _W + """, hits AS (
        SELECT *, 0 AS slice FROM cand WHERE domain LIKE '%.wd7.myworkdayjobs.com'
        UNION ALL SELECT *, 1 FROM cand WHERE domain LIKE '%.wd6.myworkdayjobs.com'
        UNION ALL SELECT *, 2 FROM cand)
    SELECT slice, page_id, domain, site FROM (SELECT *, row_number() OVER (PARTITION BY lower(domain || '|' || site)
        ORDER BY slice, page_id) AS rn FROM hits WHERE NOT contains(domain, 'spam')) WHERE rn = 1""",
)(
    lambda s, d: discovery.discover_slices(
        discovery.slice_matches(
            job_pages(s, d)
            .select("page_id", "url", discovery.archive_candidate("url").alias("c"))
            .filter("c IS NOT NULL")
            .select("page_id", "url", "c.*"),
            "url", _SLICES,
        ),
        "slice", "page_id", ~F.contains("domain", F.lit("spam")),
    ).select("slice", "page_id", "domain", "site")
)

# --- probing ---------------------------------------------------------------------------------------

_SITES = ["signup", "view", "click", "purchase", "error"]
_ATTEMPT = "list_position([" + ", ".join(q(x) for x in _SITES) + "], event_type)"
query(
    "first_valid_probe",
    f"""WITH p AS (SELECT user_id, {_ATTEMPT} AS attempt, event_type AS site, max(value) > 95 AS ok, max(value) AS best
        FROM events GROUP BY 1, 2, 3), f AS (SELECT user_id, min(attempt) AS attempt FROM p WHERE ok GROUP BY 1)
    SELECT p.user_id, f.attempt, max(CASE WHEN p.attempt = f.attempt THEN site END) AS site,
        string_agg(site, ';' ORDER BY p.attempt) AS attempted FROM p JOIN f USING (user_id) WHERE p.attempt <= f.attempt GROUP BY 1, 2""",
)(
    lambda s, d: discovery.first_valid_probe(
        table(s, d, "events").select(
            "user_id", F.col("event_type").alias("site"), (F.col("value") > 95).alias("ok"),
            F.array_position(F.array(*[F.lit(x) for x in _SITES]), F.col("event_type")).cast("int").alias("attempt"),
        ),
        "user_id", "attempt", "site", "ok",
    )
)


def _order_lists(s, d):
    """A list payload per order: its line items as JSON."""
    item = F.struct(
        F.col("l_linenumber").alias("n"), F.col("l_partkey").cast("string").alias("id"), F.col("l_returnflag").alias("name")
    )
    lists = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return lists.select("l_orderkey", F.to_json("items").alias("body"))


query(
    "probe_to_catalog",
    """SELECT l_orderkey, CAST(count(*) AS INTEGER) AS job_links_found,
    'https://site/' || arg_min(CAST(l_partkey AS VARCHAR), (l_linenumber, CAST(l_partkey AS VARCHAR), l_returnflag)) AS sample_job_url,
    arg_min(l_returnflag, (l_linenumber, CAST(l_partkey AS VARCHAR), l_returnflag)) AS sample_title FROM lineitem GROUP BY l_orderkey""",
)(
    lambda s, d: discovery.probe_to_catalog(
        _order_lists(s, d).withColumn("items", F.from_json("body", "array<struct<n:int,id:string,name:string>>")),
        "l_orderkey", "items", lambda j: F.concat(F.lit("https://site/"), j["id"]), lambda j: j["name"],
    )
)

query(
    "sample_estimate",
    """SELECT l_suppkey, count(*) AS total_jobs, count_if(l_returnflag = 'R') AS hits,
        round(100.0 * count_if(l_returnflag = 'R') / count(*), 2) AS hit_pct FROM lineitem GROUP BY 1""",
)(lambda s, d: discovery.sample_estimate(table(s, d, "lineitem"), "l_suppkey", F.col("l_returnflag") == "R"))

# --- ranking and lists ------------------------------------------------------------------------------------

_WORDS = [(w, 3) for w in rules.IT_TENANT_SIGNALS] + [(w, -4) for w in rules.NON_IT_TENANT_SIGNALS]
_PRIORITY = " + ".join(f"CASE WHEN contains(c, {q(w)}) THEN {n} ELSE 0 END" for w, n in _WORDS)
_PARTS = """(SELECT p_partkey, p_name || ' ' || p_type || '.' || p_brand AS domain, CAST(p_size AS VARCHAR) AS job_count,
    regexp_replace(lower(split_part(p_name || ' ' || p_type || '.' || p_brand, '.', 1)), '[^a-z0-9]+', '', 'g') AS c FROM part)"""
query(
    "rank_sites",
    f"""SELECT p_partkey, domain, CAST({_PRIORITY} + CASE WHEN {s_match('c', rules.PREFERRED_TENANTS)} THEN 5 ELSE 0 END
    + CASE WHEN {s_match('c', rules.AVOIDED_TENANTS)} THEN -5 ELSE 0 END AS INTEGER) AS priority,
    CAST(job_count AS INTEGER) AS jobs FROM {_PARTS}""",
)(
    lambda s, d: ordering.rank_sites(
        table(s, d, "part").select(
            "p_partkey", F.concat("p_name", F.lit(" "), "p_type", F.lit("."), "p_brand").alias("domain"),
            F.col("p_size").cast("string").alias("job_count"),
        ),
        "p_partkey",
    ).select("p_partkey", "domain", "priority", "jobs")
)

query(
    "skip_take",
    """SELECT c_mktsegment || c_nationkey AS identifier, c_mktsegment || c_nationkey AS company, min(c_custkey) AS c_custkey
    FROM customer GROUP BY 1, 2 ORDER BY 3 LIMIT 50 OFFSET 20""",
)(
    lambda s, d: ordering.company_rows(
        table(s, d, "customer").select(
            F.concat("c_mktsegment", F.col("c_nationkey").cast("string")).alias("company"), "c_custkey"
        ),
        "c_custkey", skip=20, take=50,
    )
)

query(
    "skip_list_union",
    """WITH u AS (SELECT 0 AS r, s_suppkey AS o, 'n' || s_nationkey AS domain, 'main' AS site, 'supplier' AS source_file FROM supplier
        UNION ALL SELECT 1, c_custkey, 'n' || c_nationkey, c_mktsegment, 'customer' FROM customer)
    SELECT domain, site, source_file FROM (SELECT *, row_number() OVER (PARTITION BY lower(domain || '|' || site) ORDER BY r, o) AS rn FROM u) WHERE rn = 1""",
)(
    lambda s, d: discovery.extend_skip_list(
        [
            ("supplier", table(s, d, "supplier").select(
                F.col("s_suppkey").alias("o"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("domain"),
                F.lit("main").alias("site"))),
            ("customer", table(s, d, "customer").select(
                F.col("c_custkey").alias("o"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("domain"),
                F.col("c_mktsegment").alias("site"))),
        ],
        "o",
    )
)

query(
    "any_column_domains",
    f"""SELECT DISTINCT domain FROM (SELECT CASE WHEN h LIKE '%.example.com' THEN h ELSE '' END AS domain
    FROM (SELECT {s_host('url')} AS h FROM pages)) WHERE domain <> ''""",
)(
    lambda s, d: discovery.any_column_hosts(
        table(s, d, "pages").select("page_id", "url"), lambda c: host_if_suffix(c, ".example.com")
    )
)

query(
    "first_domain_row",
    f"SELECT domain, min(page_id) AS page_id FROM (SELECT page_id, {_HOST} AS domain FROM pages) WHERE domain <> '' GROUP BY 1",
)(
    lambda s, d: first_per_key(
        table(s, d, "pages").select("page_id", normalize_domain("url").alias("domain")), "domain", ["page_id"], "drop"
    )
)

