"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobweave import rules
from jobweave.functions import classify, dates, html, ids, jsonv, location, text, url, xmlv
from jobweave.queries.base import (
    q, query, s_any, s_blank, s_city, s_clean, s_digest, s_fingerprint, s_first, s_host, s_is_us, s_it_score,
    s_key, s_match, s_parts, s_rules, s_state, s_trim, s_url_path, table,
)
from jobweave.queries.jobsview import JOBS_CTE, jobs
from jobweave.sources.normalizers import html_pages

J = "WITH " + JOBS_CTE


def _on(name: str, source: str, key: str, sql: str, **columns) -> None:
    """A query selecting ``key`` and the given column builders from a table (or the jobs view)."""
    prefix = J if source == "jobs" else ""

    def run(s, d):
        df = jobs(s, d) if source == "jobs" else table(s, d, source)
        return df.select(key, *[build().alias(c) for c, build in columns.items()])

    query(name, f"{prefix} SELECT {key}, {sql} FROM {source}" if sql else None)(run)


# Text with tabs, outer blanks and mixed case, from names of the tables.
_PAD = r"chr(9) || '  ' || p_name || '  ' || p_type || chr(10)"


def _pad():
    return F.concat(F.lit("\t  "), "p_name", F.lit("  "), "p_type", F.lit("\n"))


# --- text and keys ------------------------------------------------------------------------------

_on("normalize_key", "part", "p_partkey", f"{s_key(_PAD)} AS v", v=lambda: text.normalize_key(_pad()))
_on("clean_value", "part", "p_partkey", f"{s_clean(_PAD, 12)} AS v", v=lambda: text.clean(_pad(), 12))
_on("truncate_value", "part", "p_partkey", "left(p_name, 6) AS v", v=lambda: text.truncate("p_name", 6))
_on(
    "fingerprint", "jobs", "seq", f"{s_fingerprint('title', 'company', 'category')} AS v, {s_fingerprint('category', 'company', 'title')} AS w",
    v=lambda: text.fingerprint("title", "company", "category"), w=lambda: text.fingerprint("category", "company", "title"),
)
_on(
    "first_non_empty", "jobs", "seq", f"{s_first('external_id', 'category', 'job_url', 'title')} AS v",
    v=lambda: text.first_non_empty("external_id", "category", "job_url", "title"),
)
_DOC_RUNS = r"regexp_replace(text, '[ \t\n\x0b\f\r]+', ' ', 'g')"
_on("collapse_ws", "documents", "doc_id", f"{s_trim(_DOC_RUNS)} AS v", v=lambda: text.collapse_ws("text"))
_on("alnum_lower", "part", "p_partkey", "regexp_replace(lower(p_brand || ' ' || p_name), '[^a-z0-9]', '', 'g') AS v",
    v=lambda: text.alnum_lower(F.concat("p_brand", F.lit(" "), "p_name")))
_on("upper_first", "part", "p_partkey", "upper(left(p_name, 1)) || substr(p_name, 2) AS v", v=lambda: text.upper_first("p_name"))
_LABEL = f"split_part({s_host('url')}, '.', 1)"
_NAME = f"trim(regexp_replace({_LABEL}, '[-_]+', ' ', 'g'))"
_on("company_from_domain", "pages", "page_id", f"upper(left({_NAME}, 1)) || substr({_NAME}, 2) AS v",
    v=lambda: text.company_from_domain(url.domain_from_url("url")))
_on("company_from_tenant", "part", "p_partkey", "upper(left(p_name, 1)) || substr(p_name, 2) AS v",
    v=lambda: text.company_from_tenant(F.replace("p_name", F.lit(" "), F.lit("_-")), F.lit("x.y")))
_on(
    "title_cleaners", "part", "p_partkey",
    "p_name AS bar, p_type AS hiring, p_name AS page, p_name AS role, p_type AS employer, p_brand AS page_company, p_type AS after_bar, p_name AS suffix",
    bar=lambda: text.cut_after_bar(F.concat("p_name", F.lit(" | "), "p_type")),
    hiring=lambda: text.strip_hiring_for(F.concat(F.lit("Hiring for "), "p_type")),
    page=lambda: text.strip_career_page(F.concat("p_name", F.lit(" - "), "p_brand", F.lit(" - Career Page"))),
    role=lambda: text.title_before_at(F.concat("p_name", F.lit(" at "), "p_type")),
    employer=lambda: text.company_after_at(F.concat("p_name", F.lit(" at "), "p_type")),
    page_company=lambda: text.company_from_career_page_title(F.concat("p_name", F.lit(" - "), "p_brand", F.lit(" - Career Page"))),
    after_bar=lambda: text.company_after_bar(F.concat("p_name", F.lit(" | "), "p_type")),
    suffix=lambda: text.strip_careers_suffix(F.concat("p_name", F.lit(" - Careers at "), "p_type")),
)
_on(
    "label_value", "jobs", "seq", "company AS department, title AS kind",
    department=lambda: text.label_value(F.concat(F.lit("Department: "), "company", F.lit(" Location: "), "location"), "Department"),
    kind=lambda: text.label_value(
        F.concat(F.lit("Employment Type: "), "title", F.lit(" Description of the job")), "Employment Type", stop_at_colon=True
    ),
)
_on("split_list", "part", "p_partkey", "[p_name, p_type] AS v",
    v=lambda: text.split_list(F.concat("p_name", F.lit("; ,"), "p_type", F.lit(" ,"), F.upper("p_name"), F.lit(";"))))
_on("json_unescape", "jobs", "seq", "title || chr(10) || company || '/\"' AS v",
    v=lambda: text.json_unescape(F.concat("title", F.lit("\\n"), "company", F.lit('\\/\\"'))))
_on(
    "location_candidate", "jobs", "seq",
    "CASE WHEN location LIKE '%Germany%' THEN '' ELSE location END AS v",
    v=lambda: text.location_candidate(
        F.concat(F.lit(" - "), "location", F.when(F.contains("location", F.lit("Germany")), F.lit(" candidate")).otherwise(F.lit(" Responsibilities: all")))
    ),
)
_on(
    "best_title", "jobs", "seq", "CASE WHEN title LIKE '%Nurse%' THEN company ELSE title END AS v",
    v=lambda: text.best_title(
        F.lit("ZR_12_JOB"), F.array(F.lit("2024-05-01"), F.lit("Full-time"), F.col("company"), F.col("title"))
    ),
)
_on("distinct_ignore_case", "part", "p_partkey", "CASE WHEN lower(p_name) = lower(p_type) THEN [p_name] ELSE [p_name, p_type] END AS v",
    v=lambda: text.distinct_ignore_case(F.array("p_name", F.upper("p_name"), "p_type", F.initcap("p_name"))))

# --- urls ---------------------------------------------------------------------------------------------

_HOST = f"regexp_replace(trim(split_part(regexp_replace(lower(url), '^https?://', ''), '/', 1), '.'), '^www\\.', '')"
_on("normalize_domain", "pages", "page_id", f"{_HOST} AS v", v=lambda: url.normalize_domain("url"))
_on(
    "host_if_suffix", "pages", "page_id",
    f"CASE WHEN {s_host('url')} LIKE '%.example.com' THEN {s_host('url')} ELSE '' END AS v, CASE WHEN {s_host('url')} LIKE '%.example.net' THEN {s_host('url')} ELSE '' END AS w",
    v=lambda: url.host_if_suffix("url", ".example.com"),
    w=lambda: url.host_if_suffix(F.regexp_replace("url", "^https?://", ""), ".example.net"),
)
_on("domain_from_url", "pages", "page_id", f"{s_host('url')} AS v", v=lambda: url.domain_from_url("url"))
_on("tenant_key", "pages", "page_id", f"regexp_replace({s_host('url')}, '^www\\.', '') AS v", v=lambda: url.tenant_key("url"))
_on("workday_host", "part", "p_partkey", "replace(p_name, ' ', '-') AS tenant, 'wd' || p_size AS server, '' AS other",
    tenant=lambda: url.workday_host(F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(".wd"), F.col("p_size").cast("string"), F.lit(".myworkdayjobs.com")))[0],
    server=lambda: url.workday_host(F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(".wd"), F.col("p_size").cast("string"), F.lit(".myworkdayjobs.com")))[1],
    other=lambda: url.workday_host(F.concat("p_name", F.lit(".example.com")))[0])
_on(
    "job_urls", "jobs", "seq",
    """CASE WHEN external_id = '' THEN 'https://d.com/en-US/s/job/' ELSE 'https://d.com/en-US/s/job/' || external_id END AS page,
    CASE WHEN job_url = '' THEN 'https://d.com/en-US/s/job/' ELSE job_url END AS absolute,
    'https://d.com/wday/cxs/t/s/job/' || external_id AS detail, 'https://d.com/hcmUI/CandidateExperience/en/sites/CX/job/' || seq AS oracle""",
    page=lambda: url.workday_job_url(F.lit("d.com"), F.lit("s"), "external_id"),
    absolute=lambda: url.workday_job_url(F.lit("d.com"), F.lit("s"), "job_url"),
    detail=lambda: url.workday_detail_url(F.lit("d.com"), F.lit("t"), F.lit("s"), F.concat(F.lit("/job/"), "external_id")),
    oracle=lambda: url.oracle_job_url(F.lit("d.com"), F.lit("CX"), F.col("seq").cast("string")),
)
_IDS = {
    "icims": ("'https://x/jobs/' || page_id || '/a-b/job'", lambda k: F.concat(F.lit("https://x/jobs/"), k, F.lit("/a-b/job"))),
    "jazzhr": ("'https://x/apply/' || page_id || '/a'", lambda k: F.concat(F.lit("https://x/apply/"), k, F.lit("/a"))),
    "pinpointhq": ("'https://x/en/jobs/' || page_id", lambda k: F.concat(F.lit("https://x/en/jobs/"), k)),
    "catsone": ("'https://x/jobs/' || page_id || '-role'", lambda k: F.concat(F.lit("https://x/jobs/"), k, F.lit("-role"))),
    "successfactors": ("'https://x/c?career_job_req_id=' || page_id || '&a=1'", lambda k: F.concat(F.lit("https://x/c?career_job_req_id="), k, F.lit("&a=1"))),
}
_on(
    "id_from_url", "pages", "page_id",
    ", ".join(f"CAST(page_id AS VARCHAR) AS {n}" for n in _IDS)
    + ", 'id-' || page_id AS zoho_query, url AS none",
    **{n: (lambda n=n, b=b: url.id_from_url(b(F.col("page_id").cast("string")), n)) for n, (_, b) in _IDS.items()},
    zoho_query=lambda: url.id_from_url(F.concat(F.lit("https://x/PortalDetail?jobid=id-"), F.col("page_id").cast("string")), "zohorecruit"),
    none=lambda: url.id_from_url("url", "icims"),
)
_UID = "'0000000a-00bb-0ccc-dddd-' || lpad(CAST(page_id AS VARCHAR), 12, '0')"
_on("posting_uuid", "pages", "page_id", f"{_UID} AS v, {_UID} AS w, '' AS none",
    v=lambda: url.posting_uuid(F.concat(F.lit("x/0000000A-00BB-0CCC-DDDD-"), F.lpad(F.col("page_id").cast("string"), 12, "0"))),
    w=lambda: url.posting_uuid_in_html(F.concat("html", F.lit("/postings/0000000A-00BB-0CCC-DDDD-"), F.lpad(F.col("page_id").cast("string"), 12, "0"))),
    none=lambda: url.posting_uuid("url"))
_on("title_from_url", "part", "p_partkey", "p_name AS v, p_name AS w",
    v=lambda: url.title_from_url(F.concat(F.lit("https://x/jobs/7/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("/job")), "icims"),
    w=lambda: url.title_from_url(F.concat(F.lit("https://x/apply/a7/"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("?a=1")), "jazzhr"))
_ORIGIN = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"
_on(
    "resolve_link", "pages", "page_id",
    f"{_ORIGIN} || '/jobs/1' AS root, 'http://a.b/c' AS absolute, {_ORIGIN} || regexp_extract(url, '^[a-z]+://[^/?#]*(/(?:[^?#]*/)?)', 1) || 'x' AS relative, regexp_extract(url, '^([a-z]+:)', 1) || '//c.d/e' AS scheme",
    root=lambda: url.resolve("url", F.lit("/jobs/1#top")), absolute=lambda: url.resolve("url", F.lit("http://a.b/c#d")),
    relative=lambda: url.resolve("url", F.lit("x")), scheme=lambda: url.resolve("url", F.lit("//c.d/e")),
)
_on(
    "paged_search_url", "pages", "page_id",
    "'https://x/jobs/search?ss=1&in_iframe=1&pr=' || page_id AS v, 'https://x/jobs?q=a&ss=1&in_iframe=1&pr=' || page_id AS w",
    v=lambda: url.paged_search_url(F.lit("https://x/jobs/search?ss=1"), F.col("page_id")),
    w=lambda: url.paged_search_url(F.lit("https://x/jobs?q=a#f"), F.col("page_id")),
)

# --- html ---------------------------------------------------------------------------------------------------

_TAGS = "regexp_replace(html, '<[^>]+>', ' ', 'g')"
_WS = r"[ \t\n\x0b\f\r]"
_RUNS = f"regexp_replace({_TAGS}, '{_WS}{{2,}}', ' ', 'g')"
_on("strip_tags_plain", "pages", "page_id", f"md5({s_trim(_RUNS)}) AS v",
    v=lambda: F.md5(html.strip_tags_plain("html").cast("binary")))


def _s_decode(x: str) -> str:
    """The four entities the test pages use."""
    for name, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{char}')"
    return x


_SPACED = f"regexp_replace({_s_decode(_TAGS)}, '{_WS}+', ' ', 'g')"
_on("strip_tags", "pages", "page_id", f"md5({s_trim(_SPACED)}) AS v", v=lambda: F.md5(html.strip_tags("html").cast("binary")))
_on("page_text", "pages", "page_id", f"md5({s_trim(_SPACED)}) AS v", v=lambda: F.md5(html_pages.page_text("html").cast("binary")))
_on("decode_entities", "pages", "page_id", f"md5({_s_decode('html')}) AS v", v=lambda: F.md5(html.decode_entities("html").cast("binary")))
_on("decode_entities_all", "documents", "doc_id", "text || '<\"é''>' AS v",
    v=lambda: html.decode_entities(F.concat("text", F.lit("&lt;&quot;&eacute;&#39;&#x3E;"))))
_on("meta_tag", "pages", "page_id", "'v' || page_id AS v, 'v' || page_id AS w, 'v' || page_id AS x",
    **{c: (lambda f=f: html.meta(F.concat("html", F.lit(f[0]), F.col("page_id").cast("string"), F.lit(f[1])), "og:title"))
       for c, f in {"v": ('<meta property="og:title" content="v', '">'), "w": ("<meta name='og:title' data-x content='v", "'>"),
                    "x": ('<meta content="v', '" property="og:title">')}.items()})
_H1 = "regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)"
_H1_TEXT = f"regexp_replace(replace(regexp_replace({_H1}, '<[^>]+>', ' ', 'g'), '&amp;', '&'), '{_WS}+', ' ', 'g')"
_on("h1_title", "pages", "page_id", f"{s_trim(_H1_TEXT)} AS v", v=lambda: html.h1("html"))
_HEAD = "regexp_extract(html, '(?is)<(?:h1|h2|title)[^>]*>(.*?)</(?:h1|h2|title)>', 1)"
_HEAD_TEXT = f"regexp_replace({_s_decode("regexp_replace(" + _HEAD + ", '<[^>]+>', ' ', 'g')")}, '{_WS}+', ' ', 'g')"
_on("page_title", "pages", "page_id", f"{s_trim(_HEAD_TEXT)} AS v", v=lambda: html.page_title("html"))
_on(
    "job_links", "pages", "page_id",
    f"[{_ORIGIN} || '/jobs/' || page_id || '/x/job', 'https://o.p/jobs/2/job'] AS icims, [{_ORIGIN} || '/apply/A' || page_id] AS jazzhr, [{_ORIGIN} || '/careers/9/jobs/1'] AS catsone",
    icims=lambda: html.job_links(F.concat("html", F.lit('<a href="/jobs/'), F.col("page_id").cast("string"), F.lit('/x/job#a">j</a><a href="https://o.p/jobs/2/job">k</a><a href="HTTPS://O.P/jobs/2/job">'))
                                 , "url", "icims"),
    jazzhr=lambda: html.job_links(F.concat("html", F.lit("<a href='/apply/A"), F.col("page_id").cast("string"), F.lit("'>")), "url", "jazzhr"),
    catsone=lambda: html.job_links(F.concat("html", F.lit("<a href='/careers/9/jobs/1'>")), "url", "catsone"),
)
_HREFS = "regexp_extract_all(html, 'href=\"(/[^\"]*)\"', 1)"
_on("page_links", "pages", "page_id", f"len({_HREFS}) AS n, {_HREFS}[1] AS first_link",
    n=lambda: F.size(html.root_links("html")).cast("bigint"), first_link=lambda: F.get(html.root_links("html"), F.lit(0)))


def _ld(page: str):
    return F.concat(F.lit('<script type="application/ld+json">'), page, F.lit("</script>"), "html")


def _posting(kind, **fields):
    return F.to_json(F.struct(kind.alias("@type"), *[v.alias(k) for k, v in fields.items()]))


def _title():
    return F.concat(F.lit("Job "), F.col("page_id").cast("string"))


_on("json_ld_posting", "pages", "page_id", "'Job ' || page_id AS plain, 'Job ' || page_id AS listed, 'Job ' || page_id AS graph, NULL AS other",
    plain=lambda: html.job_posting(_ld(_posting(F.lit("JobPosting"), title=_title())))["title"],
    listed=lambda: html.job_posting(_ld(F.concat(F.lit('[{"@type":"Thing"},'), _posting(F.array(F.lit("Role"), F.lit("JobPosting")), title=_title()), F.lit("]"))))["title"],
    graph=lambda: html.job_posting(_ld(F.concat(F.lit('{"@graph":['), _posting(F.lit("jobposting"), title=_title()), F.lit("]}"))))["title"],
    other=lambda: html.job_posting("html")["title"])
_on("json_ld_location", "pages", "page_id", "'T' || page_id || ', TX, US | Remote' AS v, 'HQ | T' || page_id || ', TX' AS named",
    v=lambda: html.posting_location(html.job_posting(_ld(F.concat(F.lit('{"@type":"JobPosting","jobLocation":[{"address":{"addressLocality":"T'), F.col("page_id").cast("string"), F.lit('","addressRegion":"TX","addressCountry":"US"}},"Remote","remote"]}'))))),
    named=lambda: html.posting_location(html.job_posting(_ld(F.concat(F.lit('{"@type":"JobPosting","jobLocation":[{"name":"HQ","address":{"addressLocality":"x"}},{"address":{"addressLocality":"T'), F.col("page_id").cast("string"), F.lit('","addressRegion":"TX"}}]}')))), name_first=True))
_on("json_ld_fields", "pages", "page_id", "'Org ' || page_id AS company, 'FULL_TIME, TEMP' AS job_type, 'ID' || page_id AS identifier",
    company=lambda: html.posting_company(html.job_posting(_ld(F.concat(F.lit('{"@type":"JobPosting","hiringOrganization":{"name":"Org '), F.col("page_id").cast("string"), F.lit('"}}'))))),
    job_type=lambda: html.posting_job_type(html.job_posting(_ld(F.lit('{"@type":"JobPosting","employmentType":["FULL_TIME","TEMP"]}')))),
    identifier=lambda: html.posting_identifier(html.job_posting(_ld(F.concat(F.lit('{"@type":"JobPosting","identifier":{"value":"ID'), F.col("page_id").cast("string"), F.lit('"}}'))))))
_on("class_and_attribute", "pages", "page_id", "'T' || page_id AS title, 'A' || page_id AS quoted, 'B' || page_id AS bare",
    title=lambda: html.class_text(F.concat("html", F.lit('<div class="x job-title y"><b>T'), F.col("page_id").cast("string"), F.lit("</b></div>")), "job-title"),
    quoted=lambda: html.attribute(F.concat(F.lit('data-loc="A'), F.col("page_id").cast("string"), F.lit('"')), "data-loc"),
    bare=lambda: html.attribute(F.concat(F.lit("data-loc=B"), F.col("page_id").cast("string"), F.lit(" z")), "data-loc"))
_on("table_cells", "pages", "page_id", "['c' || page_id, 'a & b'] AS v",
    v=lambda: html.table_cells(F.concat("html", F.lit("<td>c"), F.col("page_id").cast("string"), F.lit("</td><td class=x> a &amp; <i>b</i></td><td> </td><td>Apply Now</td>"))))
_on("select_options", "pages", "page_id", "['1', '2'] AS k, ['x', 'p' || page_id] AS v",
    k=lambda: F.map_keys(_options()), v=lambda: F.map_values(_options()))


def _options():
    return html.select_options(F.concat(
        "html", F.lit('<select id="work_type_id"><option value="2">old</option><option value="1">x</option><option value="2">p'),
        F.col("page_id").cast("string"), F.lit("</option></select>")))


_on("embedded_field", "pages", "page_id", "'d ' || page_id || ' \"q\"' AS v",
    v=lambda: html.json_string_field(F.concat("html", F.lit('"description" : "d '), F.col("page_id").cast("string"), F.lit(' \\"q\\""')), "description"))

# --- json ------------------------------------------------------------------------------------------------------

_on("json_number", "events", "event_id", "regexp_extract(props, ':\\s*([0-9]+)', 1) AS v",
    v=lambda: jsonv.scalar(F.from_json("props", "k string")["k"]))
_on("json_scalar", "events", "event_id", "event_type AS text, NULL AS object, 'true' AS flag",
    text=lambda: jsonv.scalar(F.get_json_object(F.to_json(F.struct(F.col("event_type").alias("a"))), "$.a")),
    object=lambda: jsonv.scalar(F.from_json(F.concat(F.lit('{"a":'), "props", F.lit("}")), "a string")["a"]),
    flag=lambda: jsonv.scalar(F.from_json(F.lit('{"a":true}'), "a string")["a"]))
_on("text_or_descriptor", "events", "event_id", "event_type AS v, event_type AS w",
    v=lambda: jsonv.text_or_descriptor(F.to_json(F.struct(F.lit("i").alias("id"), F.col("event_type").alias("descriptor")))),
    w=lambda: jsonv.text_or_descriptor("event_type"))
_on("json_names", "events", "event_id", "event_type || ' / other' AS v",
    v=lambda: jsonv.names(F.concat(F.lit('[{"name":"'), "event_type", F.lit('"},{"label":"'), F.upper("event_type"), F.lit('"},"other",{"x":1}]'))))
_on("json_metadata", "events", "event_id", "event_type AS category, 'x' AS job_type",
    category=lambda: jsonv.category_metadata(F.concat(F.lit('[{"name":"Salary","value":"1"},{"label":"Team name","value":"'), "event_type", F.lit('"}]'))),
    job_type=lambda: jsonv.job_type_metadata(F.lit('[{"name":"Employment location","value":"no"},{"key":"Time Type","display_value":"x"}]')))
_on("map_lookup", "events", "event_id", "event_type AS v, 'second' AS twice, NULL AS missing",
    v=lambda: _facets()["7"], twice=lambda: _facets()["8"], missing=lambda: _facets()["9"])


def _facets():
    body = F.concat(F.lit('[{"Id":"7","Name":"'), "event_type", F.lit('"},{"Id":"8","Name":"first"},{"Id":"8","Name":"second"},{"Id":"9"}]'))
    return jsonv.id_name_map(F.from_json(body, "array<struct<Id:string,Name:string>>"))


_on("json_positional", "events", "event_id", "event_type AS v, NULL AS cut",
    v=lambda: jsonv.positional(F.array(F.lit("ID"), F.lit("Title"), F.lit("Rest")), F.array(F.col("event_id").cast("string"), F.col("event_type")))["title"],
    cut=lambda: jsonv.positional(F.array(F.lit("ID"), F.lit("Title"), F.lit("Rest")), F.array(F.col("event_id").cast("string"), F.col("event_type")))["rest"])
_on("json_translation", "events", "event_id", "event_type AS english, event_type AS other",
    english=lambda: jsonv.translation(F.from_json(F.concat(F.lit('{"de":{"title":"x"},"en":{"title":"'), "event_type", F.lit('"}}')), "map<string,string>"), "title"),
    other=lambda: jsonv.translation(F.from_json(F.concat(F.lit('{"en":{"title":" "},"fr":{"title":"'), "event_type", F.lit('"}}')), "map<string,string>"), "title"))
_on("json_sections", "events", "event_id", "'Head' || chr(10) || event_type || chr(10) || chr(10) || 'tail' AS v",
    v=lambda: jsonv.sections_text(F.from_json(F.concat(F.lit('{"a":{"title":"Head","text":"'), "event_type", F.lit('"},"b":{"text":""},"c":{"text":"tail"}}')),
                                              "map<string,struct<title:string,text:string>>"), lambda t: F.coalesce(t, F.lit(""))))
_on("json_compensation", "events", "event_id", "event_type AS text, event_type AS summary, '{\"min\":1}' AS raw",
    text=lambda: jsonv.compensation("event_type"),
    summary=lambda: jsonv.compensation(F.concat(F.lit('{"summary":"'), "event_type", F.lit('"}'))),
    raw=lambda: jsonv.compensation(F.lit('{"min":1}')))
_on("xml_fields", "events", "event_id", "event_type AS v, [event_type, 'b'] AS items",
    v=lambda: xmlv.xml_record(F.concat(F.lit("<p><id>1</id><name>"), "event_type", F.lit("</name></p>")), "id string, name string", "p")["name"],
    items=lambda: F.transform(xmlv.xml_elements(F.concat(F.lit("<p><i><n>"), "event_type", F.lit("</n></i><i><n>b</n></i></p>")), "i"), lambda i: F.regexp_extract(i, "<n>(.*)</n>", 1)))

# --- dates ---------------------------------------------------------------------------------------------------------

_on("relative_date", "part", "p_partkey",
    "CAST(DATE '2024-03-10' - CAST(p_size AS INTEGER) AS TIMESTAMP) AS ago, TIMESTAMP '2024-03-10' AS today, TIMESTAMP '2024-03-09' AS yesterday, NULL AS none",
    ago=lambda: dates.relative_date(F.concat(F.lit("Posted "), F.col("p_size").cast("string"), F.lit("+ Days Ago")), "2024-03-10"),
    today=lambda: dates.relative_date(F.lit(" posted today "), "2024-03-10"),
    yesterday=lambda: dates.relative_date(F.lit("Yesterday"), "2024-03-10"),
    none=lambda: dates.relative_date("p_name", "2024-03-10"))
_on("parse_date", "orders", "o_orderkey", ", ".join(f"o_orderdate AS {c}" for c in ("iso", "zulu", "utc", "rfc", "us", "named", "short")) + ", NULL AS none",
    **{c: (lambda f=f, p=p, x=x: dates.parse_date(F.concat(F.lit(p), F.date_format("o_orderdate", f), F.lit(x)))) for c, (f, p, x) in {
        "iso": ("yyyy-MM-dd", "", ""), "zulu": ("yyyy-MM-dd'T'HH:mm:ss", "", "Z"), "utc": ("yyyy-MM-dd HH:mm:ss", "", " UTC"),
        "rfc": ("dd MMM yyyy HH:mm:ss", "Mon, ", " GMT"), "us": ("M/d/yyyy", " ", ""), "named": ("MMMM d, yyyy", "", ""), "short": ("MMM d, yyyy", "", "")}.items()},
    none=lambda: dates.parse_date("o_orderpriority"))
_on("epoch_dates", "orders", "o_orderkey", "o_orderdate AS seconds, o_orderdate AS millis",
    seconds=lambda: dates.from_epoch_seconds(F.unix_timestamp("o_orderdate").cast("string")),
    millis=lambda: dates.from_epoch_millis((F.unix_timestamp("o_orderdate") * 1000).cast("string")))

# --- ids ----------------------------------------------------------------------------------------------------------------

_on("scoped_id", "jobs", "seq", f"'96:h' || {s_digest(chr(39) + 'bamboohr|acme.example.com|' + chr(39) + ' || external_id')} AS v",
    v=lambda: ids.scoped_id(96, "bamboohr", F.lit("https://www.Acme.example.com/x"), F.concat(F.lit(" "), "external_id")))
_on("site_scoped_id", "jobs", "seq", f"'95:h' || {s_digest(chr(39) + 'd.com|cx|' + chr(39) + ' || seq')} AS v",
    v=lambda: ids.site_scoped_id(95, F.lit("D.com"), F.lit("CX"), F.col("seq").cast("string")))
_on("plain_id", "jobs", "seq", "'91:' || seq AS v", v=lambda: ids.plain_id(91, F.col("seq").cast("string")))
_GEN = f"'workday:h' || {s_digest(chr(39) + 'd|t|s|/p|' + chr(39) + ' || title')}"
_on("workday_reference", "jobs", "seq",
    f"CASE WHEN external_id <> '' THEN external_id ELSE {_GEN} END AS v, 'R-' || seq AS from_path, {_GEN} AS generated",
    v=lambda: ids.workday_reference("external_id", F.lit("Sales"), F.lit("/p"), F.lit("D"), F.lit("T"), F.lit("S"), "title"),
    from_path=lambda: ids.workday_reference(F.lit(None).cast("string"), F.lit("Sales"), F.concat(F.lit("/job/Any-Title_R-"), F.col("seq").cast("string"), F.lit("/")), F.lit("d"), F.lit("t"), F.lit("s"), "title"),
    generated=lambda: ids.workday_reference(F.lit(" "), F.lit("No id here"), F.lit("/p"), F.lit("d"), F.lit("t"), F.lit("s"), "title"))
_on("prefer_detail_reference", "jobs", "seq",
    "CASE WHEN external_id <> '' THEN external_id ELSE 'workday:habc' END AS v, CASE WHEN external_id = '' THEN 'D' || seq ELSE external_id END AS w",
    v=lambda: ids.prefer_detail_reference(F.lit("workday:habc"), "external_id"),
    w=lambda: ids.prefer_detail_reference("external_id", F.concat(F.lit("D"), F.col("seq").cast("string"))))

# --- classification -------------------------------------------------------------------------------------------------------

_TEXT = "coalesce(title, '') || ' ' || coalesce(description, '')"
_on("infer_category", "jobs", "seq",
    f"{s_rules('title', rules.BOARD_CATEGORY_RULES)} AS board, {s_rules(_TEXT, rules.TECH_CATEGORY_RULES)} AS tech, {s_rules(_TEXT, rules.FRESHTEAM_CATEGORY_RULES)} AS freshteam, {s_rules(_TEXT, rules.BAMBOO_CATEGORY_RULES)} AS bamboo",
    board=lambda: classify.infer_category("title", table="board"), tech=lambda: classify.infer_category("title", "description"),
    freshteam=lambda: classify.infer_category("title", "description", "freshteam"), bamboo=lambda: classify.infer_category("title", "description", "bamboo"))
_NORM = f"""CASE WHEN {s_blank('job_type')} THEN '' WHEN {s_rules('job_type', rules.JOB_TYPE_RULES)} = 'Full time'
    AND NOT {s_match('job_type', '(?i)' + rules.FULL_TIME_PATTERN)} THEN {s_trim('job_type')} ELSE {s_rules('job_type', rules.JOB_TYPE_RULES)} END"""
_on("job_type", "jobs", "seq", f"{_NORM} AS normalized, {s_rules('job_type', rules.JOB_TYPE_RULES)} AS inferred, {s_rules('job_type', rules.TEXT_JOB_TYPE_RULES)} AS in_text",
    normalized=lambda: classify.normalize_job_type("job_type"), inferred=lambda: classify.infer_job_type("job_type"), in_text=lambda: classify.job_type_in_text("job_type"))
_on("it_score", "jobs", "seq", f"{s_it_score('title', 'category', 'description')} AS score, {s_it_score('title', 'category', q(''))} > 0 AS listed",
    score=lambda: classify.it_score("title", "category", "description"), listed=lambda: classify.is_it("title", "category"))
_on("remote_words", "jobs", "seq", ", ".join(f"{s_any('location || chr(32) || title', w)} AS {n}" for n, w in rules.REMOTE_WORDS.items()),
    **{n: (lambda n=n: classify.remote_in(n, "location", "title")) for n in rules.REMOTE_WORDS})
_LOC = "lower(location || ' ' || title)"
_on("remote_veto", "jobs", "seq",
    f"""{s_match(_LOC + " || ' remote'", rules.PERSONIO_REMOTE)} AND (NOT {s_any('location', rules.PERSONIO_NON_US)} OR {s_match(_LOC, '\\busa?\\b')}) AS personio,
    {s_match(_LOC + " || ' remote'", rules.JOBSOID_REMOTE)} AND (category = '' OR FALSE) AS jobsoid, {s_any('location', rules.FRESHTEAM_NON_US)} AS non_us""",
    personio=lambda: classify.personio_remote("location", "title", F.lit("Remote")),
    jobsoid=lambda: classify.jobsoid_remote("location", "title", F.lit("remote"), "category"),
    non_us=lambda: classify.names_non_us_country("location"))
_on("availability", "jobs", "seq",
    """CASE o_orderstatus WHEN 'F' THEN CASE WHEN category = '' THEN 'missing_title' ELSE 'live' END WHEN 'O' THEN 'not_found' ELSE 'http_500' END AS v,
    CASE WHEN category = '' THEN 'error' ELSE 'throttled' END AS w, 'unknown' AS x""",
    v=lambda: classify.availability(F.expr("CASE o_orderstatus WHEN 'F' THEN 200 WHEN 'O' THEN 404 ELSE 500 END"), F.lit(True), "category"),
    w=lambda: classify.availability(F.when(F.col("category") != "", F.lit(429)), F.lit(None).cast("boolean"), F.lit("")),
    x=lambda: classify.availability(F.lit(200), F.lit(False), F.lit("")))
_COMPACT = "regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g')"
_HITS = [(w, 3) for w in rules.IT_TENANT_SIGNALS] + [(w, -4) for w in rules.NON_IT_TENANT_SIGNALS]
_POINTS = " + ".join(f"CASE WHEN contains({_COMPACT}, {q(w)}) THEN {n} ELSE 0 END" for w, n in _HITS)
_on("tenant_priority", "part", "p_partkey",
    f"CAST({_POINTS} + CASE WHEN {s_match(_COMPACT, rules.PREFERRED_TENANTS)} THEN 5 ELSE 0 END + CASE WHEN {s_match(_COMPACT, rules.AVOIDED_TENANTS)} THEN -5 ELSE 0 END AS INTEGER) AS v", v=lambda: classify.tenant_priority(F.replace("p_name", F.lit(" "), F.lit("-"))))

# --- locations --------------------------------------------------------------------------------------------------------------

_on("city_state", "jobs", "seq", f"{s_city('location')} AS city, {s_state('location')} AS state",
    city=lambda: location.city_of("location"), state=lambda: location.state_of("location"))
_on("join_location", "jobs", "seq", "company || ', TX, United States' AS v, company || ', Peru' AS w",
    v=lambda: location.place("company", F.lit("TX"), location.country_name(F.lit("usa"))),
    w=lambda: location.place("company", F.lit(" "), location.country_name(F.lit("Peru"))))
_on("join_places", "jobs", "seq", "company || ' | ' || title || ' | x' AS piped, company || '; ' || title || '; x' AS whole",
    piped=lambda: location.join_places(F.array("company", F.lit(" "), F.upper("company"), "title", F.lit("x")), " | "),
    whole=lambda: location.join_places(F.array("company", "title", F.lit("x"), F.lit("X")), "; "))
_on("or_remote", "jobs", "seq", "CASE WHEN category = '' AND is_remote THEN 'Remote' ELSE category END AS v",
    v=lambda: location.or_remote("category", F.col("is_remote")))
_on("location_in_text", "jobs", "seq", "'Salem, OR' AS v, 'Remote - USA' AS titled, NULL AS plain, location AS label",
    v=lambda: location.city_state_in_text(F.concat(F.lit("work in "), F.lower("company"), F.lit(" or Salem, OR today"))),
    titled=lambda: location.location_in_title(F.concat("title", F.lit(" (Remote - USA)"))),
    plain=lambda: location.location_label("title"),
    label=lambda: F.col("location"))
_on("location_parts", "jobs", "seq", f"{s_parts('location')} AS v, len({s_parts('location')}) AS n",
    v=lambda: location.location_parts("location"), n=lambda: F.size(location.location_parts("location")).cast("bigint"))
_on("choose_source", "jobs", "seq",
    """CASE WHEN NOT contains(location, ';') AND category LIKE '%;%' THEN category ELSE location END AS expansion,
    CASE WHEN regexp_matches(location, '[;|]') OR length(location) > 50 THEN location WHEN category = '' THEN location ELSE category END AS cleanup""",
    expansion=lambda: location.expansion_source("location", "category"), cleanup=lambda: location.cleanup_source("location", "category"))
_on("safe_city", "jobs", "seq", "NOT regexp_matches(location, '[;|]') AND length(location) <= 50 AS v", v=lambda: location.safe_city("location"))
