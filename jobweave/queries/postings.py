"""Batch queries over the jobs-like view: filters, expansion, de-duplication, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobweave import rules
from jobweave.functions.classify import with_it_flags
from jobweave.functions.location import geo_allowed, is_us
from jobweave.functions.text import is_blank
from jobweave.operators.key_index import KINDS, KeyIndex, estimated_sizes, key_sketches
from jobweave.operators import dedupe, expand, filters, keys, merge, ordering, reports, upsert
from jobweave.queries.base import (
    q, query, s_any, s_blank, s_city, s_clean, s_fingerprint, s_is_us, s_it_score, s_key, s_match,
    s_parts, s_state, s_trim, table,
)
from jobweave.queries.jobsview import JOBS_CTE, LOADED_AT, STORED_CTE, jobs, stored

W = "WITH " + JOBS_CTE
WS_ = "WITH " + STORED_CTE

# --- filters ---------------------------------------------------------------------------

query("is_us", W + f" SELECT seq, location, {s_is_us('location')} AS is_us FROM jobs")(
    lambda s, d: jobs(s, d).select("seq", "location", is_us("location").alias("is_us"))
)

query(
    "us_or_remote",
    W + f""" SELECT seq, location, is_remote, TRUE AS remote_counts FROM jobs WHERE {s_is_us('location')} OR is_remote
    UNION ALL SELECT seq, location, is_remote, FALSE FROM jobs WHERE {s_is_us('location')}""",
)(
    lambda s, d: filters.us_or_remote(jobs(s, d), True)
    .select("seq", "location", "is_remote", F.lit(True).alias("remote_counts"))
    .unionByName(
        filters.us_or_remote(jobs(s, d), False).select(
            "seq", "location", "is_remote", F.lit(False).alias("remote_counts")
        )
    )
)

query("it_only", W + f" SELECT seq, title, category FROM jobs WHERE {s_it_score('title', 'category', q(''))} > 0")(
    lambda s, d: filters.it_only(jobs(s, d)).select("seq", "title", "category")
)

query("missing_flags", WS_ + " SELECT row_id, Title FROM stored WHERE IsIT IS NULL OR ITScore IS NULL")(
    lambda s, d: filters.missing_flags(stored(s, d)).select("row_id", "Title")
)

SUSPECT = f"""((coalesce(contains(Location, ';'), FALSE) OR {s_match('Location', '(?i)US/[A-Z][A-Z]/')}
    OR {s_match('city', '[;|]')} OR length(rtrim(coalesce(city, ''))) > 50)
    AND job_reference IS NOT NULL AND NOT {s_match(s_key('job_reference'), rules.VARIANT_REFERENCE)})"""
query("multi_loc_suspects", WS_ + f" SELECT row_id, Location, city FROM stored WHERE {SUSPECT}")(
    lambda s, d: filters.multi_location_suspects(stored(s, d)).select("row_id", "Location", "city")
)

UNSAFE = f"""({s_match('city', '[;|]')} OR length(rtrim(coalesce(city, ''))) > 50
    OR {s_match('city', '(?i)^US Remote')})"""
query("unsafe_city", WS_ + f" SELECT row_id, city FROM stored WHERE {UNSAFE}")(
    lambda s, d: filters.unsafe_city(stored(s, d)).select("row_id", "city")
)

query(
    "changed_only",
    WS_ + f""" SELECT row_id, city, state, {s_city('Location')} AS new_city, {s_state('Location')} AS new_state
    FROM stored WHERE {s_key('city')} <> {s_key(s_city('Location'))} OR {s_key('state')} <> {s_key(s_state('Location'))}""",
)(
    lambda s, d: filters.changed_only(
        stored(s, d).select(
            "row_id", "city", "state",
            upsert.city_of("Location").alias("new_city"), upsert.state_of("Location").alias("new_state"),
        ),
        ("city", "new_city"), ("state", "new_state"),
    )
)

query("pick_company", "SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) = 'machinery' OR lower(c_name) = 'machinery'")(
    lambda s, d: filters.pick_company(table(s, d, "customer"), "machinery", "c_mktsegment", "c_name").select(
        "c_custkey", "c_mktsegment"
    )
)

query(
    "geo_keywords",
    W + f""" SELECT seq, location, location = '' OR {s_any('location', rules.REMOTIVE_GEO)} AS wide,
    location = '' OR {s_any('location', rules.WWR_GEO)} AS narrow FROM jobs""",
)(
    lambda s, d: jobs(s, d).select(
        "seq", "location", geo_allowed("location", rules.REMOTIVE_GEO).alias("wide"),
        geo_allowed("location", rules.WWR_GEO).alias("narrow"),
    )
)

query(
    "listed_only",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN FALSE WHEN 'O' THEN TRUE END AS isListed FROM orders WHERE o_orderstatus <> 'F'",
)(
    lambda s, d: filters.listed_only(
        table(s, d, "orders").select(
            "o_orderkey",
            F.when(F.col("o_orderstatus") == "F", False).when(F.col("o_orderstatus") == "O", True).alias("isListed"),
        )
    )
)

query(
    "validated_sites",
    """SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0 AND s_nationkey <> 0""",
)(
    lambda s, d: filters.validated_sites(
        table(s, d, "supplier").select(
            "s_suppkey", "s_name",
            F.when(F.col("s_acctbal") > 0, "True").otherwise("False").alias("validated"),
            F.when(F.col("s_nationkey") == 0, " ").otherwise(F.col("s_name")).alias("api_url"),
        )
    ).select("s_suppkey", "s_name")
)

query(
    "login_wall",
    f"SELECT page_id, {s_any('url', rules.LOGIN_WALL_URL)} OR {s_any('html', rules.LOGIN_WALL_HTML)} AS walled FROM pages",
)(lambda s, d: table(s, d, "pages").select("page_id", filters.login_wall("url", "html").alias("walled")))

query(
    "jobs_scan_nonblank",
    W + f""" SELECT external_id, job_url, title FROM jobs
    WHERE NOT ({s_blank('external_id')} AND {s_blank('job_url')} AND {s_blank('title')})""",
)(lambda s, d: filters.scan_nonblank(jobs(s, d), "external_id", "job_url", "title"))

# --- expansion ----------------------------------------------------------------------------

_VARIANTS = f"""parted AS (SELECT *, {s_parts('location')} AS places FROM jobs),
    exploded AS (SELECT *, unnest(CASE WHEN len(places) = 0 THEN [location] ELSE places END) AS place,
        unnest(range(greatest(len(places), 1))) AS part FROM parted)"""
query(
    "expand_locations",
    W + "," + _VARIANTS + f""" SELECT seq, CAST(part AS INTEGER) AS part, place AS location,
    CASE WHEN len(places) <= 1 OR {s_blank('external_id')} THEN external_id
         ELSE external_id || ':L' || left(sha256(lower(place)), 32) END AS external_id FROM exploded""",
)(
    lambda s, d: expand.expand_locations(jobs(s, d).select("seq", "location", "external_id")).select(
        "seq", "part", "location", "external_id"
    )
)

query(
    "expansion_counts",
    W + f""" SELECT count_if(len({s_parts('location')}) > 1) AS expanded_postings,
    CAST(sum(greatest(len({s_parts('location')}), 1) - 1) AS BIGINT) AS added_rows FROM jobs""",
)(
    lambda s, d: expand.expansion_counts(
        jobs(s, d), expand.expand_locations(jobs(s, d).select("seq", "location", "external_id"))
    )
)

# --- keys and de-duplication -----------------------------------------------------------------

_FP = s_fingerprint("title", "company", "location")
_FPT = s_fingerprint("Title", "company", "Location")
STATUS_CTE = f"""
    slim AS (SELECT seq, {s_key('external_id')} AS r, {s_key('job_url')} AS u, {_FP} AS f FROM jobs),
    flagged AS (SELECT *, (r <> '' AND r IN (SELECT {s_key('job_reference')} FROM stored))
        OR (r = '' AND u <> '' AND u IN (SELECT {s_key('url')} FROM stored))
        OR (f <> '' AND f IN (SELECT {_FPT} FROM stored)) AS hit FROM slim),
    stage1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY
        CASE WHEN r <> '' THEN 'r:' || r WHEN u <> '' THEN 'u:' || u ELSE 'n:' || seq END ORDER BY seq) AS rn
        FROM flagged WHERE NOT hit) WHERE rn = 1),
    stage2 AS (SELECT seq FROM (SELECT seq, row_number() OVER (PARTITION BY
        CASE WHEN f <> '' THEN 'f:' || f ELSE 'n:' || seq END ORDER BY seq) AS rn2 FROM stage1) WHERE rn2 = 1),
    status AS (SELECT seq, CASE WHEN hit THEN 'existing' WHEN seq IN (SELECT seq FROM stage2) THEN 'new'
        ELSE 'batch_duplicate' END AS status FROM flagged)"""

query("split_existing_new", WS_ + "," + STATUS_CTE + " SELECT jobs.seq, title, company, status FROM jobs JOIN status USING (seq)")(
    lambda s, d: dedupe.split_batch(jobs(s, d), stored(s, d)).select("seq", "title", "company", "status")
)
query("dedupe_counts", WS_ + "," + STATUS_CTE + " SELECT status, count(*) AS n FROM status GROUP BY status")(
    lambda s, d: dedupe.status_counts(dedupe.batch_status(jobs(s, d), stored(s, d)))
)

query("key_index_status", WS_ + "," + STATUS_CTE + " SELECT status, count(*) AS n FROM status GROUP BY status")(
    lambda s, d: dedupe.status_counts(dedupe.batch_status(jobs(s, d), KeyIndex(s).build(stored(s, d).filter("row_order % 2 = 0")).add(stored(s, d))))
)

_BATCH_CTE = STATUS_CTE.replace("WHERE NOT hit", "")
query("batch_dedupe", WS_ + "," + _BATCH_CTE + " SELECT seq, external_id, job_url, title FROM jobs WHERE seq IN (SELECT seq FROM stage2)")(
    lambda s, d: dedupe.batch_dedupe(jobs(s, d)).select("seq", "external_id", "job_url", "title")
)

query(
    "key_sizes",
    WS_ + f""" SELECT count(DISTINCT nullif({s_key('job_reference')}, '')) AS "references",
    count(DISTINCT nullif({s_key('url')}, '')) AS urls, count(DISTINCT nullif({_FPT}, '')) AS fingerprints FROM stored""",
)(lambda s, d: keys.key_sizes(stored(s, d)))

# An estimate is near when it is within a twentieth of the exact number.
@query(
    "key_estimates",
    WS_ + f""" SELECT count(DISTINCT nullif({s_key('job_reference')}, '')) AS "references", TRUE AS references_near,
    count(DISTINCT nullif({s_key('url')}, '')) AS urls, TRUE AS urls_near,
    count(DISTINCT nullif({_FPT}, '')) AS fingerprints, TRUE AS fingerprints_near FROM stored""",
)
def key_estimates(s, d):
    """Exact sizes beside those that sketches of the table's countries and companies give together."""
    exact = keys.key_sizes(stored(s, d))
    sketches = key_sketches(stored(s, d), ["company"])
    guess = estimated_sizes(sketches).select(*[F.col(c).alias(f"_{c}") for c in KINDS.values()])
    near = [(F.abs(F.col(f"_{c}") - F.col(c)) * 20 <= F.col(c)).alias(f"{c}_near") for c in KINDS.values()]
    one = F.lit(1).alias("_one")
    return exact.select("*", one).join(guess.select("*", one), "_one").select(*KINDS.values(), *near)


query(
    "first_occurrence",
    "SELECT doc_id, lang, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(text)) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1",
)(lambda s, d: dedupe.first_per_key(table(s, d, "documents"), "text", ["doc_id"], "drop").select("doc_id", "lang", "n_chars"))

for _name, _ladder, _key, _where in [
    ("dedupe_url_first", "url_first",
     f"coalesce({s_clean('job_url')}, {s_clean('external_id')}, title || '|' || company || '|' || location)", ""),
    ("dedupe_id_first", "id_first",
     f"coalesce({s_clean('external_id')}, {s_clean('job_url')}, company || '|' || title || '|' || location)", ""),
    ("dedupe_id_or_drop", "id_or_drop", f"coalesce({s_clean('external_id')}, {s_clean('job_url')})",
     f" WHERE NOT ({s_blank('external_id')} AND {s_blank('job_url')})"),
]:
    query(
        _name,
        W + f""" SELECT seq, title FROM (SELECT *, row_number() OVER (PARTITION BY lower({_key}) ORDER BY seq) AS rn
        FROM jobs{_where}) WHERE rn = 1""",
    )(lambda s, d, ladder=_ladder: dedupe.dedupe_source(jobs(s, d), ladder).select("seq", "title"))

query(
    "staging_dedupe",
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""",
)(
    lambda s, d: dedupe.last_per_keys(table(s, d, "events"), ["user_id", "event_type"], ["event_id"]).select(
        "user_id", "event_type", "event_id", "value"
    )
)

query(
    "stage_projection",
    W + f""" SELECT seq, {s_clean('location')} AS "Location", {s_clean('title')} AS "Title",
    {s_city('location')} AS city, {s_state('location')} AS state, 'USA' AS country,
    {s_clean('job_type')} AS job_type, CAST(is_remote AS INTEGER) AS "Isremote",
    {s_clean('category')} AS category, {s_key('external_id')} AS normalized_reference,
    {s_key('job_url')} AS normalized_url, {s_key('title')} AS normalized_title,
    {s_key('company')} AS normalized_company, {s_key('location')} AS normalized_location
    FROM jobs""",
)(
    lambda s, d: upsert.stage(with_it_flags(jobs(s, d)), LOADED_AT).select(
        F.col("stage_id.seq").alias("seq"), "Location", "Title", "city", "state", "country", "job_type",
        "Isremote", "category", *upsert.STAGE_KEYS,
    )
)

# --- merging --------------------------------------------------------------------------------

_MERGE = f"""
    keyed AS (SELECT *, CASE WHEN NOT {s_blank('job_url')} THEN 'u:' || {s_key('job_url')}
        WHEN NOT {s_blank('external_id')} THEN 'i:' || {s_key('external_id')} ELSE 'n:' || seq END AS k FROM jobs),
    best AS (SELECT k, seq, title, company FROM (SELECT *, row_number() OVER (PARTITION BY k
        ORDER BY length(location) DESC, length(description) DESC, seq) AS rn FROM keyed) WHERE rn = 1),
    longest AS (SELECT k, description FROM (SELECT *, row_number() OVER (PARTITION BY k
        ORDER BY length(description) DESC, seq) AS rn FROM keyed) WHERE rn = 1),
    places AS (SELECT k, min(seq) AS first_at, arg_min(location, seq) AS place FROM keyed
        WHERE NOT {s_blank('location')} GROUP BY k, lower(location)),
    joined AS (SELECT k, string_agg(place, '; ' ORDER BY first_at) AS every,
        string_agg(CASE WHEN {s_key('place')} NOT IN ('united states', 'usa', 'us') THEN place END, '; ' ORDER BY first_at) AS specific
        FROM places GROUP BY k),
    remote AS (SELECT k, bool_or(is_remote) AS is_remote FROM keyed GROUP BY k)"""
query(
    "merge_postings",
    W + "," + _MERGE + """ SELECT seq, title, company, coalesce(specific, every, '') AS location, is_remote, description
    FROM best JOIN longest USING (k) JOIN remote USING (k) LEFT JOIN joined USING (k)""",
)(
    lambda s, d: merge.merge_postings(
        jobs(s, d).select("seq", "job_url", "external_id", "title", "company", "location", "is_remote", "description")
    ).select("seq", "title", "company", "location", "is_remote", "description")
)

# --- reports --------------------------------------------------------------------------------


def _coverage_sql(column: str, filled: str, key: str = "o_orderstatus") -> str:
    return f"""SELECT {key}, '{column}' AS field, count(*) AS total, count_if({filled}) AS populated,
    count(*) - count_if({filled}) AS missing, round_even(100.0 * count_if({filled}) / count(*), 2) AS pct
    FROM jobs GROUP BY {key}"""


query(
    "coverage",
    W + " " + " UNION ALL ".join(
        _coverage_sql(c, f)
        for c, f in [
            ("job type", f"NOT {s_blank('job_type')}"), ("category", f"NOT {s_blank('category')}"),
            ("posted date", "date_posted IS NOT NULL"),
        ]
    ),
)(
    lambda s, d: reports.coverage(
        jobs(s, d), {"job type": "job_type", "category": "category", "posted date": "date_posted"}, ["o_orderstatus"]
    )
)

query(
    "top_types",
    f"""SELECT label, n FROM (SELECT lower({s_trim('event_type')}) AS k, count(*) AS n,
    arg_min({s_trim('event_type')}, event_id) AS label FROM events GROUP BY 1) ORDER BY n DESC, label LIMIT 5""",
)(lambda s, d: reports.top_values(table(s, d, "events"), "event_type", "event_id"))

_SCORE = s_it_score("title", "category", "description")
query("it_counts", W + f" SELECT {_SCORE} > 0 AS is_it, count(*) AS n FROM jobs GROUP BY 1")(
    lambda s, d: reports.class_counts(with_it_flags(jobs(s, d)))
)

query(
    "class_samples",
    W + f""" SELECT is_it, seq, title, it_score FROM (SELECT seq, title, {_SCORE} AS it_score, {_SCORE} > 0 AS is_it,
    row_number() OVER (PARTITION BY {_SCORE} > 0 ORDER BY seq) AS rn FROM jobs) WHERE rn <= 3""",
)(
    lambda s, d: ordering.class_samples(with_it_flags(jobs(s, d)), "is_it", "seq").select(
        "is_it", "seq", "title", "it_score"
    )
)

query("over_limit", WS_ + " SELECT count_if(length(rtrim(category)) > 30) AS over_limit FROM stored")(
    lambda s, d: reports.over_limit(stored(s, d))
)

query(
    "site_summary",
    W + f""" SELECT company, count(*) AS listed, count_if({s_is_us('location')} OR is_remote) AS jobs,
    count_if(({s_is_us('location')} OR is_remote) AND NOT {s_blank('description')}) AS described FROM jobs GROUP BY company""",
)(
    lambda s, d: reports.site_summary(jobs(s, d), filters.us_or_remote(jobs(s, d), True), "company")
)

# --- ordering and limits ------------------------------------------------------------------------

query("insert_limit", W + " SELECT seq, title FROM jobs ORDER BY seq LIMIT 1000")(
    lambda s, d: ordering.take_first(jobs(s, d), 1000, "seq").select("seq", "title")
)
query(
    "cap_per_site",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
    FROM orders) WHERE rn <= 4""",
)(lambda s, d: ordering.cap_per_site(table(s, d, "orders"), "o_custkey", "o_orderkey", 4).select("o_custkey", "o_orderkey"))

query(
    "top_sites",
    """SELECT o_custkey, job_links_found FROM (SELECT o_custkey, CAST(count(*) AS VARCHAR) AS job_links_found
    FROM orders GROUP BY 1) ORDER BY CAST(job_links_found AS INTEGER) DESC, o_custkey LIMIT 20""",
)(
    lambda s, d: ordering.top_sites(
        table(s, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).cast("string").alias("job_links_found")),
        20, "o_custkey",
    )
)

query(
    "field_filter",
    W + f" SELECT seq FROM jobs WHERE NOT {s_blank('external_id')} AND NOT {s_blank('job_url')} AND NOT {s_blank('category')}",
)(lambda s, d: filters.with_required(jobs(s, d), "external_id", "job_url", "category").select("seq"))
