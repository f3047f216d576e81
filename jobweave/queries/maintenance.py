"""Refresh, insert and repair jobs over the stored table."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobweave.operators import backfill, dedupe, reports, upsert
from jobweave.operators.expand import with_variants
from jobweave.queries.base import (
    query, s_blank, s_category, s_city, s_clean, s_it_score, s_key, s_match, s_parts, s_state,
)
from jobweave.queries.jobsview import LOADED_AT, STORED_CTE, jobs, stored
from jobweave.queries.postings import STATUS_CTE, SUSPECT, UNSAFE
from jobweave.schema import TABLE_COLUMNS
from jobweave.session import cut_lineage

COLS = ", ".join(f'"{c}"' for c in TABLE_COLUMNS)
AT = f"TIMESTAMP '{LOADED_AT}'"

# --- insert ---------------------------------------------------------------------------------


def _insert_sql(source: str, key: str = "CAST(seq AS VARCHAR)") -> str:
    ref = f"""coalesce({s_clean('external_id')}, 'gen-' || left(sha256(concat_ws('|', {key},
        coalesce(title, ''), coalesce(company, ''), coalesce(location, ''), coalesce(job_url, ''))), 32))"""
    category = s_category("category", "title", "description")
    score = s_it_score("title", "category", "description")
    return f"""SELECT {ref} AS job_reference, {s_clean('location')} AS "Location", {s_clean('title')} AS "Title",
    {s_city('location')} AS city, {s_state('location')} AS state, CAST(NULL AS VARCHAR) AS zip, 'USA' AS country,
    {s_clean('job_type')} AS job_type, date_posted AS posted_at, {s_clean('company')} AS company,
    CAST(is_remote AS INTEGER) AS "Isremote", {s_clean(category)} AS category, {s_clean('job_url')} AS url,
    {s_clean('description')} AS description, CAST(0 AS DECIMAL(18,2)) AS cpc, {AT} AS inserteddate,
    {score} > 0 AS "IsIT", {score} AS "ITScore" FROM {source}"""


query("insert_projection", "WITH " + STORED_CTE + " " + _insert_sql("jobs"))(
    lambda s, d: upsert.insert_rows(upsert.prepare(jobs(s, d)), LOADED_AT)
)

# --- refresh --------------------------------------------------------------------------------

_CATEGORY = s_category("category", "title", "description")
_STAGE = f"""
    prepared AS (SELECT jobs.*, {_CATEGORY} AS cat, {s_it_score('title', 'category', 'description')} AS score
        FROM jobs JOIN status USING (seq) WHERE status = 'existing'),
    staged AS (SELECT * FROM (SELECT seq AS sid, {s_clean('location')} AS s_location, {s_clean('title')} AS s_title,
        {s_city('location')} AS s_city, {s_state('location')} AS s_state, {s_clean('job_type')} AS s_job_type,
        date_posted AS s_posted_at, {s_clean('company')} AS s_company, CAST(is_remote AS INTEGER) AS s_remote,
        {s_clean('cat')} AS s_category, {s_clean('job_url')} AS s_url, {s_clean('description')} AS s_description,
        score > 0 AS s_it, score AS s_score, {s_key('external_id')} AS nr, {s_key('job_url')} AS nu,
        {s_key('title')} AS nt, {s_key('company')} AS nc, {s_key('location')} AS nl,
        row_number() OVER (PARTITION BY {s_key('external_id')}, {s_key('job_url')}, {s_key('title')},
            {s_key('company')}, {s_key('location')} ORDER BY seq DESC) AS rn FROM prepared) WHERE rn = 1)"""

_FILLED = {
    "Location": "s_location", "Title": "s_title", "city": "s_city", "state": "s_state", "country": "'USA'",
    "job_type": "s_job_type", "posted_at": "s_posted_at", "company": "s_company", "category": "s_category",
    "url": "s_url", "description": "s_description",
}
_OVER = {"Isremote": "s_remote", "IsIT": "s_it", "ITScore": "s_score", "inserteddate": AT}


def _pass_sql(name: str, before: str, best: str, on: str) -> str:
    """One refresh statement: the best staged row per key updates the rows it matches."""
    values = []
    for c in ["row_id", *TABLE_COLUMNS]:
        if c in _FILLED:
            values.append(f'CASE WHEN b.sid IS NULL THEN t."{c}" ELSE coalesce({_FILLED[c]}, t."{c}") END AS "{c}"')
        elif c in _OVER:
            values.append(f'CASE WHEN b.sid IS NULL THEN t."{c}" ELSE {_OVER[c]} END AS "{c}"')
        else:
            values.append(f't."{c}"')
    return f"""{name}_best AS (SELECT * FROM ({best}) WHERE rk = 1),
    {name} AS (SELECT {', '.join(values)} FROM {before} t LEFT JOIN {name}_best b ON {on})"""


def _best(keys: str, where: str) -> str:
    return f"SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY sid DESC) AS rk FROM staged WHERE {where}"


REFRESH_CTE = ",".join(
    [
        _pass_sql("pass1", "stored", _best("nr", "nr <> ''"), f"{s_key('t.job_reference')} = b.nr"),
        _pass_sql("pass2", "pass1", _best("nu", "nr = '' AND nu <> ''"), f"{s_key('t.url')} = b.nu"),
        _pass_sql(
            "pass3", "pass2", _best("nt, nc, nl", "nr = '' AND nu = '' AND nt <> '' AND nc <> ''"),
            f"""{s_key('t."Title"')} = b.nt AND {s_key('t.company')} = b.nc AND {s_key('t."Location"')} = b.nl""",
        ),
    ]
)


def _existing(s, d):
    incoming = jobs(s, d)
    status = dedupe.batch_status(incoming, stored(s, d)).filter(F.col("status") == "existing")
    return incoming.join(status, "seq", "left_semi")


def _refreshed(s, d):
    staged = upsert.dedupe_stage(upsert.stage(upsert.prepare(_existing(s, d)), LOADED_AT))
    return upsert.refresh(stored(s, d), cut_lineage(staged, "stage"))


_REFRESH_SQL = "WITH " + STORED_CTE + "," + STATUS_CTE + "," + _STAGE + "," + REFRESH_CTE
query("upsert_refresh", _REFRESH_SQL + f" SELECT row_id, {COLS} FROM pass3")(
    lambda s, d: _refreshed(s, d).select("row_id", *TABLE_COLUMNS)
)

_FRESH = ", fresh AS (SELECT jobs.* FROM jobs JOIN status USING (seq) WHERE status = 'new')"


def _upserted(s, d):
    incoming, target = jobs(s, d), stored(s, d)
    split = incoming.join(cut_lineage(dedupe.batch_status(incoming, target), "status"), "seq")
    return upsert.upsert(
        target, split.filter(F.col("status") == "existing"), split.filter(F.col("status") == "new"), LOADED_AT
    )


query(
    "upsert_full",
    _REFRESH_SQL + _FRESH + f""" SELECT row_id, {COLS} FROM pass3
    UNION ALL BY NAME SELECT 'new:' || job_reference AS row_id, * FROM ({_insert_sql('fresh')})""",
)(_upserted)

query(
    "repair_report",
    _REFRESH_SQL + _FRESH + f"""
    SELECT count_if(new_row IS NOT NULL AND old_row IS DISTINCT FROM new_row) AS updated,
        (SELECT count(*) FROM fresh) AS inserted, CAST(0 AS BIGINT) AS deleted,
        count_if(old_row IS NOT DISTINCT FROM new_row) AS unchanged
    FROM (SELECT row_id, row({COLS}) AS old_row FROM stored) JOIN (SELECT row_id, row({COLS}) AS new_row FROM pass3) USING (row_id)""",
)(lambda s, d: upsert.repair_report(stored(s, d), _upserted(s, d), "row_id", TABLE_COLUMNS))

# --- repair jobs -----------------------------------------------------------------------------


def _table(df):
    return df.select("row_id", *TABLE_COLUMNS)


_TSCORE = s_it_score('"Title"', "category", "description")
query(
    "it_backfill",
    "WITH " + STORED_CTE + f""",
    cand AS (SELECT row_order, {_TSCORE} AS score, {s_key('job_reference')} AS r, {s_key('url')} AS u
        FROM stored WHERE "IsIT" IS NULL OR "ITScore" IS NULL),
    by_ref AS (SELECT r, max(row_order) AS o FROM cand WHERE r <> '' GROUP BY r),
    by_url AS (SELECT u, max(row_order) AS o FROM cand WHERE u <> '' GROUP BY u),
    win AS (SELECT stored.*, greatest(a.o, b.o) AS o FROM stored
        LEFT JOIN by_ref a ON {s_key('job_reference')} = a.r LEFT JOIN by_url b ON {s_key('url')} = b.u)
    SELECT row_id, {COLS} FROM (SELECT win.* REPLACE (CASE WHEN cand.score IS NULL THEN "IsIT" ELSE cand.score > 0 END AS "IsIT",
        coalesce(cand.score, "ITScore") AS "ITScore") FROM win LEFT JOIN cand ON cand.row_order = win.o)""",
)(lambda s, d: _table(backfill.backfill_it_flags(stored(s, d))))

_CITY, _STATE = s_city('"Location"'), s_state('"Location"')
query(
    "location_backfill",
    "WITH " + STORED_CTE + f""",
    now AS (SELECT *, NOT {s_blank('"Location"')} AND ({s_key('city')} <> {s_key(_CITY)} OR {s_key('state')} <> {s_key(_STATE)}) AS off FROM stored)
    SELECT row_id, {COLS} FROM (SELECT now.* REPLACE (CASE WHEN off THEN {_CITY} ELSE city END AS city,
        CASE WHEN off THEN {_STATE} ELSE state END AS state) FROM now)""",
)(lambda s, d: _table(backfill.backfill_location_parts(stored(s, d))))

_NEWCAT = s_category("category", '"Title"', "description")
query(
    "category_backfill",
    "WITH " + STORED_CTE + f""",
    tkeys AS (SELECT stored.*, {s_key('job_reference')} AS r, {s_key('url')} AS u, {s_key('"Title"')} AS t,
        {s_key('company')} AS co, {s_key('"Location"')} AS lo, {s_key('category')} AS old FROM stored),
    src AS (SELECT row_order AS o, r, u, t, co, lo, old, {_NEWCAT} AS nc FROM tkeys
        WHERE NOT {s_blank('category')} AND {s_key('category')} <> {s_key(_NEWCAT)}),
    a AS (SELECT r, old, max(o) AS o FROM src WHERE r <> '' GROUP BY ALL),
    b AS (SELECT u, old, max(o) AS o FROM src WHERE u <> '' GROUP BY ALL),
    c AS (SELECT t, co, lo, old, max(o) AS o FROM src WHERE t <> '' AND co <> '' GROUP BY ALL),
    win AS (SELECT k.row_id, greatest(a.o, b.o, c.o) AS o FROM tkeys k
        LEFT JOIN a ON k.r = a.r AND k.old = a.old LEFT JOIN b ON k.u = b.u AND k.old = b.old
        LEFT JOIN c ON k.t = c.t AND k.co = c.co AND k.lo = c.lo AND k.old = c.old)
    SELECT row_id, {COLS} FROM (SELECT stored.* REPLACE (coalesce(src.nc, category) AS category)
        FROM stored JOIN win USING (row_id) LEFT JOIN src ON src.o = win.o)""",
)(lambda s, d: _table(backfill.backfill_categories(stored(s, d))))

query(
    "category_update",
    "WITH " + STORED_CTE + f""" SELECT category AS old_category, {_NEWCAT} AS new_category, count(*) AS n FROM stored
    WHERE NOT {s_blank('category')} AND {s_key('category')} <> {s_key(_NEWCAT)} GROUP BY ALL""",
)(
    lambda s, d: backfill.category_changes(stored(s, d))
    .groupBy(F.col("category").alias("old_category"), F.col("_new").alias("new_category"))
    .agg(F.count(F.lit(1)).alias("n"))
)

# Variants of suspect rows.  place_of: the list of places of the row's source column.
_SOURCE = f"""CASE WHEN NOT contains(coalesce("Location", ''), ';') AND {s_match('city', '[;|]')} THEN city ELSE "Location" END"""
_CLEAN_SOURCE = f"""CASE WHEN NOT {s_blank('"Location"')} AND ({s_match('"Location"', '[;|]')} OR length("Location") > 50)
    THEN "Location" WHEN {s_blank('city')} THEN "Location" ELSE city END"""


def _variant_sql(acted: str) -> str:
    """Result of an action table: kept, corrected and cleared rows, and inserted variants."""
    place = "dest"
    return f"""{acted},
    stay AS (SELECT * REPLACE (
        CASE WHEN action = 'place' THEN {s_clean(place)} ELSE "Location" END AS "Location",
        CASE WHEN action = 'place' THEN {s_city(place)} WHEN action = 'clear' THEN NULL ELSE city END AS city,
        CASE WHEN action = 'place' THEN {s_state(place)} WHEN action = 'clear' THEN NULL ELSE state END AS state)
        FROM acted WHERE action <> 'expand'),
    parts AS (SELECT *, unnest(places) AS place, unnest(range(len(places))) AS part FROM acted WHERE action = 'expand'),
    coded AS (SELECT *, job_reference || ':L' || left(sha256(lower(place)), 32) AS vref FROM parts),
    fresh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {s_key('vref')} ORDER BY row_order, part) AS rn
        FROM coded WHERE {s_key('vref')} NOT IN (SELECT {s_key('job_reference')} FROM stored)) WHERE rn = 1)
    SELECT row_id, {COLS} FROM stay UNION ALL BY NAME
    SELECT row_id || '/' || vref AS row_id, vref AS job_reference, {s_clean('place')} AS "Location",
        {s_clean('"Title"')} AS "Title", {s_city('place')} AS city, {s_state('place')} AS state,
        CAST(NULL AS VARCHAR) AS zip, 'USA' AS country, {s_clean('job_type')} AS job_type, posted_at,
        {s_clean('company')} AS company, CAST(coalesce("Isremote", 0) = 1 AS INTEGER) AS "Isremote",
        {s_clean(_NEWCAT)} AS category, {s_clean('url')} AS url, {s_clean('description')} AS description,
        CAST(0 AS DECIMAL(18,2)) AS cpc, {AT} AS inserteddate, coalesce("IsIT", FALSE) AS "IsIT",
        coalesce("ITScore", 0) AS "ITScore" FROM fresh"""


query(
    "variant_backfill",
    "WITH " + STORED_CTE + "," + _variant_sql(f"""
    sourced AS (SELECT *, {_SOURCE} AS src FROM stored),
    listed AS (SELECT *, {s_parts('src')} AS places, {s_match('src', '[;|]')} AS sep FROM sourced),
    acted AS (SELECT *, CASE WHEN NOT {SUSPECT} THEN 'keep' WHEN NOT sep THEN CASE WHEN length(city) > 50 THEN 'place' ELSE 'keep' END
        WHEN len(places) = 0 THEN 'keep' WHEN len(places) = 1 THEN 'place' WHEN {s_blank('job_reference')} THEN 'keep'
        ELSE 'expand' END AS action, CASE WHEN sep THEN places[1] ELSE src END AS dest FROM listed)"""),
)(lambda s, d: _table(backfill.backfill_variants(stored(s, d), LOADED_AT)))

_SAFE = f"({s_blank(s_city('p'))} OR (length({s_city('p')}) <= 50 AND NOT {s_match(s_city('p'), '[;|]')}))"
query(
    "city_cleanup",
    "WITH " + STORED_CTE + "," + _variant_sql(f"""
    sourced AS (SELECT *, {_CLEAN_SOURCE} AS src FROM stored),
    every AS (SELECT *, {s_parts('src')} AS all_places FROM sourced),
    listed AS (SELECT *, list_filter(all_places, lambda p: {_SAFE}) AS places FROM every),
    acted AS (SELECT *, CASE WHEN NOT {UNSAFE} THEN 'keep' WHEN len(places) = 0 THEN 'clear' WHEN len(places) = 1 THEN 'place'
        WHEN {s_blank('job_reference')} THEN 'keep' ELSE 'expand' END AS action, places[1] AS dest FROM listed)"""),
)(lambda s, d: _table(backfill.cleanup_cities(stored(s, d), LOADED_AT)))


def _variant_rows(s, d):
    rows = with_variants(stored(s, d).filter(F.col("Location").rlike("[;|]")), "Location", "job_reference")
    return rows.select(F.col("row_id").alias("original"), F.explode("_variants").alias("v")).select("original", "v.*")


_VROWS = f"""vrows AS (SELECT row_id AS original, unnest({s_parts('"Location"')}) AS place, job_reference,
    len({s_parts('"Location"')}) AS n FROM stored WHERE {s_match('"Location"', '[;|]')}),
    vref AS (SELECT original, place, {s_key("CASE WHEN n = 1 OR " + s_blank('job_reference') + " THEN job_reference ELSE job_reference || ':L' || left(sha256(lower(place)), 32) END")} AS ref FROM vrows)"""
query(
    "variant_complete",
    "WITH " + STORED_CTE + "," + _VROWS + f""",
    flags AS (SELECT *, ref <> '' AND ref IN (SELECT {s_key('job_reference')} FROM stored) AS there FROM vref)
    SELECT original, count(*) AS variants, count_if(there) AS existing, count_if(NOT there AND ref <> '') AS inserted,
        count_if(ref = '') = 0 AS complete FROM flags GROUP BY original""",
)(lambda s, d: reports.variant_complete(_variant_rows(s, d), stored(s, d)))

query(
    "variant_anti",
    "WITH " + STORED_CTE + "," + _VROWS + f"""
    SELECT original, place AS location, ref FROM vref WHERE ref <> '' AND ref NOT IN (SELECT {s_key('job_reference')} FROM stored)""",
)(
    lambda s, d: _variant_rows(s, d)
    .withColumn("ref", backfill.normalize_key("reference"))
    .filter(F.col("ref") != "")
    .join(stored(s, d).select(backfill.normalize_key("job_reference").alias("ref")).distinct(), "ref", "left_anti")
    .select("original", "location", "ref")
)

