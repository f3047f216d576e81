"""The flagship ingest and the streaming forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobweave.plans.ingest import ingest
from jobweave.queries.base import (
    query, s_blank, s_category, s_city, s_clean, s_fingerprint, s_it_score, s_key, s_parts, s_state, table,
)
from jobweave.queries.jobsview import LOADED_AT, STORED_CTE, jobs, stored
from jobweave.queries.maintenance import COLS, REFRESH_CTE, _insert_sql
from jobweave.schema import JOBS_STD, TABLE_COLUMNS, conform
from jobweave.session import shared_folder
from jobweave.sources.snapshots import SnapshotTable
from jobweave.streaming.ingest import first_within, ingest_stream, keep_state_on_disk, read_landed


def _postings(s, d):
    return conform(jobs(s, d, spread=True).withColumn("source_name", F.lit("orders")).withColumn("part", F.lit(0)), JOBS_STD)


# the batch after expansion: one row per place, keyed by (seq, part)
_EXPANDED = f"""
    parted AS (SELECT *, {s_parts('location')} AS places FROM jobs),
    ejobs AS (SELECT * EXCLUDE (places, place, location, external_id, p), place AS location, CAST(p AS INTEGER) AS part,
        CASE WHEN len(places) <= 1 OR {s_blank('external_id')} THEN external_id ELSE external_id || ':L' || left(sha256(lower(place)), 32) END AS external_id
        FROM (SELECT *, unnest(CASE WHEN len(places) = 0 THEN [location] ELSE places END) AS place,
            unnest(range(greatest(len(places), 1))) AS p FROM parted))"""
_FP = s_fingerprint("title", "company", "location")
_FPT = s_fingerprint('"Title"', "company", '"Location"')
_STATUS = f"""
    slim AS (SELECT seq, part, {s_key('external_id')} AS r, {s_key('job_url')} AS u, {_FP} AS f FROM ejobs),
    flagged AS (SELECT *, (r <> '' AND r IN (SELECT {s_key('job_reference')} FROM stored))
        OR (r = '' AND u <> '' AND u IN (SELECT {s_key('url')} FROM stored))
        OR (f <> '' AND f IN (SELECT {_FPT} FROM stored)) AS hit FROM slim),
    stage1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY
        CASE WHEN r <> '' THEN 'r:' || r WHEN u <> '' THEN 'u:' || u ELSE 'n:' || seq || ',' || part END ORDER BY seq, part) AS rn
        FROM flagged WHERE NOT hit) WHERE rn = 1),
    stage2 AS (SELECT seq, part FROM (SELECT *, row_number() OVER (PARTITION BY
        CASE WHEN f <> '' THEN 'f:' || f ELSE 'n:' || seq || ',' || part END ORDER BY seq, part) AS rn2 FROM stage1) WHERE rn2 = 1),
    status AS (SELECT flagged.seq, flagged.part, CASE WHEN hit THEN 'existing' WHEN stage2.seq IS NOT NULL THEN 'new' ELSE 'batch_duplicate' END AS status
        FROM flagged LEFT JOIN stage2 ON flagged.seq = stage2.seq AND flagged.part = stage2.part)"""
_SCORE = s_it_score("title", "category", "description")
_STAGE = f"""
    prepared AS (SELECT ejobs.*, {s_category('category', 'title', 'description')} AS cat, {_SCORE} AS score
        FROM ejobs JOIN status USING (seq, part) WHERE status = 'existing'),
    staged AS (SELECT * FROM (SELECT (seq, part) AS sid, {s_clean('location')} AS s_location, {s_clean('title')} AS s_title,
        {s_city('location')} AS s_city, {s_state('location')} AS s_state, {s_clean('job_type')} AS s_job_type,
        date_posted AS s_posted_at, {s_clean('company')} AS s_company, CAST(is_remote AS INTEGER) AS s_remote,
        {s_clean('cat')} AS s_category, {s_clean('job_url')} AS s_url, {s_clean('description')} AS s_description,
        score > 0 AS s_it, score AS s_score, {s_key('external_id')} AS nr, {s_key('job_url')} AS nu,
        {s_key('title')} AS nt, {s_key('company')} AS nc, {s_key('location')} AS nl,
        row_number() OVER (PARTITION BY {s_key('external_id')}, {s_key('job_url')}, {s_key('title')},
            {s_key('company')}, {s_key('location')} ORDER BY seq DESC, part DESC) AS rn FROM prepared) WHERE rn = 1)"""
_TSCORE = s_it_score('"Title"', "category", "description")
_FLAGSHIP = f"""WITH {STORED_CTE},{_EXPANDED},{_STATUS},{_STAGE},{REFRESH_CTE},
    fresh AS (SELECT ejobs.* FROM ejobs JOIN status USING (seq, part) WHERE status = 'new'),
    whole AS (SELECT row_id, {COLS} FROM pass3 UNION ALL BY NAME
        SELECT 'new:' || job_reference AS row_id, * FROM ({_insert_sql('fresh', key="CAST(seq AS VARCHAR), CAST(part AS VARCHAR)")})),
    numbered AS (SELECT whole.*, coalesce(stored.row_order, -1) AS row_order FROM whole LEFT JOIN stored USING (row_id)),
    cand AS (SELECT row_order, {_TSCORE} AS score, {s_key('job_reference')} AS r, {s_key('url')} AS u
        FROM numbered WHERE "IsIT" IS NULL OR "ITScore" IS NULL),
    by_ref AS (SELECT r, max(row_order) AS o FROM cand WHERE r <> '' GROUP BY r),
    by_url AS (SELECT u, max(row_order) AS o FROM cand WHERE u <> '' GROUP BY u),
    win AS (SELECT numbered.*, greatest(a.o, b.o) AS o FROM numbered
        LEFT JOIN by_ref a ON {s_key('job_reference')} = a.r LEFT JOIN by_url b ON {s_key('url')} = b.u)
    SELECT row_id, {COLS} FROM (SELECT win.* REPLACE (CASE WHEN cand.score IS NULL THEN "IsIT" ELSE cand.score > 0 END AS "IsIT",
        coalesce(cand.score, "ITScore") AS "ITScore") FROM win LEFT JOIN cand ON cand.row_order = win.o)"""


@query("ingest_flagship", _FLAGSHIP)
def ingest_flagship(s, d):
    """Expand, classify, split, refresh, insert and fill flags: the stored table afterwards."""
    return ingest(_postings(s, d), stored(s, d, spread=True), LOADED_AT).table.select("row_id", *TABLE_COLUMNS)


@query(
    "stream_ingest",
    """SELECT user_id, event_type, max(event_id) AS last_event, count(*) AS n FROM (SELECT user_id, event_type, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1) GROUP BY ALL""",
)
def stream_ingest(s, d):
    """Events as postings (one reference per user and type) through the streaming ingest: the
    first event of each reference is the stored one."""
    events = table(s, d, "events")
    store = SnapshotTable(s, shared_folder(s, "stream-table"))
    landed = read_landed(s, d, events.schema, "events.parquet")
    postings = landed.select(
        F.lit("events").alias("source_name"), F.col("event_id").alias("seq"), F.lit(0).alias("part"),
        F.col("event_type").alias("title"), F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("company"),
        F.lit("Austin, TX").alias("location"), F.lit(None).cast("string").alias("description"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("job_url"), F.lit("").alias("job_type"),
        F.lit(False).alias("is_remote"), F.lit("").alias("category"), F.col("ts").alias("date_posted"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), "event_type").alias("external_id"), F.lit(1).alias("source_id"),
    )
    run = ingest_stream(postings, store, shared_folder(s, "stream-offsets"), LOADED_AT)
    run.awaitTermination()
    return store.read().select(
        F.split_part("job_reference", F.lit("-"), F.lit(1)).cast("bigint").alias("user_id"),
        F.col("Title").alias("event_type"),
        F.substr("url", F.lit(2)).cast("bigint").alias("last_event"),
    ).groupBy("user_id", "event_type").agg(F.max("last_event").alias("last_event"), F.count(F.lit(1)).alias("n"))


@query("stream_dedupe", "SELECT event_id, count(*) AS n FROM events GROUP BY event_id")
def stream_dedupe(s, d):
    """Every event lands twice; one copy passes."""
    keep_state_on_disk(s)
    events = table(s, d, "events")
    landed = read_landed(s, d, events.schema, "events.parquet")
    landed = landed.withColumn("ts", F.col("ts").cast("timestamp"))
    twice = landed.unionByName(landed)
    path = shared_folder(s, "stream-dedupe")
    run = (
        first_within(twice, ["event_id"], "ts", "7 days")
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", shared_folder(s, "stream-dedupe-offsets"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return s.read.schema(twice.schema).parquet(path).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
