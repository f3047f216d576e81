"""Fixed schemas: the standard posting record, the stored table and the exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

S, B, I, L, TS = T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType(), T.TimestampType()

# One normalised posting.  ``seq`` is the arrival order inside a batch; ``part``
# numbers the rows one posting turns into when its locations are expanded.
# (seq, part) identifies a row of a batch.
JOBS_STD = T.StructType(
    [
        T.StructField("source_name", S),
        T.StructField("seq", T.DecimalType(38, 0)),
        T.StructField("part", I),
        T.StructField("title", S),
        T.StructField("company", S),
        T.StructField("location", S),
        T.StructField("description", S),
        T.StructField("job_url", S),
        T.StructField("job_type", S),
        T.StructField("is_remote", B),
        T.StructField("category", S),
        T.StructField("date_posted", TS),
        T.StructField("external_id", S),
        T.StructField("source_id", I),
        T.StructField("is_it", B),
        T.StructField("it_score", I),
    ]
)

ROW_KEY = ("seq", "part")

# The stored table.  ``row_id`` is ours: a stable identity for update joins.
JOBS_TABLE = T.StructType(
    [
        T.StructField("job_reference", S),
        T.StructField("Location", S),
        T.StructField("Title", S),
        T.StructField("city", S),
        T.StructField("state", S),
        T.StructField("zip", S),
        T.StructField("country", S),
        T.StructField("job_type", S),
        T.StructField("posted_at", TS),
        T.StructField("company", S),
        T.StructField("Isremote", I),
        T.StructField("category", S),
        T.StructField("url", S),
        T.StructField("description", S),
        T.StructField("cpc", T.DecimalType(18, 2)),
        T.StructField("inserteddate", TS),
        T.StructField("IsIT", B),
        T.StructField("ITScore", I),
    ]
)
TABLE_COLUMNS = [f.name for f in JOBS_TABLE]

EXPORT_COLUMNS = [
    "source", "source_id", "domain", "tenant", "wd_server", "site", "api_url", "company",
    "title", "location", "is_us", "is_remote", "job_type", "category", "date_posted",
    "job_reference", "job_url", "detail_api_url", "detail_status_code", "still_available",
    "availability_status", "is_it", "it_score", "description_length", "description",
    "external_path", "commoncrawl_index", "commoncrawl_url", "error",
]

DISCOVERY_COLUMNS = [
    "source_row", "original_domain", "domain", "tenant", "wd_server", "site", "api_url",
    "careers_url", "status_code", "final_url", "validated", "total_jobs", "sample_title",
    "sample_external_path", "sample_job_url", "sample_still_available",
    "known_from_jobsites", "commoncrawl_index", "commoncrawl_url", "error",
    "candidate_count", "attempted_sites", "discovery_notes", "elapsed_seconds",
]

# Captured responses: what a landing job stores before any of this runs.
PAYLOADS = T.StructType(
    [
        T.StructField("payload_seq", L),
        T.StructField("source", S),
        T.StructField("tenant", S),
        T.StructField("site", S),
        T.StructField("domain", S),
        T.StructField("company", S),
        T.StructField("url", S),
        T.StructField("kind", S),
        T.StructField("attempt", I),
        T.StructField("status_code", I),
        T.StructField("body", S),
        T.StructField("fetched_at", TS),
    ]
)


def conform(df: DataFrame, schema: T.StructType = JOBS_STD) -> DataFrame:
    """Select ``schema``'s columns in order, adding typed NULLs for missing ones."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
