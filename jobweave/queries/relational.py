"""The stored table as a table: clone, evolve, append, publish."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobweave.operators import reports, upsert
from jobweave.queries.base import query, s_blank, table
from jobweave.queries.jobsview import STORED_CTE, stored
from jobweave.schema import JOBS_TABLE, TABLE_COLUMNS
from jobweave.session import shared_folder
from jobweave.sources.snapshots import STORED, SnapshotTable, empty_clone, ensure_columns

W = "WITH " + STORED_CTE
COLS = ", ".join(f'"{c}"' for c in TABLE_COLUMNS)

query("empty_clone", W + f" SELECT row_id, {COLS} FROM stored")(
    lambda s, d: empty_clone(stored(s, d)).unionByName(stored(s, d)).select("row_id", *TABLE_COLUMNS)
)

query(
    "evolve_schema",
    W + """ SELECT row_id, "Title", CAST(NULL AS BOOLEAN) AS "IsIT", CAST(NULL AS INTEGER) AS "ITScore" FROM stored""",
)(lambda s, d: ensure_columns(stored(s, d).drop("IsIT", "ITScore"), JOBS_TABLE).select("row_id", "Title", "IsIT", "ITScore"))

query(
    "append_rows",
    W + f""" SELECT 'stored' AS part, count(*) AS n FROM stored WHERE NOT {s_blank('"Title"')} AND NOT {s_blank('company')}
    UNION ALL SELECT 'rejected', count(*) FROM stored WHERE {s_blank('"Title"')} OR {s_blank('company')}""",
)(
    lambda s, d: upsert.split_insertable(stored(s, d))[0].agg(F.lit("stored").alias("part"), F.count(F.lit(1)).alias("n"))
    .unionByName(
        upsert.split_insertable(stored(s, d))[1].agg(F.lit("rejected").alias("part"), F.count(F.lit(1)).alias("n"))
    )
)


@query("snapshot_versions", W + f" SELECT 2 AS version, row_id, {COLS} FROM stored")
def snapshot_versions(s, d):
    """An empty first version, then the stored table; the current one is read back."""
    target = SnapshotTable(s, shared_folder(s, "table"), STORED)
    target.ensure()
    target.commit(stored(s, d).select("row_id", *TABLE_COLUMNS))
    return target.read().select(F.lit(target.version()).alias("version"), "row_id", *TABLE_COLUMNS)


query(
    "label_coverage",
    """SELECT lang, count(*) AS total, count(quality) AS populated, count(*) - count(quality) AS missing
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""",
)(
    lambda s, d: reports.coverage(
        table(s, d, "documents").select("doc_id", "lang").join(table(s, d, "labels"), "doc_id", "left"), {"quality": "quality"}, ["lang"]
    ).select("lang", "total", "populated", "missing")
)
