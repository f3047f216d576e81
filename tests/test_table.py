"""Refresh, insert, repair and publishing of the stored table."""

from datetime import datetime

from pyspark.sql import functions as F

from jobweave.operators import backfill, upsert
from jobweave.operators.dedupe import batch_status
from jobweave.plans.ingest import ingest
from jobweave.plans.maintenance import repair
from jobweave.schema import JOBS_STD, JOBS_TABLE, TABLE_COLUMNS, conform
from jobweave.sources.snapshots import STORED, SnapshotTable

AT = "2024-06-01 00:00:00"
POSTING = "seq long, external_id string, job_url string, title string, company string, location string, description string"


def stored(spark, rows):
    """rows: (row_id, ref, url, Title, company, Location, city)"""
    df = spark.createDataFrame(
        [(r[0], i, *r[1:]) for i, r in enumerate(rows)],
        "row_id string, row_order long, job_reference string, url string, Title string, company string, Location string, city string",
    )
    full = conform(df, JOBS_TABLE)
    return df.select("row_id", "row_order").join(
        full.withColumn("row_id", F.lit(None)).limit(0).select("row_id"), "row_id", "left"
    ).join(df.select("row_id", *[c for c in df.columns if c not in ("row_id", "row_order")]), "row_id").select(
        "row_id", "row_order",
        *[(F.col(c) if c in df.columns else F.lit(None)).cast(JOBS_TABLE[c].dataType).alias(c) for c in TABLE_COLUMNS],
    )


def postings(spark, rows):
    return conform(spark.createDataFrame(rows, POSTING).withColumn("part", F.lit(0)), JOBS_STD)


def test_refresh_passes(spark):
    target = stored(spark, [
        ("a", " R1 ", "u1", "T", "C", "L", None),
        ("b", "", "u2", "T2", "C2", "L2", None),
        ("c", "", "", "T3", "C3", None, None),
        ("d", "R9", "u9", "T9", "C9", "L9", None),
    ])
    jobs = postings(spark, [
        (1, "r1", "changed", "Older", "C", "L", "x"),
        (2, "R1", None, "Newer", "C", "L", None),
        (3, "", "U2", "T2b", "C2", "", None),
        (4, "", "", "t3 ", "c3", "", "third"),
        (5, "nobody", "u9", "must not fall through", "C9", "L9", None),
    ])
    staged = upsert.dedupe_stage(upsert.stage(upsert.prepare(jobs), AT))
    got = {r.row_id: r for r in upsert.refresh(target, staged).collect()}
    assert (got["a"].Title, got["a"].url, got["a"].description) == ("Newer", "u1", None)
    assert (got["b"].Title, got["b"].Location) == ("T2b", "L2")
    assert got["c"].description == "third" and got["c"].inserteddate == datetime(2024, 6, 1)
    assert got["d"].Title == "T9" and got["d"].inserteddate is None


def test_second_pass_sees_the_first(spark):
    target = stored(spark, [("a", "R1", "old", "T", "C", "L", None)])
    jobs = postings(spark, [(1, "R1", "new", "T1", "C", "L", None), (2, "", "new", "T2", "C", "L", None)])
    staged = upsert.dedupe_stage(upsert.stage(upsert.prepare(jobs), AT))
    assert upsert.refresh(target, staged).first().Title == "T2"


def test_refresh_has_no_nested_loop_join(spark):
    target = stored(spark, [("a", "R1", "old", "T", "C", "L", None)])
    staged = upsert.stage(upsert.prepare(postings(spark, [(1, "R1", "new", "T1", "C", "L", None)])), AT)
    for df in (upsert.refresh(target, staged), backfill.backfill_categories(target), backfill.backfill_it_flags(target)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_ingest_twice_inserts_nothing(spark):
    target = stored(spark, [("a", "R1", "u1", "Dev", "C", "Austin, TX", None)])
    jobs = postings(spark, [
        (1, "R1", "u1", "Dev", "C", "Austin, TX", "d"),
        (2, "R2", "u2", "Ops", "C", "Reno, NV; Salem, OR", "d"),
        (3, None, None, "Chef", "C", "Reno, NV", "d"),
    ])
    first = ingest(jobs, target, AT)
    assert {r.status: r.n for r in first.counts().collect()} == {"existing": 1, "new": 3}
    table = first.table
    assert table.count() == 4
    again = batch_status(first.batch, table, ["seq", "part"])
    assert {r.status for r in again.collect()} == {"existing"}
    places = {r.Location for r in table.filter("job_reference LIKE 'R2:L%'").collect()}
    assert places == {"Reno, NV", "Salem, OR"}


def test_insert_gives_a_stable_reference(spark):
    rows = postings(spark, [(3, " ", None, "Chef", "C", "Reno", None)])
    once = upsert.insert_rows(upsert.prepare(rows), AT).first().job_reference
    assert once.startswith("gen-") and once == upsert.insert_rows(upsert.prepare(rows), AT).first().job_reference


def test_variants_replace_the_original(spark):
    target = stored(spark, [
        ("a", "R1", "u", "T", "C", "Reno, NV; Salem, OR", None),
        ("b", "R2", "u", "T", "C", "Reno, NV;", None),
        ("c", "R3", "u", "T", "C", "Reno, NV", "x" * 60),
        ("d", "", "u", "T", "C", "A; B", None),
        ("e", "R5:Lab12", "u", "T", "C", "A; B", None),
        ("f", "R1", "u", "T", "C", "Reno, NV; Salem, OR", None),
    ])
    once = backfill.backfill_variants(target, AT)
    got = once.collect()
    assert sorted(r.Location for r in got if (r.job_reference or "").startswith("R1")) == ["Reno, NV", "Salem, OR"]
    by_id = {r.row_id: r for r in got}
    assert (by_id["b"].Location, by_id["b"].city) == ("Reno, NV", "Reno") and by_id["c"].city == "Reno"
    assert by_id["d"].Location == "A; B" and by_id["e"].Location == "A; B" and "a" not in by_id
    twice = backfill.backfill_variants(once, AT)
    assert sorted(map(str, twice.drop("row_order").collect())) == sorted(map(str, once.drop("row_order").collect()))


def test_city_cleanup(spark):
    target = stored(spark, [
        ("a", "R1", "u", "T", "C", "x", ";"),
        ("b", "R2", "u", "T", "C", "Reno, NV", "US Remote"),
        ("c", "R3", "u", "T", "C", "Reno, NV | Salem, OR", "Reno | Salem"),
    ])
    got = {r.job_reference: r for r in backfill.cleanup_cities(target, AT).collect()}
    assert got["R1"].city is None and got["R2"].Location == "US Remote"
    assert sum(k.startswith("R3:L") for k in got) == 2 and "R3" not in got


def test_repairs_are_idempotent(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"), STORED)
    rows = stored(spark, [
        ("a", "R1", "u1", "Software Engineer", "C", "Reno, NV", "reno city"),
        ("b", "", "u2", "Nurse", "C", "Salem, OR", None),
    ]).withColumn("category", F.lit("Engineering and everything around it"))
    store.commit(rows.drop("row_order"))
    for name in ("it-flags", "locations", "categories"):
        first, second = repair(store, name, AT).first(), repair(store, name, AT).first()
        assert first.updated > 0 and second.updated == 0, name
    assert store.version() == 7


def test_snapshot_columns_are_added(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"), STORED)
    store.commit(spark.createDataFrame([("a", "R")], "row_id string, job_reference string"))
    assert store.read().first().IsIT is None and store.read().columns[0] == "row_id"
