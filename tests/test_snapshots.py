import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobweave.operators import upsert
from jobweave.plans.ingest import ingest
from jobweave.plans.maintenance import repair
from jobweave.queries.jobsview import LOADED_AT, jobs, stored
from jobweave.schema import TABLE_COLUMNS, conform, JOBS_STD
from jobweave.sources.snapshots import SnapshotTable
from jobweave.streaming.ingest import ingest_batch, ingest_stream, read_landed
from test_table import AT, postings
from test_table import stored as small_table

SF = "/root/testdata/sf0.001"
KV = "row_id string, Title string, company string"


def files(store):
    return {p: p.stat().st_mtime_ns for p in Path(store.root, "data").rglob("*.parquet")}


def rows(df):
    return sorted((tuple(r) for r in df.select("row_id", "Title", "company").collect()), key=repr)


def test_a_change_writes_its_bucket_only(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"), buckets=16)
    store.commit(spark.createDataFrame([(f"r{i}", "T", "C") for i in range(400)], KV))
    before = files(store)
    assert len(store.folders()) == 16
    version = store.commit_changes(spark.createDataFrame([("r7", "new", "C")], KV))
    after = files(store)
    written = [p for p in after if p not in before]
    bucket = spark.createDataFrame([("r7",)], "row_id string").select(store.bucket_of()).first()[0]
    assert version == 2 and {p.parent.name for p in written} == {f"bucket={bucket}"} and all(after[p] == before[p] for p in before)
    assert rows(store.read()) == sorted([(f"r{i}", "new" if i == 7 else "T", "C") for i in range(400)])
    assert rows(store.read(1)) == sorted([(f"r{i}", "T", "C") for i in range(400)])
    assert rows(store.read(only=[bucket])) == [r for r in rows(store.read()) if r in rows(store.read(only=[bucket]))]


def test_changes_against_plain_python(spark, tmp_path):
    import random

    rng = random.Random(4)
    store, want = SnapshotTable(spark, str(tmp_path / "t"), buckets=4), {}
    store.ensure()
    for step in range(5):
        changes = {f"k{rng.randrange(12)}": (f"s{step}", rng.choice(["a", None])) for _ in range(rng.choice([0, 1, 4]))}
        gone = {k for k in want if k not in changes and rng.random() < 0.5}
        want = {k: v for k, v in {**want, **changes}.items() if k not in gone}
        store.commit_changes(spark.createDataFrame([(k, *v) for k, v in changes.items()], KV), spark.createDataFrame([(k,) for k in gone], "row_id string"))
        assert rows(store.read()) == sorted(((k, *v) for k, v in want.items()), key=repr)
    assert store.version() == 6 and rows(store.read(1)) == []
    empty = SnapshotTable(spark, str(tmp_path / "none"))
    assert empty.version() == 0 and empty.read().count() == 0 and not empty.has_batch("x")


def test_columns_added_by_a_change(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"), buckets=2)
    store.commit(spark.createDataFrame([(str(i), "T") for i in range(9)], "row_id string, Title string"))
    store.commit_changes(spark.createDataFrame([("1", "U", 5)], "row_id string, Title string, extra int"))
    assert {(r["row_id"], r["Title"], r["extra"]) for r in store.read().collect()} == {(str(i), "U" if i == 1 else "T", 5 if i == 1 else None) for i in range(9)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")
def test_changes_are_the_difference_of_the_upsert(spark):
    batch, target = jobs(spark, SF), stored(spark, SF)
    known, fresh = batch.filter("seq % 9 = 0"), batch.filter("seq % 50 = 1").withColumn("external_id", F.concat(F.lit("fresh"), "seq"))
    whole = upsert.upsert(target, known, fresh, LOADED_AT)
    changes = upsert.upsert_changes(target, target, known, fresh, LOADED_AT)
    assert changes.select("row_id").distinct().count() == changes.count() < whole.count()
    merged = target.select("row_id", *TABLE_COLUMNS).join(changes.select("row_id"), "row_id", "left_anti").unionByName(changes)
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))


def test_the_table_is_read_for_hit_rows_only(spark, tmp_path):
    """Keys of the whole table, but descriptions only behind the join with the updates."""
    target = small_table(spark, [("a", "R1", "u1", "Dev", "C", "Austin, TX", None), ("b", "R2", "u2", "Dev", "C", "Austin, TX", None)])
    run = ingest(postings(spark, [(1, "R1", "u1", "Lead", "C", "Austin, TX", "text")]), target, AT)
    assert {r["row_id"] for r in run.changes.collect()} >= {"a"} and run.table.count() == 2


def test_repair_counts_and_writes_what_changed(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"), buckets=32)
    data = [(f"r{i}", f"R{i}", f"u{i}", "Clerk", "C", "Reno, NV" if i != 5 else "Reno, NV; Salem, OR", "Reno") for i in range(60)]
    store.commit(small_table(spark, data).withColumn("state", F.lit("NV")).drop("row_order"))
    before = files(store)
    assert tuple(repair(store, "locations", AT).first()) == (0, 0, 0, 60)
    assert files(store) == before and store.version() == 2
    report = repair(store, "variants", AT).first()
    assert (report["inserted"], report["deleted"], report["unchanged"]) == (2, 1, 59)
    assert len({p.parent.name for p in files(store) if p not in before}) <= 3 and store.read().count() == 61


def test_a_batch_is_applied_once(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"))
    store.ensure()
    batch = postings(spark, [(1, "R1", "u1", "Dev", "C", "Austin, TX", "one")])
    assert ingest_batch(batch, store, AT, "s:0") and not ingest_batch(batch, store, AT, "s:0")
    assert store.version() == 2 and ingest_batch(batch, store, AT, "other:0") and store.read().count() == 1


def test_a_stream_that_failed_after_its_commit(spark, tmp_path):
    """The checkpoint forgets the last micro-batch; the log doesn't."""
    store, landed, offsets = SnapshotTable(spark, str(tmp_path / "t")), str(tmp_path / "in"), tmp_path / "offsets"
    for i in range(3):
        conform(postings(spark, [(i, f"R{i}", f"u{i}", f"Dev {i}", "C", "Austin, TX", "d")]), JOBS_STD).coalesce(1).write.mode("append").parquet(landed)
    run = lambda: ingest_stream(read_landed(spark, landed, JOBS_STD, files_per_batch=1), store, str(offsets), AT).awaitTermination()
    run()
    version = store.version()
    assert version == 4 and store.read().count() == 3  # a version per file
    last = max((p for p in (offsets / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    for crc in (offsets / "commits").glob(f".{last.name}.crc"):
        crc.unlink()
    run()
    assert store.version() == version and store.read().count() == 3
