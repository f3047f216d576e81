from pyspark.sql import functions as F

from jobweave.operators.dedupe import batch_status
from jobweave.operators.key_index import KeyIndex, estimated_sizes, key_sketches
from test_table import postings, stored


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_probe_moves_the_batch_only(spark):
    """The stored side of the join is read by bucket: no exchange above its scan."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = stored(spark, [(f"r{i}", f"R{i}", f"u{i}", f"T{i}", "C", "L", None) for i in range(300)])
        index = KeyIndex(spark, 16).build(target)
        probe = spark.createDataFrame([(i, "ref", f"r{i}") for i in range(200, 400)], "seq long, kind string, key string")
        found = probe.join(index.keys(), ["kind", "key"], "left_semi")
        plan = exchanges(found)
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
        assert index.known(probe, "seq").count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_status_is_that_of_the_table(spark):
    rows = [("a", " R1 ", "u1", "T", "C", "L", None), ("b", "", "U2", "T2", "C2", "", None), ("c", None, None, "T3", "C3", None, None), ("d", "R9", "u9", "T9", "C9", "L9", None)]
    target = stored(spark, rows)
    jobs = postings(spark, [
        (1, "r1", "x", "x", "x", "x", None), (2, "", "u2", "x", "x", "x", None), (3, "", "", "t3", "c3", "", None), (4, "n", "u1", "new", "c", "l", None),
        (5, "N", "u7", "newer", "c", "l", None), (6, None, None, None, None, None, None), (7, "", "u9", "x", "x", "x", None),
    ])
    want = {r["seq"]: r["status"] for r in batch_status(jobs, target).collect()}
    for index in (KeyIndex(spark).build(target), KeyIndex(spark, 3).build(target.limit(2)).add(target), KeyIndex(spark, 2).build(target.limit(0)).add(target)):
        assert {r["seq"]: r["status"] for r in batch_status(jobs, index).collect()} == want
        assert index.keys().count() == index.keys().distinct().count()
    assert set(want.values()) == {"existing", "new", "batch_duplicate"}


def test_sketches_of_parts_add_up(spark):
    target = stored(spark, [(f"r{i}", f"R{i % 2000}", f"u{i % 700}", f"T{i}", f"C{i % 5}", "L", None) for i in range(4000)])
    got = estimated_sizes(key_sketches(target, ["company"])).first()
    for name, n in (("references", 2000), ("urls", 700), ("fingerprints", 4000)):
        assert abs(got[name] - n) <= 0.05 * n
    assert tuple(estimated_sizes(key_sketches(target.limit(0))).first()) == (0, 0, 0)
    assert key_sketches(target, ["company"]).select(F.countDistinct("company")).first()[0] == 5
