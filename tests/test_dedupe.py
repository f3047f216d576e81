"""The set-based split equals the one-pass loop it replaces, and survives hot keys."""

import random

from jobweave.operators import dedupe, merge

COLUMNS = "seq long, external_id string, job_url string, title string, company string, location string"
STORED = "job_reference string, url string, Title string, company string, Location string"


def key(v):
    return (v or "").strip().lower()


def text_key(t, c, place):
    return "" if not key(t) or not key(c) else "|".join((key(t), key(c), key(place)))


def loop(rows, stored):
    refs = {key(r[0]) for r in stored} - {""}
    urls = {key(r[1]) for r in stored} - {""}
    texts = {text_key(*r[2:]) for r in stored} - {""}
    seen_refs, seen_urls, seen_texts, out = set(), set(), set(), {}
    for seq, ref, url, *rest in rows:
        r, u, t = key(ref), key(url), text_key(*rest)
        if (r and r in refs) or (not r and u and u in urls) or (t and t in texts):
            out[seq] = "existing"
            continue
        main = seen_refs if r else seen_urls
        value = r or u
        if value:
            if value in main:
                out[seq] = "batch_duplicate"
                continue
            main.add(value)
        if t:
            if t in seen_texts:
                out[seq] = "batch_duplicate"
                continue
            seen_texts.add(t)
        out[seq] = "new"
    return out


def random_rows(rng, n):
    pick = lambda *xs: rng.choice(xs)
    return [
        (
            i,
            pick(None, "", " \t", *[f"{c}{k}" for c in "rR" for k in range(n // 3)]),
            pick(None, "", *[f"u{k} " for k in range(n // 3)]),
            pick(None, " ", "Dev", "dev ", "Ops"),
            pick(None, "Acme", "ACME", *[f"c{k}" for k in range(n // 4)]),
            pick(None, "Reno", "reno\t", "Salem"),
        )
        for i in range(n)
    ]


def test_split_equals_loop(spark):
    rng = random.Random(7)
    for _ in range(6):
        rows = random_rows(rng, 60)
        stored = [r[1:] for r in random_rows(rng, 12)]
        status = dedupe.batch_status(
            spark.createDataFrame(rows, COLUMNS), spark.createDataFrame(stored, STORED)
        )
        assert {r.seq: r.status for r in status.collect()} == loop(rows, stored)


def test_batch_dedupe_equals_loop(spark):
    rng = random.Random(11)
    rows = random_rows(rng, 80)
    kept = dedupe.batch_dedupe(spark.createDataFrame(rows, COLUMNS)).select("seq").collect()
    expected = {s for s, v in loop(rows, []).items() if v == "new"}
    assert {r.seq for r in kept} == expected


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(20000).selectExpr("id AS seq", "IF(id % 3 = 0, 'hot', concat('k', id)) AS k")
    first = dedupe.first_per_key(df, "k", ["seq"], "drop")
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert first.count() == 20000 - 6667 + 1


def test_rows_without_key_are_spread(spark):
    df = spark.range(2000).selectExpr("id AS seq", "CAST(NULL AS STRING) AS k")
    assert dedupe.first_per_key(df, "k", ["seq"]).count() == 2000
    assert dedupe.first_per_key(df, "k", ["seq"], "drop").count() == 0


def test_merge_keeps_all_places(spark):
    rows = [
        (1, "http://x", "a", "T1", "United States", False, "short"),
        (2, "HTTP://X ", "b", "T2", "Reno, NV", False, "the longest"),
        (3, "http://x", "c", "T3", "reno, nv", True, " "),
        (4, "http://x", "d", "T4", "Boise, Idaho", False, None),
        (5, None, None, "T5", None, False, None),
        (6, " ", "", "T6", "usa", False, "d"),
    ]
    df = spark.createDataFrame(
        rows, "seq long, job_url string, external_id string, title string, location string, is_remote boolean, description string"
    )
    got = {r.title: (r.location, r.is_remote, r.description) for r in merge.merge_postings(df).collect()}
    assert got == {
        "T1": ("Reno, NV; Boise, Idaho", True, "the longest"),
        "T5": ("", False, None),
        "T6": ("usa", False, "d"),
    }


def test_merge_of_a_hot_group(spark):
    df = spark.range(6000).selectExpr(
        "id AS seq", "IF(id % 3 = 0, 'u', concat('u', id)) AS job_url", "'' AS external_id",
        "concat('city ', id % 5) AS location", "id = 0 AS is_remote", "'d' AS description",
    )
    merged = merge.merge_postings(df)
    assert merged.count() == 4001
    hot = merged.filter("job_url = 'u'").first()
    assert hot.is_remote and sorted(hot.location.split("; ")) == [f"city {i}" for i in range(5)]
