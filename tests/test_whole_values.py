"""Values beyond the lengths, counts and numbers that once were limits."""

import json

from pyspark.sql import functions as F
from test_table import AT, postings, stored

from jobweave import rules
from jobweave.functions.location import variant_codes
from jobweave.operators import backfill, discovery
from jobweave.operators.expand import expand_locations
from jobweave.operators.ordering import company_rows
from jobweave.plans.ingest import ingest
from jobweave.session import shared_folder
from jobweave.sources.catalog_csv import read_catalog_csv
from jobweave.sources.normalizers.common import arrival, payload_of
from jobweave.sources.normalizers.html_pages import page_text
from jobweave.sources.registry import rejects


def test_long_keys_stay_apart(spark):
    ref, url = "R" * 250, "https://x/" + "u" * 900
    target = stored(spark, [("a", ref + "0", url + "0", "Dev", "C", "Austin, TX", None)])
    jobs = postings(spark, [
        (1, ref + "1", url + "1", "One", "C", "Reno, NV", "d"),
        (2, ref + "2", url + "2", "Two", "C", "Reno, NV", "d"),
    ])
    table = ingest(jobs, target, AT).table
    assert sorted(r.job_reference[-1] for r in table.collect()) == ["0", "1", "2"]
    assert table.select("row_id").distinct().count() == table.count() == 3
    changed = jobs.withColumn("title", F.concat(F.lit("New "), "title"))
    again = ingest(changed, table.withColumn("row_order", F.xxhash64("row_id")), AT).table
    assert sorted(r.Title for r in again.collect()) == ["Dev", "New One", "New Two"]
    assert again.select("row_id").distinct().count() == 3


def test_every_place_has_its_own_reference(spark):
    places = [f"town {i}, tx" for i in range(400)] + ["village 6335, tx"]
    jobs = spark.createDataFrame([(1, "R1", ";".join(places))], "seq long, external_id string, location string")
    rows = expand_locations(jobs)
    assert rows.count() == rows.select("external_id").distinct().count() == 401
    codes = spark.createDataFrame([(["Reno, NV", "RENO, nv", "Salem, OR"],)], "p array<string>").select(variant_codes("p").alias("c")).first().c
    assert codes[0] == codes[1] != codes[2] and len(codes[0]) == 32


def test_arrival_numbers_do_not_meet(spark):
    first, last = rules.SOURCES[0], rules.SOURCES[-1]
    rows = spark.createDataFrame([(0, 2**20), (1, 0), (2**39, 5), (2**62, 2**31 - 1), (0, 0)], "p long, i int")
    numbers = rows.select(arrival(first, "p", "i").alias("a"), arrival(last, "p", "i").alias("b"), "p")
    got = numbers.collect()
    assert len({x for r in got for x in (r.a, r.b)}) == 10 and max(r.a for r in got) < min(r.b for r in got)
    back = numbers.select(payload_of("a").alias("x"), payload_of("b").alias("y"), "p").collect()
    assert all(r.x == r.y == r.p for r in back)


def test_padded_locations_are_repaired_once(spark):
    target = stored(spark, [(str(i), "R", "u", "T", "C", x, "wrong") for i, x in enumerate([" Reno, NV ", "reno, nv", "Reno, NV"])])
    once = backfill.backfill_location_parts(target)
    assert [(r.city.lower(), r.state) for r in once.collect()] == [("reno", "NV")] * 3
    assert once.exceptAll(backfill.backfill_location_parts(once)).count() == 0


def test_repeated_captures_give_one_site(spark):
    host = "acme.wd5.myworkdayjobs.com"
    urls = spark.createDataFrame([(1, f"https://{host}/en-US/site/job/x/R1")], "page_id long, url string")
    cands = discovery.candidates(urls, "url", "page_id")
    body = lambda n: json.dumps({"total": n, "jobPostings": [{"title": "T", "externalPath": "/job/x"}]})
    lists = spark.createDataFrame([(host, "site", 200, body(5)), (host, "site", 200, body(5)), (host, "site", 200, body(7))], "domain string, site string, status_code int, body string")
    details = spark.createDataFrame([(host, "site", 200, json.dumps({"jobPostingInfo": {"title": "T"}}))], lists.schema)
    assert discovery.validate(cands, lists, details).count() == 1


def test_unusable_payloads_are_seen(spark):
    rows = [
        ("Greenhouse", "list", '{"error": "gone"}', "wrong shape"), ("Lever", "list", '{"data": []}', "wrong shape"),
        ("Personio", "feed", "<html>blocked</html>", "wrong shape"), ("Lever", "page", "[]", "unknown kind"),
        ("Greenhouse", "list", '{"jobs": []}', None), ("Lever", "list", " []", None), ("Personio", "feed", "<workzag-jobs></workzag-jobs>", None),
        ("Greenhouse", "list", '{"jobs": [{"id": 1', "broken json"), ("Nobody", "list", "[]", "unknown source"), ("Lever", "list", None, "empty body"),
    ]
    frame = spark.createDataFrame([(*r, 200) for r in rows], "source string, kind string, body string, want string, status_code int")
    found = rejects(frame).select("want", "reason").collect()
    assert all(r.want == r.reason for r in found) and len(found) == sum(r[3] is not None for r in rows)


def test_catalogues_with_other_headers(spark):
    folder = shared_folder(spark, "headers")
    for header, row in (("domain,site", "a.com,one"), ("site,domain", "two,b.com"), ("domain,site,extra", 'c.com,"th,ree",x')):
        spark.createDataFrame([(header,), (row,)], "value string").coalesce(1).write.mode("append").text(folder)
    got = sorted((r.domain, r.site, r.extra) for r in read_catalog_csv(spark, folder).collect())
    assert got == [("a.com", "one", ""), ("b.com", "two", ""), ("c.com", "th,ree", "x")]


def test_skipping_keeps_the_rest(spark):
    rows = spark.range(10).select(F.concat(F.lit("c"), "id").alias("company"), "id")
    assert [r.id for r in company_rows(rows, "id", skip=7).collect()] == [7, 8, 9]
    assert [r.id for r in company_rows(rows, "id", skip=2, take=3).collect()] == [2, 3, 4]
    assert company_rows(rows, "id", skip=20).count() == 0


def test_page_text_is_whole(spark):
    html = "<p>" + "word " * 1500 + "end</p>"
    text = spark.createDataFrame([(html,)], "h string").select(page_text("h").alias("t")).first().t
    assert text.endswith("end") and len(text) > 6000
