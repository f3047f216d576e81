"""Files, payload choice, and normaliser edge cases."""

import json

from pyspark.sql import functions as F

from jobweave.operators import discovery
from jobweave.schema import PAYLOADS
from jobweave.sources import registry
from jobweave.sources.catalog_csv import read_catalog_csv, write_catalog_csv
from jobweave.sources.normalizers import html_pages, lists


def payload(spark, *bodies, **fixed):
    base = {"source": "x", "tenant": "acme", "site": "CX", "domain": "d.com", "company": "Acme", "url": "https://d.com/l",
            "kind": "list", "attempt": 1, "status_code": 200, "fetched_at": None, **fixed}
    rows = [{**base, "payload_seq": i, "body": b if isinstance(b, str) else json.dumps(b)} for i, b in enumerate(bodies)]
    return spark.createDataFrame([tuple(r[f.name] for f in PAYLOADS) for r in rows], PAYLOADS)


def test_catalog_file(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_bytes('﻿domain, total_jobs ,note\r\n"a.com","3","x, ""y"""\r\n\r\nb.com\r\n'.encode())
    rows = read_catalog_csv(spark, str(path), order="at").orderBy("at").select("DOMAIN", "total_jobs", "note").collect()
    assert [tuple(r) for r in rows] == [("a.com", "3", 'x, "y"'), ("b.com", "", "")]


def test_catalog_header_only(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("domain,site\n")
    assert read_catalog_csv(spark, str(path)).count() == 0


def test_catalog_write_adds_missing_fields(spark, tmp_path):
    df = spark.createDataFrame([('a"b', 1)], "x string, n int")
    write_catalog_csv(df, str(tmp_path / "o"), ["n", "gone", "x"])
    assert tuple(read_catalog_csv(spark, str(tmp_path / "o")).first()) == ("1", "", 'a"b')


def test_source_names():
    assert [s.name for s in registry.wanted_sources("apply to job")] == ["JazzHR"]
    assert len(registry.wanted_sources(None)) == 25 and len(registry.wanted_sources("FREE")) == 4


def test_broken_payload_stops_nothing(spark):
    good = {"jobs": [{"id": 1, "jobTitle": "Dev", "jobGeo": "USA", "url": "u"}]}
    df = payload(spark, '{"jobs":[{"id":', good, source="Jobicy")
    assert [r.title for r in registry.normalize_payloads(df).collect()] == ["Dev"]
    assert [r.reason for r in registry.rejects(df).collect()] == ["broken json"]


def test_arrival_order_survives(spark):
    body = lambda *titles: [{"id": t, "text": t, "categories": {"location": "USA"}} for t in titles]
    got = lists.lever(payload(spark, body("a", "b"), body("c"))).orderBy("seq")
    assert [r.title for r in got.collect()] == ["a", "b", "c"]


def test_unlisted_and_compensation(spark):
    jobs = {"jobs": [
        {"id": "1", "title": "A", "isListed": False, "location": "USA"},
        {"id": "2", "title": "B", "location": {"name": "Reno, NV"}, "secondaryLocations": [{"location": "reno, nv"}, "Salem, OR"],
         "descriptionPlain": "d", "compensation": {"min": 1}},
    ]}
    row = lists.ashby(payload(spark, jobs)).collect()
    assert [(r.title, r.location, r.description) for r in row] == [("B", "Reno, NV, Salem, OR", 'd\n\nCompensation: {"min":1}')]


def test_board_metadata(spark):
    jobs = {"jobs": [{"id": 5, "title": "Dev", "location": {"name": "Remote"}, "content": "<p>part-time</p>",
                      "departments": [{"name": "Eng"}, {"name": "ENG"}, {"name": "Ops"}]}]}
    row = lists.greenhouse(payload(spark, jobs)).first()
    assert (row.category, row.job_type, row.company, row.is_remote) == ("Eng / Ops", "Part time", "Acme", True)


def test_positional_short_row(spark):
    body = {"fields": ["Title", "Location", "ContestNo"], "requisitionList": [{"column": ["Dev", "Reno, NV"], "jobId": 9}]}
    row = lists.taleo(payload(spark, body)).first()
    assert (row.title, row.external_id) == ("Dev", "9")


def test_portal_row_title(spark):
    page = ('<tr class="jobDetailRow"><td>05/01/2024</td><td><a class="jobdetail" href="/recruit/PortalDetail.na?jobid=A1234">ZR_1_JOB</a></td>'
            "<td>Cloud Engineer</td><td>Reno</td><td>NV</td></tr>")
    row = html_pages.portal_rows(payload(spark, page)).first()
    assert (row["_title"], row["_where"]) == ("Cloud Engineer", "Reno, NV")


def test_candidates_first_per_site(spark):
    df = spark.createDataFrame([
        (1, "https://a.wd1.myworkdayjobs.com/en-US/Ext/job/x/y"), (2, "https://A.wd1.myworkdayjobs.com/fr/ext/job/z"),
        (3, "https://a.wd1.myworkdayjobs.com/job/x"), (4, "https://a.wd1.myworkdayjobs.com/en/Ext/job"), (5, "nope"),
    ], "n int, url string")
    got = discovery.candidates(df, "url", "n").collect()
    assert [(r.n, r.tenant, r.server, r.site) for r in got] == [(1, "a", "wd1", "Ext")]
    seeds = df.select(discovery.seed_candidate("url").alias("c")).filter("c IS NOT NULL").select("c.site")
    assert sorted(r.site for r in seeds.collect()) == ["Ext", "Ext", "ext"]


def test_fixed_numbers_do_not_need_one_task(spark):
    from jobweave.operators.ordering import number_rows

    df = spark.range(1000).selectExpr("id * 7 AS k")
    got = number_rows(df, F.col("k"), F.expr("k div 500"), "n").orderBy("k").collect()
    assert [r.n for r in got] == list(range(1, 1001))
