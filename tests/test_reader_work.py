"""Work that the readers do once, or leave out where it can't change a result."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobweave.functions.dates import parse_date
from jobweave.functions.text import collapse_ws
from jobweave.schema import PAYLOADS
from jobweave.sources.normalizers import html_pages


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _payload(seq, url, body):
    return (seq, "ZohoRecruit", "acme", "s", "d.example.com", "Acme", url, "list", 1, 200, body, None)


def test_zoho_pages_are_parsed_once(spark):
    posting = '<script type="application/ld+json">{"@type":"JobPosting","title":"Engineer","jobLocation":{"address":{"addressLocality":"Austin, TX"}}}</script>'
    pages = [_payload(1, "https://d.example.com/recruit/PortalDetail.na?jobid=A00000001", posting), _payload(2, "https://d.example.com/recruit/PortalDetail.na?jobid=A00000002", "<h1>Analyst</h1> Dallas, TX"),
             _payload(None, "https://d.example.com/recruit/PortalDetail.na?jobid=A00000003", posting.replace("Engineer", "Tester"))]
    lists = [_payload(9, "https://d.example.com/l", posting.replace("Engineer", "Lead"))]
    got = html_pages.zohorecruit(spark.createDataFrame(lists, PAYLOADS), spark.createDataFrame(pages, PAYLOADS))
    # what is left in the plan is the parsing of list pages, not that of detail pages, twice
    assert _plan(got).count("ld\\+json") <= 1
    assert sorted(r["title"] for r in got.collect()) == ["Analyst", "Engineer", "Lead", "Tester"]


def test_texts_that_begin_like_no_date_are_not_tried_further(spark):
    dates = ["2024-06-01", "2024-6-1T10:00:00Z", "2024-06-01 10:00:00 UTC", "Mon, 03 Jun 2024 10:00:00 GMT", "3 Jun 2024", "3 June 2024",
             "Monday, 3 Jun 2024", "Jun 3, 2024", "Tue,  June 3, 2024", "6/3/2024", "6/3/2024 10:00:00", "6/3/2024 1:00:00 PM", "2024/6/3", " 2024/6/3 "]
    others = ["Engineer 2024", "Jan", "12", "R2024-06-01", "", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(dates + others)], "i int, v string").withColumn("d", parse_date("v"))
    read = {r["v"]: r["d"] for r in df.collect()}
    assert all(read[v] is not None for v in dates)
    assert all(read[v] is None for v in others)
    assert "[A-Za-z]{3,9},\\s+)?(?:" in _plan(df)


def test_collapsing_leaves_single_spaces(spark):
    df = spark.createDataFrame([("a b",), (" a  b\n c\t\td ",), ("a\tb",), ("",), (None,)], "v string")
    got = df.select("v", collapse_ws("v").alias("c"), F.trim(F.regexp_replace("v", r"\s+", " ")).alias("old"))
    assert all(r["c"] == r["old"] for r in got.collect())
    assert "\\s{2,}|" in _plan(got)
