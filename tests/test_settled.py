"""Filters test columns that are computed once: no parsing is copied into a filter."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import Row, functions as F

from jobweave.operators.dedupe import first_per_key
from jobweave.schema import PAYLOADS, conform
from jobweave.sources.normalizers import feeds, html_pages, list_detail, lists, workday

_COSTLY = re.compile(r"from_json|from_xml|regexp_extract\(|regexp_replace|get_json_object|sha2")


def _payloads(spark, body="{}"):
    rows = [Row(payload_seq=1, url="https://d.example.com/p/1", domain="d.example.com", status_code=200, body=body)]
    return conform(spark.createDataFrame(rows), PAYLOADS)


def _filters(df) -> list[str]:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if re.match(r"[\s:+|-]*Filter ", line)]


@pytest.mark.parametrize(
    "read",
    [
        list_detail.breezyhr, feeds.pinpointhq, html_pages.freshteam, html_pages.zohorecruit,
        list_detail.smartrecruiters, list_detail.applicantpro, workday.workday,
        lambda p, d: lists.recruitee(p),
    ],
    ids=["breezyhr", "pinpointhq", "freshteam", "zohorecruit", "smartrecruiters", "applicantpro", "workday", "recruitee"],
)
def test_filters_hold_no_parsing(spark, read):
    payloads = _payloads(spark)
    found = [f for f in _filters(read(payloads, payloads)) if _COSTLY.search(f)]
    assert found == []


def test_key_is_computed_once(spark):
    rows = spark.createDataFrame([(1, " A "), (2, "a"), (3, ""), (4, None)], "seq int, k string")
    kept = first_per_key(rows, F.sha2("k", 256), ["seq"], "drop")
    assert [f for f in _filters(kept) if _COSTLY.search(f)] == []
    assert sorted(r.seq for r in first_per_key(rows, "k", ["seq"], "drop").collect()) == [1]
    assert sorted(r.seq for r in first_per_key(rows, "k", ["seq"]).collect()) == [1, 3, 4]


def test_breezy_places(spark):
    body = (
        '[{"id":"1","name":"Role","friendly_id":"1","locations":[{"name":" Austin,  TX "},{"name":" ","city":"Salem",'
        '"state":{"id":"OR"},"country":{"name":"USA"}},"austin, tx",{"name":"AUSTIN, TX"}]}]'
    )
    got = list_detail.breezyhr(_payloads(spark, body), _payloads(spark, "x")).collect()
    assert [r.location for r in got] == ["Austin, TX | Salem, OR, USA"]
