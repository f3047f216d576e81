import pytest
from pyspark.sql import functions as F

from jobweave.functions.html import decode_entities
from jobweave.operators.places import lookup, with_places

PLACES = [
    ("Austin", "Texas", "TX"), ("New York", "New York", "NY"), ("Kansas City", "Missouri", "MO"), ("Kansas City", "Kansas", "KS"),
    ("York", "Pennsylvania", "pa "), ("Portland", "Oregon", "OR"), ("Portland", "Maine", "ME"), ("St. Louis", "Missouri", "MO"),
    ("Washington", "District of Columbia", "DC"), ("Spokane", "Washington", "WA"), (None, "Utah", "UT"), ("Nowhere", "None", None),
]
CASES = {
    "Austin, Texas": ("Austin", "TX"), "austin tx": ("Austin", "TX"), "Austin, TX, United States": ("Austin", "TX"), "Austin": ("Austin", "TX"),
    "Austin, Oregon": (None, "OR"), "New York": ("New York", "NY"), "new york, new york": ("New York", "NY"), "York, PA": ("York", "PA"),
    "Kansas City, Missouri": ("Kansas City", "MO"), "KS - Kansas City": ("Kansas City", "KS"), "Kansas City": (None, "KS"),
    "Portland": None, "Portland or Remote": None, "Portland, OR": ("Portland", "OR"), "Portland, me": ("Portland", "ME"),
    "Washington, DC": ("Washington", "DC"), "Remote in Utah": (None, "UT"), "saint louis": None, "St Louis": ("St. Louis", "MO"),
    "Nowhere": None, "  ": None, None: None, "x" * 5000 + " Spokane WA": ("Spokane", "WA"),
}


def places(spark):
    return spark.createDataFrame(PLACES, "city string, state string, code string")


def test_cases(spark):
    rows = spark.createDataFrame([(i, c, "old") for i, c in enumerate(CASES)], "id int, location string, city string")
    got = {r["location"]: (r["city"], r["state"]) for r in with_places(rows, places(spark)).collect()}
    assert got == {k: v or (None, None) for k, v in CASES.items()}


def test_fallback_and_columns(spark):
    rows = spark.createDataFrame([("Boise, ID", 1), ("Austin, TX", 2), ("Boise", 3)], "place string, n int")
    named = places(spark).withColumnsRenamed({"city": "c", "state": "s", "code": "k"})
    found = lookup(rows, "place", named, city="c", state="s", code="k").collect()
    assert [tuple(r) for r in found] == [("Austin, TX", "Austin", "TX")]
    filled = with_places(rows.withColumnRenamed("place", "location"), places(spark), fallback=True).orderBy("n")
    assert [tuple(r) for r in filled.collect()] == [("Boise, ID", 1, "Boise", "ID"), ("Austin, TX", 2, "Austin", "TX"), ("Boise", 3, None, None)]


def test_repeats_empty_lists_and_plan(spark):
    rows = spark.createDataFrame([("Austin, TX",)] * 50, "location string")
    assert with_places(rows, places(spark).union(places(spark))).groupBy("city", "state").count().collect() == [("Austin", "TX", 50)]
    assert with_places(rows, places(spark).limit(0)).filter("city IS NOT NULL OR state IS NOT NULL").count() == 0
    assert with_places(rows.limit(0), places(spark)).count() == 0
    plan = with_places(rows, places(spark))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "ResolvedHint" not in plan


@pytest.mark.parametrize("text, want", [
    ("&#000000065;b", "Ab"), ("&#x0000000041;", "A"), ("&#X1F600;", "\U0001f600"), ("&#99999999999;", "&#99999999999;"),
    ("&#0;", "&#0;"), ("&#x;", "&#x;"), ("&#x110000;", "&#x110000;"), ("&#55296;", "&#55296;"),
])
def test_numbers_of_entities(spark, text, want):
    assert spark.range(1).select(decode_entities(F.lit(text))).first()[0] == want
