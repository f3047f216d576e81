"""Column functions: (input, expected) tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from jobweave.functions import classify, dates, html, ids, jsonv, location, text, url


def values(spark, column, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.select(column(F.col("v")).alias("o"), "i").orderBy("i").select("o").collect()]


CASES = [
    (text.normalize_key, [None, "", " \t\n", "\tÀb C　"], ["", "", "", "àb c"]),
    (lambda c: text.clean(c, 3), [None, "  ", " abcd "], [None, None, "abc"]),
    (text.alnum_lower, ["Apply-To Job!", None], ["applytojob", ""]),
    (text.upper_first, ["acme", "", None], ["Acme", "", None]),
    (text.split_list, ["a; B,,b ;", None], [["a", "B"], []]),
    (text.company_from_domain, ["acme-corp.x.com", "", "--.x"], ["Acme corp", "", "--.x"]),
    (text.title_before_at, ["Dev at Acme", "Dev"], ["Dev", "Dev"]),
    (text.company_after_at, ["Dev at A at Acme ", "Dev"], ["Acme", ""]),
    (text.strip_career_page, ["Dev - Acme - Career Page", "Dev | x", "Dev - JazzHR"], ["Dev", "Dev", "Dev"]),
    (text.location_candidate, ["- Austin, TX.", "Join our team", "x" * 121, "Reno ** Description: ** y"],
     ["Austin, TX", "", "x" * 121, "Reno"]),
    (text.json_unescape, [r"a\nb\/cé", r'q\"q'], ["a\nb/cé", 'q"q']),
    (lambda c: text.label_value(c, "Department"), ["Department: Research Location: x", "none"], ["Research", ""]),
    (html.decode_entities, ["a &amp;lt; b", "&eacute;&#x41;&#66;&nbsp;&bogus;", None, "plain"],
     ["a &lt; b", "éAB\xa0&bogus;", None, "plain"]),
    (html.strip_tags, ["<p>a<br>b &amp; c</p>", None], ["a b & c", ""]),
    (html.strip_tags_plain, ["<p>a</p>  &amp;", None], ["a &amp;", ""]),
    (lambda c: html.meta(c, "og:title"),
     ["<meta property='og:title' content='A'>", "<meta content='B' name='og:title'>", "x"], ["A", "B", ""]),
    (url.normalize_domain, [" HTTPS://www.Acme.com./jobs/ ", None], ["acme.com", ""]),
    (url.domain_from_url, ["https://A.b/c", "nope", None], ["a.b", "", ""]),
    (lambda c: url.host_if_suffix(c, ".acme.com"), ["x.acme.com/y", "https://X.ACME.com", "acme.org"],
     ["x.acme.com", "x.acme.com", ""]),
    (lambda c: url.id_from_url(c, "jazzhr"), ["https://x/apply/Ab9/role", "https://x/"], ["Ab9", "https://x/"]),
    (lambda c: url.resolve(F.lit("https://a.b/c/d"), c), ["/x#y", "e", "//h/i", "http://q/r"],
     ["https://a.b/x", "https://a.b/c/e", "https://h/i", "http://q/r"]),
    (ids.looks_like_reference, ["R-1", "no digit", "a/1", " ", None], [True, False, False, False, False]),
    (ids.reference_from_path, ["/job/x/Role_R-123/", "/job/x"], ["R-123", ""]),
    (location.is_us, ["Austin, TX", "Remote", "USA", "Berlin", None, "austin"], [True, False, True, False, False, True]),
    (location.city_of, ["Austin, tx 78701", "Remote", None], ["Austin", None, None]),
    (location.state_of, ["Austin, tx 78701", "Paris, France"], ["TX", None]),
    (location.location_parts, ["A; b|a ;", None, "A"], [["A", "b"], [], ["A"]]),
    (location.location_in_title, ["Dev (Remote - USA)", "Dev"], ["Remote - USA", ""]),
    (location.city_state_in_text, ["in Salem, OR now"], ["Salem, OR"]),
    (lambda c: classify.infer_category(c, table="board"), ["Security Lead", "Chef", None], ["Legal / Security", "General", "General"]),
    (classify.normalize_job_type, ["FULL-TIME", "Regular", "c2h", " ", "Part time"],
     ["Full time", "Regular", "Contract", "", "Part time"]),
    (lambda c: classify.normalize_category(c, F.lit("Chef"), F.lit("")),
     ["cybersecurity", "x" * 40, None], ["Cybersecurity", "x" * 40, ""]),
    (lambda c: classify.it_score(c, F.lit(None), F.lit(None)), ["Data Engineer", "Nurse", "Sales Engineer"], [2, -3, -1]),
    (jsonv.scalar, ["a", '{"b":1}', "[1]", None], ["a", None, None, None]),
    (jsonv.names, ['[{"name":"A"},{"label":"a"},"B"]', '{"title":"T"}', None], ["A / B", "T", ""]),
    (jsonv.compensation, ['{"summary":"S"}', '{"x":1}', "plain", None], ["S", '{"x":1}', "plain", None]),
    (dates.parse_date,
     ["2024-01-02", "2024-01-02T03:04:05Z", "2024-01-02 03:04:05 UTC", "Tue, 02 Jan 2024 03:04:05 GMT", "1/2/2024",
      "January 2, 2024", "02 Jan 2024", "R-12", "12", None],
     [datetime(2024, 1, 2), *[datetime(2024, 1, 2, 3, 4, 5)] * 3, *[datetime(2024, 1, 2)] * 3, None, None, None]),
    (lambda c: dates.relative_date(c, "2024-03-01"), ["Posted Today", "yesterday", "Posted 30+ Days Ago", "x"],
     [datetime(2024, 3, 1), datetime(2024, 2, 29), datetime(2024, 1, 31), None]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_function(spark, case):
    column, inputs, expected = CASES[case]
    assert values(spark, column, inputs) == expected


def test_variant_codes_stay_distinct_when_hashes_collide(spark):
    import hashlib

    seen, pair = {}, None
    for i in range(5000):
        place = f"city {i}"
        code = hashlib.sha256(place.encode()).hexdigest()[:4]
        if code in seen:
            pair = (seen[code], place)
            break
        seen[code] = place
    df = spark.createDataFrame([(list(pair),)], "p array<string>")
    codes = df.select(location.variant_codes("p")).first()[0]
    assert len(set(codes)) == 2


def test_first_posting_of_a_page(spark):
    page = (
        '<script type="application/ld+json">{broken</script>'
        '<script type="application/ld+json">{"@graph":[{"@type":"Thing"},{"@type":["Role","JobPosting"],'
        '"title":"Dev &amp; Ops","jobLocation":{"address":{"addressLocality":"Reno","addressRegion":"NV"}},'
        '"employmentType":["A","B"],"identifier":{"value":7}}]}</script>'
    )
    df = spark.createDataFrame([(page,)], "html string").select(html.job_posting("html").alias("p"))
    row = df.select(
        "p.title", html.posting_location("p"), html.posting_job_type("p"), html.posting_identifier("p")
    ).first()
    assert tuple(row) == ("Dev & Ops", "Reno, NV", "A, B", "7")
