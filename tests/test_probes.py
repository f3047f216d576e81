import fnmatch

from pyspark.sql import functions as F

from jobweave import rules
from jobweave.operators import patterns, probes
from jobweave.schema import PAYLOADS, conform
from jobweave.sources import registry

CAPTURE = "system string, domain string, site string, url string, final_url string, status_code int, body string"


def test_patterns_by_brute_force(spark):
    globs = ["*.example.com/*/job/*", "*.example.com/*", "example.com/*", "*ple.com/a*", "*/b_c%/*", "a.example.com", "*", " ", None, "HTTPS://A.Example.com/*", "*.com/x?y=*", "x*.org/*"]
    urls = ["https://a.example.com/en/job/1", "http://example.com/abc", "https://simple.com/a", "https://q.org/b_c%/d", "https://q.org/bxc%/d", "a.example.com", "A.EXAMPLE.com/x?y=1", "https://x1.org/", None, "", "https://evil.org/z.example.com/q"]
    left = spark.createDataFrame([(i, u, "n") for i, u in enumerate(urls)], "i int, url string, note string")
    right = spark.createDataFrame([(p,) for p in globs], "pattern string")

    def halves(x):
        bare = x.strip().lower().removeprefix("https://").removeprefix("http://")
        end = min((bare.find(c) for c in "/?#" if c in bare), default=len(bare))
        return bare[:end], bare[end:]

    def fits(text, glob):
        return fnmatch.fnmatchcase(text, glob.replace("[", "[[]").replace("?", "[?]"))

    want = {(i, p) for i, u in enumerate(urls) for p in globs if p and p.strip() for a, b in zip([halves(u or "")], [halves(p)]) if fits(a[0], b[0]) and fits(a[1], b[1])}
    got = [(r["i"], r["pattern"]) for r in patterns.pattern_matches(left, "url", right).collect()]
    assert sorted(got) == sorted(want) and len(want) > 10
    plan = patterns.pattern_matches(left, "url", right)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_all_candidate_lists_are_used(spark):
    sites = spark.createDataFrame([(s, f"T{i}.wd1.myworkdayjobs.com") for i, s in enumerate([*probes.CANDIDATES, "Lever"])], "system string, domain string")
    rows = probes.candidate_urls(sites.union(sites)).collect()
    lists = [rules.WORKDAY_SITE_CANDIDATES, rules.ICIMS_PATHS, rules.JAZZHR_PATHS, rules.ORACLE_SITES, rules.ZOHO_PATHS]
    assert len(rows) == sum(map(len, lists))
    for (system, (values, _)), listed in zip(probes.CANDIDATES.items(), lists):
        assert values is listed
        assert [r["candidate"] for r in sorted(rows, key=lambda r: r["attempt"]) if r["system"] == system] == listed
    assert {r["probe_url"] for r in rows if r["system"] == "iCIMS"} == {f"https://t1.wd1.myworkdayjobs.com{p}" for p in rules.ICIMS_PATHS}


def test_first_valid_in_order(spark):
    sites = spark.createDataFrame([("JazzHR", "a.x"), ("JazzHR", "b.x"), ("JazzHR", "c.x"), ("OracleCloud", "o.x")], "system string, domain string")
    oracle = "https://o.x/hcmUI/CandidateExperience/en/sites/"
    captures = [
        ("https://a.x/", 200, "powered by JazzHR"), ("https://a.x/apply/", 200, '<a href="/apply/abc/t">'), ("https://a.x/apply", 404, "JazzHR"),
        ("https://b.x/", 200, "nothing"), ("https://b.x/apply", None, "JazzHR"), ("https://b.x/apply/", 200, None), ("https://zz.x/", 200, "JazzHR"),
        (oracle + "CX", 200, "plain"), (oracle + "CX_1", 200, '<x data-sitenumber="CX_7">'), (oracle + "CX_1", 200, '<x data-sitenumber="CX_7">'),
    ]
    found = probes.first_valid_candidates(sites, spark.createDataFrame(captures, "url string, status_code int, body string"))
    assert sorted((r["domain"], r["attempt"], r["candidate"], r["attempted"]) for r in found.collect()) == [("a.x", 2, "/apply/", "/apply;/apply/"), ("o.x", 2, "CX_1", "CX;CX_1")]
    assert [tuple(r) for r in probes.oracle_sites(found).collect()] == [("o.x", "CX_7")]
    assert probes.first_valid_candidates(sites, spark.createDataFrame([], "url string, status_code int, body string")).count() == 0


def test_readers_of_odd_bodies(spark):
    rows = [
        ("BambooHR", '{"result":[],"meta":{"totalCount":4}}'), ("BambooHR", '{"result":{}}'), ("BambooHR", '{"result":[{"id":null}]}'), ("BreezyHR", "[]"),
        ("BreezyHR", '[{"name":" N "}]'), ("BreezyHR", "{broken"), ("OracleCloud", '{"items":[{"requisitionList":[{"Id":1}]}]}'), ("OracleCloud", '{"items":[]}'),
        ("Jobsoid", "[1]"), ("ApplicantPro", '{"data":{"jobs":[{"id":5,"jobUrl":""}]}}'), ("PinpointHQ", "<rss><channel></channel></rss>"), ("PinpointHQ", "not xml"),
        ("Personio", "<workzag-jobs><position><name>A</name></position></workzag-jobs>"), ("Freshteam", ""), ("CATSOne", None), ("ZohoRecruit", "<html>signin</html>"), ("Unknown", "[]"), (None, None),
    ]
    made = [(s, f"D{i}.x", "S", f"https://d{i}.x/l", None, 200, b) for i, (s, b) in enumerate(rows)]
    made.append(("BreezyHR", "late.x", "S", "u", None, 500, '[{"name":"N"}]'))
    got = {r["domain"]: (r["job_links_found"], r["sample_job_url"], r["sample_title"]) for r in probes.read_probes(spark.createDataFrame(made, CAPTURE)).collect()}
    assert got == {
        "d0.x": (4, "", ""), "d2.x": (1, "", ""), "d4.x": (1, "", "N"), "d8.x": (1, "", ""), "d9.x": (1, "https://d9.x/jobs/5", ""), "d12.x": (1, "https://d12.x/", "A"),
    }


def test_zoho_reads_rows_links_and_json(spark):
    posting = '<script type="application/ld+json">{"@type":"JobPosting","title":"Inline","url":"https://z.x/i"}</script>'
    rows = [("a.x", '<a href="/jobs/Careers/1234/x">1</a><a href="/jobs/Careers/1234/x">1</a><a href="/jobs/Careers/5678/y">2</a>'), ("b.x", posting), ("c.x", "<p>none</p>")]
    made = [("ZohoRecruit", d, "", f"https://{d}/jobs/Careers", None, 200, b) for d, b in rows]
    got = {r["domain"]: (r["job_links_found"], r["sample_job_url"], r["sample_title"]) for r in probes.read_probes(spark.createDataFrame(made, CAPTURE)).collect()}
    assert got == {"a.x": (2, "https://a.x/jobs/Careers/1234/x", ""), "b.x": (1, "https://z.x/i", "Inline")}


def test_outcomes(spark):
    bodies = [
        ("Jobicy", "list", 200, '{"jobs":[{"id":1,"jobTitle":"T","companyName":"C","jobGeo":"USA","url":"u"},{"id":2,"jobTitle":"T","companyName":"C","jobGeo":"USA","url":"v"}]}'),
        ("Jobicy", "list", 200, '{"jobs":[]}'), ("Jobicy", "list", 503, "x"), ("Jobicy", "list", 200, None), ("Jobicy", "detail", 200, "{}"),
        ("BambooHR", "detail", 200, '{"result":{"jobOpening":{}}}'), ("BambooHR", "detail", 200, '{"error":1}'), ("Freshteam", "list", 200, "<p>No open positions right now</p>"),
        ("JazzHR", "detail", 200, "<h1>Access Denied</h1>"), ("iCIMS", "detail", 200, '<title>Verify you are human</title><script type="application/ld+json">{"@type":"JobPosting"}</script>'),
    ]
    rows = [(i, s, k, c, b) for i, (s, k, c, b) in enumerate(bodies)]
    payloads = conform(spark.createDataFrame(rows, "payload_seq long, source string, kind string, status_code int, body string"), PAYLOADS)
    found = registry.outcomes(payloads, registry.normalize_payloads(payloads, only="Jobicy")).orderBy("payload_seq")
    assert [(r["outcome"], r["postings"]) for r in found.collect()] == [
        ("postings", 2), ("none kept", 0), ("status", 0), ("empty body", 0), ("unknown kind", 0), ("read", 0), ("wrong shape", 0), ("none kept", 0), ("blocked page", 0), ("none kept", 0),
    ]
    assert found.count() == payloads.count()


def test_every_source_and_kind_has_a_shape():
    shaped = {(n, "list") for n in registry._LIST_PATHS} | {(n, "detail") for n in registry._DETAIL_PATHS} | set(registry._PAGE_MARKS)
    for name, entry in registry.NORMALIZERS.items():
        assert all(kind == "feed" or (name, kind) in shaped for kind in entry.kinds), name


def test_routed_payloads_are_read_by_folder(spark):
    """Every scan of a routed table is cut to the folder of one source and kind."""
    rows = [(i, s, k, 200, "[]") for i, (s, e) in enumerate(registry.NORMALIZERS.items()) for k in e.kinds] + [(99, None, None, 200, "x")]
    payloads = conform(spark.createDataFrame(rows, "payload_seq long, source string, kind string, status_code int, body string"), PAYLOADS)
    routed = registry.by_source(payloads)
    assert routed.schema == payloads.schema and sorted(map(str, routed.collect())) == sorted(map(str, payloads.collect()))
    plan = registry.normalize_payloads(routed, only="Lever")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("PartitionFilters: [isnotnull(source" in s and "(source" in s and "(kind" in s for s in scans)
    both = [registry.normalize_payloads(payloads, only="Jobicy", route=r).count() for r in (False, True)]
    assert both == [0, 0]
