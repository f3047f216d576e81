import hashlib
import random

from jobweave.llm import warc
from jobweave.llm.common import shared_folder

SCHEMA = "page_id long, url string, html string, digest string"


def expected(rows):
    first = {}
    for i, (page_id, url, html, _) in enumerate(rows):
        body = (html or "").encode()
        if len(body) >= warc.LEAST_REVISIT:
            key = (page_id is None, page_id or 0, url is not None, url or "", i)
            first[body] = min(first.get(body, key), key)
    out = []
    for i, (page_id, _, html, _) in enumerate(rows):
        body = (html or "").encode()
        at = first.get(body)
        revisit = at is not None and at[4] != i
        refers = None if not revisit or at[0] else str(at[1])
        out.append((str(page_id) if page_id is not None else None, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", refers))
    return sorted(out, key=repr)


def read_back(spark, rows, files=3):
    path = shared_folder(spark, "warc-test")
    pages = spark.createDataFrame(rows, SCHEMA)
    warc.write_archives(warc.plan_records(pages).repartition(files), path)
    read = warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r) for r in read.collect()), key=repr)


def test_hostile_payloads_and_small_splits(small_splits):
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:99:9>\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    endless = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 999999\r\n\r\n"
    odd = ["", "\r\n", "\r\n\r\n", "\r", "\n\r\n\r", "x\r\n\r\n", "WARC/1.1\r\n", "\r\n\r\nWARC/1.", "é", "\r\n\r\nWARC/1.1\r\nContent-Length: x\r\n\r\n"]
    parts = ["\r\n\r\n" + record, "\r\n\r\n" + endless, "text " * 40, *odd]
    rng = random.Random(5)
    rows = [(i, "http://a/\r\nX: y", x, "clash") for i, x in enumerate(odd)]
    rows += [(100 + i, None, "".join(rng.choice(parts) for _ in range(rng.randint(1, 9))), None) for i in range(120)]
    rows += [(300, "u", ("\r\n\r\n" + record) * 60, "x"), (301, "u", record, "x"), (302, "u", endless * 3, "x")]
    assert read_back(small_splits, rows) == expected(rows)


def test_ties_nulls_and_repeated_rows(llm, monkeypatch):
    check_ties(llm)
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", -1)  # the way of many repeated payloads
    check_ties(llm)


def check_ties(llm):
    same = "the same page " * 10
    rows = [(5, "u", same, None), (2, "v", same, None), (2, "v", same, None), (None, "w", same, None), (7, None, None, None), (8, "", "short", None), (9, "", "short", None)]
    assert read_back(llm, rows) == expected(rows)
    nameless = [(None, None, same, None)] * 3
    assert [r[3] for r in read_back(llm, nameless)].count("response") == 1


def test_empty_table_and_one_long_page(llm):
    assert read_back(llm, []) == []
    rows = [(1, "u", "long \r\n\r\nWARC/1.1\r\n" * 100_000, None)]
    assert read_back(llm, rows) == expected(rows)


def test_foreign_archive_with_a_cut_record(llm):
    path = shared_folder(llm, "foreign")
    one = "WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc"
    two = "WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 300\r\n\r\nabc"
    llm.createDataFrame([(one + "\r\n\r\n" + two,)], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    assert [(r["record_type"], r["payload_bytes"]) for r in warc.read_archives(llm, path).collect()] == [("warcinfo", 3)]
