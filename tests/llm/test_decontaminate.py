import random
import re

from jobweave.llm import decontaminate as d

APART = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return APART.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items):
    windows = []
    for item_id, text in items:
        own = words(text)
        n = min(13, len(own))
        windows += [(item_id, own[i : i + n]) for i in range(len(own) - n + 1) if n]
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item_id, window in windows:
            for i in range(len(own) - len(window) + 1):
                if own[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(item_id)
        listed = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(own), len(hit), listed, bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(11)
    vocab = ["a", "b", "the", "Öl", "été", "x9", "42", "No", "ÄRGER"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 12, 13, 14, 30]))) for i in range(14)] + [(3, None), (4, ""), (None, text(15)), (5, "!!"), (11, text(20)), (11, text(20))]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)]
    docs += [(100 + i, f"{text(rng.randint(0, 30))}; {(items[i][1] or '').upper()}!! {text(rng.randint(0, 400))}") for i in range(len(items))]
    docs += [(None, None), (7, ""), (7, ""), (None, text(20)), (500, "word " * 60_000 + items[7][1])]
    return docs, items


def judged(spark, docs, items):
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in docs], "doc_id long, text string, item_id string, start int, words string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = d.judge(frame, bench).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows), key=repr), frame, bench


def test_against_brute_force(llm, monkeypatch):
    docs, items = cases()
    want = brute(docs, items)
    assert judged(llm, docs, items)[0] == want
    monkeypatch.setattr(d, "BROADCAST_BYTES", -1)  # the way of a large benchmark
    got, frame, bench = judged(llm, docs, items)
    assert got == want
    kept = d.remove_documents(frame, bench)
    assert kept.columns == frame.columns and kept.count() == sum(not w[4] for w in want)


def test_spans_go_and_the_rest_stays(llm):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = llm.createDataFrame([(1, f"Before, {item.upper()}; after it. End"), (2, "clean text."), (3, None)], "doc_id long, text string")
    cleaned = {r["doc_id"]: r["text"] for r in d.remove_spans(docs, llm.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert cleaned == {1: "Before, after it. End", 2: "clean text.", 3: None}


def test_empty_tables(llm):
    docs, items = cases()
    none = llm.createDataFrame([], "doc_id long, text string")
    bench = llm.createDataFrame(items, "item_id long, text string")
    assert d.judge(none, bench).count() == 0
    rows = d.judge(llm.createDataFrame(docs, "doc_id long, text string"), bench.limit(0)).collect()
    assert len(rows) == len(docs) and not any(r["n_hit"] or r["contaminated"] for r in rows)
