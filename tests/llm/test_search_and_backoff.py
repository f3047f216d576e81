import math
import random
from collections import Counter

from pyspark.sql import functions as F

from jobweave.llm import backoff, search


def texts(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{int(rng.paretovariate(0.6))}" for _ in range(300)]
    return [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def brute_search(docs, queries, k):
    bags = [Counter((t or "").lower().split()) for _, t in docs]
    n, mean = len(docs), sum(sum(b.values()) for b in bags) / len(docs)
    df = Counter(w for b in bags for w in b)
    out = []
    for q, text in queries:
        scored = []
        for (doc_id, _), bag in zip(docs, bags):
            shared = set((text or "").lower().split()) & bag.keys()
            if shared:
                norm = search.K1 * (1 - search.B + search.B * sum(bag.values()) / mean)
                score = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * bag[w] * (search.K1 + 1) / (bag[w] + norm) for w in shared)
                scored.append((-round(score, search.DIGITS), doc_id is None, doc_id))
        out += [(q, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored)[:k])]
    return out


def test_search_against_brute_force(llm, monkeypatch):
    monkeypatch.setattr(search, "SHARD_ROWS", 60)
    monkeypatch.setattr(search, "QUERY_BLOCK", 9)
    monkeypatch.setattr(search, "BLOCK", 4)
    docs = list(enumerate(texts(1, 200))) + [(None, "w1 w2"), (7, "w1 w1 w3"), (7, "w1 w1 w3"), (300, None), (301, ""), (302, "w1 " * 50_000)]
    queries = list(enumerate(texts(2, 25))) + [(90, None), (91, ""), (92, "nowhere"), (93, "W1 w3"), (93, "W1 w3"), (94, " ".join(t for _, t in docs[:60]))]
    frame = llm.createDataFrame([(*r, 1, "x", 2) for r in docs], "doc_id long, text string, score int, words string, rank int")
    got = search.search(frame, llm.createDataFrame(queries, "query_id long, text string"), 5).collect()
    key = lambda r: (r[0], r[1], repr(r[2]))
    rows = sorted((tuple(r) for r in got), key=key)
    want = sorted(brute_search(docs, queries, 5), key=key)
    assert [(r[0], r[1]) for r in rows] == [(r[0], r[1]) for r in want]
    assert all(abs(a[3] - b[3]) < 1e-5 for a, b in zip(rows, want))
    assert sum(a[2] == b[2] for a, b in zip(rows, want)) >= len(want) - 2  # equal scores may be rounded apart
    assert search.search(frame.limit(0), llm.createDataFrame(queries, "query_id long, text string")).count() == 0
    assert search.search(frame, llm.createDataFrame([], "query_id long, text string")).count() == 0


def brute_scores(docs):
    bags = [(t or "").lower().split() for _, t in docs]
    counts = Counter(w for b in bags for w in b)
    read = [["", *b] if b else [] for b in bags]
    single = Counter(w for r in read for w in r)
    double = Counter(p for r in read for p in zip(r, r[1:]))
    total = sum(counts.values())
    out = []
    for (doc_id, _), r in zip(docs, read):
        logs = [math.log(double[p] / single[p[0]]) if double[p] >= backoff.MIN_COUNT else math.log(backoff.BACKOFF * single[p[1]] / total) for p in zip(r, r[1:])]
        out.append((doc_id, len(logs), round(sum(logs), 6)))
    return sorted(out, key=repr)


def test_backoff_against_brute_force(llm, monkeypatch):
    monkeypatch.setattr(backoff, "HOT", 5)
    docs = list(enumerate(texts(3, 150))) + [(None, None), (9, ""), (9, "w1 w1"), (9, "w1 w1"), (None, "W1 only"), (400, "x" * 100 + " w1"), (401, "w1 w2 " * 30_000)]
    frame = llm.createDataFrame([(*r, 1, "x", 2) for r in docs], "doc_id long, text string, row int, pair string, a int")
    want = brute_scores(docs)
    for size in (backoff.VOCABULARY, 20):  # ranks change no result
        monkeypatch.setattr(backoff, "VOCABULARY", size)
        got = sorted(((r["doc_id"], r["n_words"], round(r["log_score"], 6)) for r in backoff.scores(frame).collect()), key=repr)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert all(math.isclose(g[2], w[2], rel_tol=1e-6, abs_tol=1e-4) for g, w in zip(got, want))
    assert backoff.scores(frame.limit(0)).count() == 0


def test_words_that_share_a_number(llm, monkeypatch):
    """Ids of eight bits: most words share one at first."""
    whole = backoff.word_id
    monkeypatch.setattr(backoff, "word_id", lambda w, seeds: whole(w, seeds).bitwiseAND(F.lit(255)).bitwiseOR(F.lit(-(1 << 63))))
    docs = llm.createDataFrame([(i, t) for i, t in enumerate(texts(6, 60))], "doc_id long, text string")
    vocab = backoff.vocabulary(docs)
    ids, seeds = backoff.numbered(vocab)
    assert seeds and ids.select("id").distinct().count() == vocab.count() == ids.count()
    got = {r["doc_id"]: r["log_score"] for r in backoff.scores(docs).collect()}
    want = {d: s for d, _, s in brute_scores([(r["doc_id"], r["text"]) for r in docs.collect()])}
    assert all(math.isclose(got[d], want[d], rel_tol=1e-6, abs_tol=1e-4) for d in want)
