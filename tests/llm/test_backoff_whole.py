"""Backoff scores keep every word, however many and however long."""

import math
import random
from collections import Counter

from jobweave.llm import backoff


def brute(docs):
    read = [["", *w] if (w := (t or "").lower().split()) else [] for _, t in docs]
    single = Counter(w for r in read for w in r)
    double = Counter(p for r in read for p in zip(r, r[1:]))
    total = sum(n for w, n in single.items() if w)
    out = []
    for (doc_id, _), r in zip(docs, read):
        logs = [math.log(double[p] / single[p[0]]) if double[p] >= backoff.MIN_COUNT else math.log(backoff.BACKOFF * single[p[1]] / total) for p in zip(r, r[1:])]
        out.append((doc_id, len(logs), sum(logs)))
    return sorted(out, key=repr)


def check(llm, docs):
    frame = llm.createDataFrame(docs, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_words"], r["log_score"]) for r in backoff.scores(frame).collect()), key=repr)
    want = brute(docs)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(math.isclose(g[2], w[2], rel_tol=1e-9, abs_tol=1e-6) for g, w in zip(got, want))


def test_more_words_than_the_ranked_ones(llm):
    many = [f"r{i}" for i in range(backoff.VOCABULARY + 5000)]
    docs = [(i, " ".join(many[i::50])) for i in range(50)]
    check(llm, [*docs, (50, "r1 r2 r3 r70000 r69999"), (51, "r70000 r69999 r70000 r69999")])


def test_long_words(llm):
    long = [f"{'x' * 90}{i}" for i in range(4)]
    check(llm, [(1, " ".join(long)), (2, f"{long[0]} {long[1]} a {long[3]}"), (3, f"a {long[2]}"), (4, long[0])])


def test_every_way_a_pair_is_dealt(llm, monkeypatch):
    monkeypatch.setattr(backoff, "VOCABULARY", 12)
    monkeypatch.setattr(backoff, "HOT", 4)
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(200)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    check(llm, [*docs, *docs[:5], (None, docs[0][1]), (None, docs[0][1]), (7, "W1 other"), (7, None), (None, None), (8, "")])
