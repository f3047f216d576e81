"""Classifiers: held-out accuracy, and rows of every kind."""

import os

import numpy as np
import pytest

from jobweave.llm import quality, toxicity
from jobweave.llm.common import held_out, table

SF = "/root/testdata/sf0.1"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")


def truth(spark, scored, label):
    labels = table(spark, SF, "labels").select("doc_id", label)
    rows = scored.where(held_out(scored["doc_id"])).join(labels, "doc_id").select(label, "score").collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows])


@needs_tables
def test_quality_held_out(llm):
    docs = table(llm, SF, "documents")
    machine = quality.fit(docs, table(llm, SF, "labels"))
    labels, scores = truth(llm, quality.with_score(docs.select("doc_id", "text"), machine), "quality")
    assert ((scores >= quality.THRESHOLD) == labels).mean() > 0.98


@needs_tables
def test_toxicity_held_out(llm):
    docs = table(llm, SF, "documents")
    lexicon = toxicity.fit(docs, table(llm, SF, "labels"))
    labels, scores = truth(llm, toxicity.with_score(docs.select("doc_id", "text"), lexicon), "toxic")
    found = scores >= toxicity.THRESHOLD
    assert (found == labels).mean() > 0.95
    assert (scores[labels == 0] < toxicity.THRESHOLD).mean() > 0.99
    assert found[labels == 1].mean() >= 0.9 and labels[found].mean() >= 0.95
    again = toxicity.fit(docs.repartition(7), table(llm, SF, "labels"))
    assert again == lexicon


def test_pair_sum_is_the_sum_over_pairs():
    rng = np.random.default_rng(4)
    machine = quality.Machine(0.3, rng.normal(size=quality.FEATURES), rng.normal(size=(quality.FEATURES, 5)))
    index, values = quality.features("Some text, some TEXT | with !! marks 12".encode())
    x = np.array(values, dtype=float)
    pairs = sum(machine.factors[i] @ machine.factors[j] * a * b for k, (i, a) in enumerate(zip(index, x)) for j, b in zip(index[:k], x[:k]))
    got = machine.raw(np.array(index), x, np.array([0]))[0]
    assert np.isclose(got, 0.3 + machine.linear[index] @ x + pairs)


ROWS = [(1, None, 9.0), (2, "", 9.0), (None, "some words", 9.0), (3, "long " * 200_000, 9.0), (3, "long " * 200_000, 9.0), (4, "you idiot, you moron", 9.0)]


def test_rows_of_every_kind(llm):
    docs = llm.createDataFrame(ROWS, "doc_id long, text string, score double")
    none = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = llm.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (2, None, None), (3, 0, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        for scored in (quality.with_score(docs, quality.fit(docs, labels)), toxicity.with_score(docs, toxicity.fit(docs, labels))):
            rows = scored.collect()
            assert sorted(scored.columns) == ["doc_id", "score", "text"] and len(rows) == len(ROWS)
            assert all(0 <= r["score"] <= 1 for r in rows)
    assert quality.keep_good(docs, quality.fit(docs, none)).count() == len(ROWS)
    assert quality.with_score(docs.limit(0), quality.fit(docs, none)).count() == 0
    assert toxicity.with_score(docs.limit(0), toxicity.fit(docs, none)).count() == 0


def test_folding_and_exceptions():
    lexicon = toxicity.Lexicon({"idiot": 3.0, "trash": 3.0}, ("trash can",))
    hits = lambda text: lexicon.hits(toxicity.fold(text))[1]
    assert [hits(t) for t in ("IDIOT!", "an 1d10t", "іdіоt", "ｉｄｉｏｔ", "idiotic", "an id iot", "pidiot")] == [1, 1, 1, 1, 1, 0, 0]
    assert [hits(t) for t in ("trash", "the trash can", "trash can, trash", "trash cannot")] == [1, 0, 1, 1]
    short, long_ = lexicon.score(["idiot", "idiot " + "word " * 5000])
    assert short > long_


def naive(lexicon, text):
    """(score, hits) by trying every term and exception at every word."""
    words = toxicity.fold(text).split()
    free = set(range(len(words)))
    for phrase in lexicon.exceptions:
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                free -= set(range(i, i + len(p)))
    best = {}
    for i in free:
        for term, weight in lexicon.terms.items():
            bare = term.removesuffix("+")
            if words[i].startswith(bare) and (bare == term or len(words[i]) > len(bare)):
                best[i] = max(best.get(i, 0.0), weight)
    total, n = sum(best.values()), max(1, len(words))
    x = [float(bool(best)), np.log1p(total), np.log1p(100 * total / n)]
    return 1 / (1 + np.exp(-np.clip(lexicon.curve[0] + np.dot(x, lexicon.curve[1:]), -30, 30))), len(best)


def test_against_a_naive_matcher():
    rng = np.random.default_rng(11)
    letters = list("abo013 é") + [" "] * 3 + ["."]
    for _ in range(60):
        made = lambda lo, hi: "".join(rng.choice(list("abo"), rng.integers(lo, hi)))
        terms = {made(1, 4) + ("+" if rng.random() < 0.4 else ""): float(rng.uniform(0.2, 4)) for _ in range(12)}
        exceptions = tuple(sorted({f"{made(1, 4)} {made(1, 4)}" for _ in range(4)}))
        lexicon = toxicity.Lexicon(terms, exceptions, tuple(float(c) for c in rng.normal(size=4)))
        for n in (0, 1, 5, 40, 300):
            text = "".join(rng.choice(letters, n))
            score, hits = naive(lexicon, text)
            assert lexicon.hits(toxicity.fold(text))[1] == hits
            assert np.isclose(lexicon.score([text])[0], score)


def test_terms_come_from_labels(llm):
    """A term that others have as often is no term; a given one is weighed or dropped; a harmless neighbour is learned."""
    docs, labels = [], []
    rng = np.random.default_rng(5)
    plain = [f"w{i}q" for i in range(400)]
    for i in range(600):
        words = list(rng.choice(plain, 30))
        toxic = int(i % 5 == 0)
        if toxic:
            words[rng.integers(30)] = rng.choice(["zorkmen", "zorkie", "blargh"])
        elif i % 29 == 0:
            words[3:5] = ["blargh", "soup"]
        elif i % 11 == 0:
            words[4] = "zork"
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    frames = llm.createDataFrame(docs, "doc_id long, text string"), llm.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.fit(*frames, candidates=["w7q", "ZORK"])
    assert {"blargh soup"} <= set(lexicon.exceptions)
    assert not lexicon.terms.get("w1q") and all(w > 0 for w in lexicon.terms.values())
    scored = toxicity.with_score(frames[0], lexicon).join(frames[1], "doc_id").collect()
    assert np.mean([(r["score"] >= toxicity.THRESHOLD) == r["toxic"] for r in scored]) > 0.98


def test_quality_score_by_a_plain_loop(llm):
    rng = np.random.default_rng(9)
    texts = ["", None, "One | two !!\n\nOne | two !!", "word " * 3000] + [" ".join(rng.choice(["the", "The", "x9", "a.b", "--"], rng.integers(1, 60))) for _ in range(30)]
    machine = quality.Machine(0.1, rng.normal(size=quality.FEATURES), rng.normal(size=(quality.FEATURES, 3)) * 0.3)
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r["score"] for r in quality.with_score(docs, machine).collect()}
    for i, text in enumerate(texts):
        index, x = quality.features((text or "").encode())
        raw = machine.bias + sum(machine.linear[a] * v for a, v in zip(index, x))
        for k in range(len(index)):
            raw += sum(float(machine.factors[index[k]] @ machine.factors[index[j]]) * x[k] * x[j] for j in range(k))
        assert np.isclose(got[i], 1 / (1 + np.exp(-np.clip(raw, -30, 30))), rtol=1e-4, atol=1e-6)


def test_one_row_per_id(llm):
    """Rows that share an id count once, the same one in any order."""
    docs = [(i, f"text {i} of {j}") for i in range(30) for j in range(4)]
    labels = llm.createDataFrame([(i, i % 2, i % 2) for i in range(30)], "doc_id long, quality int, toxic int")
    fits = [quality.fit(llm.createDataFrame(d, "doc_id long, text string").repartition(n), labels) for d, n in ((docs, 2), (docs[::-1], 5))]
    assert fits[0].bias == fits[1].bias and (fits[0].linear == fits[1].linear).all() and (fits[0].factors == fits[1].factors).all()
