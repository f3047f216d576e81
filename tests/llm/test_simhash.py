import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from jobweave.llm import simhash
from jobweave.llm.components import components

SCHEMA = "doc_id long, text string, fp string, root string, component_id int, u string"


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    prints = [brute_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= simhash.RADIUS:
                parent[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(ids.get(find(i), doc_id), doc_id)
    return sorted(((d, prints[i], ids.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def found(spark, rows):
    docs = spark.createDataFrame([(*r, "x", "y", 3, "z") for r in rows], SCHEMA)
    out = simhash.near_duplicates(docs).collect()
    return sorted(((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in out), key=repr)


def test_against_brute_force(llm, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)  # so that keys are cut into blocks
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(200)]
    base = [[rng.choice(words) for _ in range(rng.randint(1, 120))] for _ in range(40)]
    rows = [(None, None), (0, ""), (1, " \t\n"), (2, "One two"), (2, "one  TWO"), (3, "É é"), (None, "one two"), (4, "a " * 50_000)]
    for i in range(160):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((10 + i, " ".join(text)))
    assert found(llm, rows) == brute_components(rows)


def test_dense_cluster(llm, monkeypatch):
    """Fingerprints a few bits around one centre: all keys are crowded."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(150)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    links = simhash.links(llm.createDataFrame([(p,) for p in signed], "fp long"))
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    values = np.array(signed).view(np.uint64)
    label = dict(zip(signed, signed))
    for _ in range(len(signed)):
        for i, a in enumerate(signed):
            near = [signed[j] for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3)]
            label[a] = min(label[n] for n in near)
    assert {p: roots.get(p, p) for p in signed} == label


def test_components_of_a_long_path(llm):
    path = llm.range(60).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    odd = llm.createDataFrame([(None, 5), (7, 7), (100, 101), (101, 100)], "u long, v long")
    roots = {r["node"]: r["root"] for r in components(path.union(odd)).collect()}
    assert roots == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(path.limit(0)).count() == 0


def test_one_of_each(llm):
    rows = [(3, "same text here ok"), (1, "Same text HERE ok"), (1, "same text here ok"), (8, "another one entirely different"), (None, "lonely words without id"),
            (None, "lonely words without id"), (9, None)]
    docs = llm.createDataFrame([(*r, "x", "y", 3, "z") for r in rows], SCHEMA)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == ["1", "8", "9", "None"]
    assert simhash.one_of_each(docs.limit(0)).count() == 0
