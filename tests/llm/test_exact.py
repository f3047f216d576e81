import hashlib
import random
from collections import defaultdict

import pytest

from jobweave.llm import exact

SCHEMA = "doc_id long, text string, keep_id string, kept int, node string, row int, parent double, tags map<string, int>"


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").encode().lower()].append(doc_id)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        stays = ids.index(best)
        out += [(i, best, len(ids), at == stays, hashlib.sha256(text).hexdigest()) for at, i in enumerate(ids)]
    return sorted(out, key=repr)


def rows_of_many_kinds(seed, n):
    rng = random.Random(seed)
    texts = ["", None, "É É", "é é", "A b", "a B", "a b ", "a\x00b", "z" * 9_000, "Z" * 9_000] + [f"t{i} " * rng.randint(1, 60) for i in range(n // 2)]
    rows = [(i, rng.choice(texts)) for i in range(n)] + [(1000 + i, "Hot text " * 30) for i in range(n // 2)]
    rows += [(None, "a b"), (None, "alone"), (None, "alone"), (7, "twice"), (7, "twice"), (7, "TWICE"), (2**62, "hot text " * 30)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("table_bytes, buckets", [(64 << 20, 8192), (500, 8192), (4_000, 8)])
def test_against_brute_force(llm, monkeypatch, table_bytes, buckets):
    """Whole tables; buckets that don't fit at first; folders of buckets."""
    monkeypatch.setattr(exact, "TABLE_BYTES", table_bytes)
    monkeypatch.setattr(exact, "MAX_BUCKETS", buckets)
    levels = []
    settle = exact._settle
    monkeypatch.setattr(exact, "_settle", lambda e, s, level: levels.append(level) or settle(e, s, level))
    rows = rows_of_many_kinds(5, 120)
    docs = llm.createDataFrame([(*r, "x", 2, "n", 1, 0.5, {"k": 1}) for r in rows], SCHEMA).repartition(5)
    found = exact.classes(docs, keep=["doc_id"])
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows)
    assert (max(levels) > 1) == (table_bytes < 64 << 20), levels


def test_equal_digests_of_different_texts():
    """The table compares whole texts; equal digests only bring them to the same slot."""
    table = exact.Table()
    for i in range(3000):
        digest = bytes([i % 3]) * 32
        assert table.find(digest, b"%d" % i) == -1
        assert table.add(digest, b"%d" % i) == i
    assert all(table.find(bytes([i % 3]) * 32, b"%d" % i) == i for i in range(3000))


def test_rows_that_stay(llm):
    rows = [(1, "A b", "p", 0, "q", 5, 0.5, {"k": 1}), (2, "a B", "r", 1, "s", 6, 1.5, {"k": 2}), (None, "a b", "t", 2, "u", 7, None, None), (3, None, None, 3, None, 8, 0.0, {})]
    docs = llm.createDataFrame(rows, SCHEMA)
    kept = exact.drop_copies(docs)
    assert kept.schema == docs.schema
    assert sorted(tuple(r) for r in kept.collect()) == [rows[1], rows[3]]
    assert exact.drop_copies(docs.limit(0)).count() == 0
    assert exact.classes(docs.limit(0)).count() == 0
    whole = exact.classes(docs).collect()
    assert sorted(r["text"] or "" for r in whole) == ["", "A b", "a B", "a b"] and sum(r["kept"] for r in whole) == 2


def test_ties_of_ids_have_a_fixed_order(llm):
    """Rows that share id and text but not the rest: the same one stays however they lie."""
    rows = [(5, "same", str(i), i, "n", i, 0.0, None) for i in range(20)]
    stays = {exact.drop_copies(llm.createDataFrame(rows[i:] + rows[:i], SCHEMA).repartition(3)).first()["row"] for i in (0, 7, 13)}
    assert len(stays) == 1
