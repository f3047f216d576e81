"""The pipeline over small tables, each stage against plain Python on its own input."""

import os
from collections import Counter

import pytest
from test_decontaminate import brute as judge
from test_mixing import brute as mix
from test_simhash import brute_print
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from jobweave.llm import quality, simhash
from jobweave.llm.common import table
from jobweave.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(llm, tmp_path):
    docs = table(llm, SF, "documents").cache()
    stages = dict(pipeline.STAGES)
    assert [name.split()[0] for name in stages] == ["quality", "SimHash", "benchmark", "mixing", "token-ID"]
    first, second, third, fourth, last = stages.values()

    scored = quality.with_score(docs, quality.fit(docs, table(llm, SF, "labels"))).collect()
    good = first(llm, docs, SF).cache()
    assert good.columns == COLUMNS
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in scored if r["score"] >= quality.THRESHOLD}

    prints = [(r["doc_id"], brute_print(r["text"])) for r in good.collect()]
    label = dict.fromkeys((d for d, _ in prints), None)
    for d, p in sorted(prints):
        todo = [p] if label[d] is None else []
        while todo:
            at = todo.pop()
            for e, q in prints:
                if label[e] is None and (q ^ at).bit_count() <= simhash.RADIUS:
                    label[e] = d
                    todo.append(q)
    single = second(llm, good, SF).cache()
    assert single.columns == COLUMNS and sorted(r["doc_id"] for r in single.collect()) == sorted(set(label.values()))

    items = [(r["item_id"], r["text"]) for r in table(llm, SF, "benchmark").collect()]
    clean = third(llm, single, SF).cache()
    want = judge([(r["doc_id"], r["text"]) for r in single.collect()], items)
    assert clean.columns == COLUMNS and sorted(r["doc_id"] for r in clean.collect()) == sorted(w[0] for w in want if not w[4])

    mixed = fourth(llm, clean, SF).cache()
    copies = {w[0]: w[5] for w in mix([(r["doc_id"], r["text"], r["lang"], r["source"]) for r in clean.collect()])}
    assert mixed.columns == COLUMNS and Counter(r["doc_id"] for r in mixed.collect()) == copies

    plain = Tokenizer.from_file(tokenizer_path())
    lengths = {r["doc_id"]: len(plain.encode(r["text"], add_special_tokens=False).ids) + 1 for r in clean.collect()}
    out = last(llm, mixed, SF).orderBy("start").collect()
    start = 0
    for row in out:
        assert (row["start"], row["n_tokens"]) == (start, lengths[row["doc_id"]])
        start += row["n_tokens"]
    assert Counter(r["doc_id"] for r in out) == copies


def test_run_over_odd_and_empty_tables(llm, tmp_path):
    rows = [(1, None, None, None, None, "x"), (None, "", "en", "src0", 0, "x"), (2, "some clean words of text to keep " * 3, "en", "src1", 9, "x")]
    rows += [(2, "some clean words of text to keep " * 3, "en", "src1", 9, "x")] * 2 + [(3, "long words " * 50_000, "de", "src2", 1, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    for name, n in (("odd", len(rows)), ("none", 0)):
        base = str(tmp_path / name)
        llm.createDataFrame(rows, schema).limit(n).write.parquet(f"{base}/documents.parquet")
        llm.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
        llm.createDataFrame([], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
        out = pipeline.run(llm, base).collect()
        assert {r["doc_id"] for r in out} == ({2, 3} if n else set())
