import hashlib
import random
import re
from collections import Counter

from jobweave.llm import mixing as m

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def fill(budget, children):
    """children: name -> (room, weight); as told in words: share, cap, share the rest again."""
    got, open_ = {}, dict(children)
    while open_:
        weight = sum(w for _, w in open_.values())
        full = [n for n, (room, w) in open_.items() if room * weight <= budget * w]
        if not full:
            got |= {n: budget * w // weight for n, (_, w) in open_.items()}
            break
        n = min(full, key=lambda x: (open_[x][0] / open_[x][1], x))
        got[n] = open_.pop(n)[0]
        budget -= got[n]
    return got


def brute(docs):
    rows = []
    for doc_id, text, lang, source in docs:
        number = re.search(r"([0-9]{1,9})$", source or "")
        domain = m.DOMAINS[int(number[1]) % 4 if number else 0]
        rows.append(((domain, lang or "", source or ""), doc_id, len(WORDS.findall(text or "")), hashlib.md5((text or "").encode()).hexdigest()))
    tokens = Counter()
    for leaf, _, n, _ in rows:
        tokens[leaf] += n
    tokens = {k: v for k, v in tokens.items() if v}
    weight = lambda p: [m.DOMAIN_WEIGHTS.get(p[0], 1), m.LANG_WEIGHTS.get(p[1], 1) if len(p) > 1 else 0, 1][len(p) - 1]
    budgets = {(): sum(tokens.values()) * m.BUDGET_PERCENT // 100}
    for depth in (1, 2, 3):
        level = {}
        for parent, budget in budgets.items():
            kids = {leaf[:depth] for leaf in tokens if leaf[: depth - 1] == parent}
            level |= fill(budget, {k: (m.MAX_EPOCHS * sum(v for leaf, v in tokens.items() if leaf[:depth] == k), weight(k)) for k in kids})
        budgets = level
    taken = []
    for leaf, budget in budgets.items():
        full, rest = divmod(budget, tokens[leaf])
        own = [r for r in rows if r[0] == leaf]
        draw = lambda r: hashlib.md5(f"{m.SEED}|{full}|{'' if r[1] is None else r[1]}|{r[3]}".encode()).hexdigest()
        start = 0
        for _, doc_id, n, _ in sorted(own, key=lambda r: (draw(r), str(r[1]))):
            more = int(start < rest and n > 0)
            if n and full + more:
                taken.append((doc_id, *leaf, n, full + more, min(n, rest - start) if more else 0))
            start += n
    return sorted(taken, key=repr)


def documents():
    rng = random.Random(5)
    docs = []
    for i in range(300):
        source = rng.choice(["src0", "src0", "src0", "src1", "src2", "src6", "src7", "plain", None])
        text = rng.choice([None, "", "one", " ".join(["word"] * rng.randint(1, 60)), "\t two  words\n"])
        docs.append((rng.choice([i, i, i, None]), text, rng.choice(["en", "de", "xx", None]), source))
    return docs + [(5, "same same", "en", "src0")] * 4 + [(900, "long " * 100_000, "fr", "src3")]


def frame(spark, docs):
    return spark.createDataFrame([(*r, 3, "x", "y") for r in docs], "doc_id long, text string, lang string, source string, n_tokens int, domain string, copies string")


def test_against_brute_force(llm):
    docs = documents()
    got = m.select_documents(frame(llm, docs)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs)


def test_mixed_rows(llm):
    docs = documents()
    source = frame(llm, docs)
    mixed = m.mix(source)
    assert mixed.columns == source.columns
    want = Counter()
    for doc_id, _, lang, src, n, copies, _ in brute(docs):
        want[(doc_id, lang, src, n)] += copies
    rows = Counter((r["doc_id"], r["lang"] or "", r["source"] or "", len(WORDS.findall(r["text"] or ""))) for r in mixed.collect())
    assert rows == want


def test_rows_that_share_id_and_text(llm):
    """Every row stays with its own other columns; what is over is dealt alike every time."""
    docs = [(1, "same text", "en", "src0")] * 7
    tagged = [(*r, i % 4, "x" if i < 4 else "y", "z") for i, r in enumerate(docs)]
    schema = "doc_id long, text string, lang string, source string, n_tokens int, domain string, copies string"
    for percent in (100, 200, 150, 45):
        seen = []
        for rows in (tagged, tagged[::-1]):
            mixed = m.mix(llm.createDataFrame(rows, schema).repartition(3), budget_percent=percent)
            seen.append(Counter(tuple(r) for r in mixed.collect()))
        assert seen[0] == seen[1]
        chosen = m.select_rows(llm.createDataFrame(tagged, schema), budget_percent=percent).collect()
        total = sum(r["copies"] for r in chosen)
        assert sum(seen[0].values()) == total
        each = Counter(map(tuple, tagged))
        assert all(total // 7 * each[r] <= seen[0][r] <= (total // 7 + 1) * each[r] for r in each)


def test_shortage_goes_to_siblings_first(llm):
    big, small = "w " * 1000, "w " * 10
    docs = [(1, big, "en", "src0"), (2, small, "de", "src0"), (3, big, "en", "src1")]
    leaves = {(r["domain"], r["lang"]): r["budget"] for r in m.leaf_budgets(m.select_rows(frame(llm, docs)).groupBy(*m.LEVELS).agg({"n_tokens": "sum"}).withColumnRenamed("sum(n_tokens)", "tokens")).collect()}
    # web: 2 of 3 of 1206 tokens; its de leaf can use 40, its en leaf gets the rest
    assert leaves == {("web", "de"): 40, ("web", "en"): 764, ("books", "en"): 402}


def test_empty_and_wordless(llm):
    assert m.select_documents(frame(llm, documents()).limit(0)).count() == 0
    assert m.mix(frame(llm, [(1, None, "en", "src0"), (2, " ", None, None)])).count() == 0
