import math

import numpy as np
import pytest

from jobweave.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row int, x string, score long, shard string, anchor int"


def brute(rows):
    kept = [(i, lab, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v, lab in rows if lab is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    kept = [(i, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab, x) for i, lab, x in kept]
    out = []
    for at, (i, lab, x) in enumerate(kept):
        if i is None or i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(x, y)), math.inf if j is None else j, m == lab) for k, (j, m, y) in enumerate(kept) if k != at]
        for p, pid, _ in sorted(s for s in scored if s[2])[:5]:
            fits = sorted(s for s in scored if not s[2] and 30 * -p <= 100 * -s[0] <= 90 * -p)[:10]
            out += [(i, pid, r + 1, nid, -p, -n) for r, (n, nid, _) in enumerate(fits)]
    return sorted(out)


def check(spark, rows):
    docs = spark.createDataFrame([(i, v, lab, 1, "x", 2, "s", 3) for i, v, lab in rows], SCHEMA).repartition(3)
    got = negatives.mine(docs, relabel=True).collect()
    assert sorted(tuple(math.inf if c is None else c for c in r) for r in got) == brute(rows)
    return got


@pytest.mark.parametrize("shard_rows, seed_share, batch", [(1 << 15, 32, 128), (40, 4, 3)])
def test_against_brute_force(llm, monkeypatch, shard_rows, seed_share, batch):
    monkeypatch.setattr(negatives, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(negatives, "SEED_SHARE", seed_share)
    monkeypatch.setattr(negatives, "BATCH", batch)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 20))
    rows = []
    for n in range(500):
        lab = int(rng.integers(0, 4))
        v = centres[lab] * rng.uniform(0, 0.6) + rng.normal(size=20) * 0.3
        rows.append((n * 7 if n % 3 else n * 25, [float(c) for c in v], lab))
    same = rows[4][1]
    rows += [(5000 + n, same, 1) for n in range(120)] + [(100, same, 2), (100, same, 2), (None, same, 2), (None, same, None)]  # ties and repeats
    rows += [(9000, None, 1), (9100, [None] * 20, 1), (9200, [float("nan"), *[1.0] * 19], 2), (9300, [float("-inf")] * 20, 3), (9400, [], 1), (9500, [0.0] * 20, 2), (9600, [-c for c in same], 77)]
    rows += [(-700, same[:12], 3), (0, [0.001] * 20, 0)]
    assert len(check(llm, rows)) > 500


@pytest.mark.parametrize("rows", [
    [], [(100, [1.0], None)], [(100, [1.0, 2.0], 1)], [(100, [1.0], 1), (200, [0.5], 1), (201, [0.6], 2)],
    [(100, [0.0], 1), (101, [1.0], 1), (102, [3.0], 2)], [(100, [1.0], 1), (101, [-1.0], 1), (102, [-0.5], 2)],
    [(100, [3e9, 1.0], 1), (101, [2e2, 1.0], 1), (102, [1e2, 1.0], 2), (103, [1e2, 1.5], 3)],
])
def test_small_tables(llm, rows):
    """Empty, too few, scores of zero and below, scores that floating point can't tell apart."""
    check(llm, rows)


def test_index_leaves_out_and_drops(monkeypatch):
    """The join at a threshold gives what a product gives, at any threshold."""
    rng = np.random.default_rng(8)
    x = rng.integers(-50, 50, (300, 40)) * (rng.random((300, 1)) ** 3 * 4).astype(int)
    index = negatives.Index(x, rng.permutation(40))
    anchors = index.exact[:17]
    allowed = rng.random((17, 300)) < 0.7
    scores = x[:17] @ x.T
    for share in (0.9, 0.5, 0.1, 0.0, -1.0):
        least = scores.max(axis=1) * share
        pair, row, score = index.join(anchors, least, allowed)
        want = allowed & (scores >= least[:, None])
        assert sorted(zip(pair, row)) == sorted(zip(*np.nonzero(want))) and (score == scores[pair, row]).all()
