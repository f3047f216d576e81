"""Hard negatives by threshold joins over an inverted index with norm bounds.

Vectors become whole numbers and scores are their inner products, all exact.  Rows are dealt into
shards.  A shard's index holds the numbers in blocks of dimensions, those with the most energy
first, each block with the list of rows for which it matters: at threshold t a row leaves out
the last dimensions once their norm times the largest norm of the anchors' is below t, since they
alone can't reach it.  A join adds partial scores block by block.  It drops rows that reach no
anchor's threshold even with all that remains, by the norms of the remaining dimensions, and
computes the scores of the pairs that are left in full.

In the first shards, about one in SEED_SHARE, an anchor's threshold begins high and is lowered
until its *window* has filled: its k best rows of the same label for positives, k rows between
two bounds of other labels for negatives of each positive.  The k-th score found there is the
threshold for all other shards, because the whole corpus holds these rows too.
Every anchor meets every shard, in batches, and a shard gives at most k rows for a window; the
best of all shards are chosen by a window function over (anchor, positive), whose rows are few.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobweave.llm.common import cut_lineage, rows_of

SCALE = 256
ANCHOR_EVERY = 100
POSITIVES, NEGATIVES = 5, 10
#: A negative's score, in hundredths of the positive's.
LOWEST, HIGHEST = 30, 90
SHARD_ROWS = 1 << 15
SEED_SHARE = 32
#: Anchors that meet a shard at once, and dimensions in a block of the index.
BATCH = 128
BLOCK = 8
#: What a threshold is lowered to, as a share of the distance to where it may stop.
STEP = 0.75
#: Whole numbers up to this are exact in floating point.
_EXACT = 2**53


def prepared(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(row, vec_id, label, x) of the rows that take part, written to the shared folder.

    Rows with a null label, a null vector or a null or non-finite number don't.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    broken = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = F.col(f"`{label}`").isNotNull() & ~F.coalesce(broken, F.lit(True))
    x = F.transform(v, lambda c: F.floor(c * SCALE).cast("long"))
    rows = df.where(usable).select(F.monotonically_increasing_id().alias("row"), F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"), x.alias("x"))
    return cut_lineage(rows, "vectors")


def relabelled(vec_id: str = "vec_id", label: str = "label") -> F.Column:
    """The label, moved to the next of ten where seven divides the id."""
    return F.when(F.coalesce(F.col(vec_id) % 7 == 0, F.lit(False)), (F.col(label) + 1) % 10).otherwise(F.col(label))


class Index:
    """A shard's vectors by blocks of dimensions, with the norms of what remains after each."""

    def __init__(self, x: np.ndarray, order: np.ndarray) -> None:
        self.exact = x[:, order]
        self.edges = [*range(0, x.shape[1], BLOCK), x.shape[1]]
        self.blocks = [self.exact[:, s:e].astype(float) for s, e in zip(self.edges, self.edges[1:])]
        self.rest = self.remaining(self.exact.astype(float))

    def remaining(self, x: np.ndarray) -> np.ndarray:
        """Norms of the dimensions from each edge on, one row for each edge."""
        squares = np.zeros((len(self.edges), len(x)))
        for i in range(len(self.edges) - 2, -1, -1):
            part = x[:, self.edges[i] : self.edges[i + 1]]
            squares[i] = squares[i + 1] + (part * part).sum(axis=1)
        return np.sqrt(squares) * (1 + 1e-9)

    def scores(self, anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact scores of pairs, as 64-bit numbers."""
        x = self.exact[rows]
        if float(np.abs(anchors).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] < _EXACT:
            return np.einsum("pd,pd->p", anchors.astype(float), x.astype(float)).astype(np.int64)
        whole = (anchors.astype(object) * x.astype(object)).sum(axis=1)
        return np.array([min(max(v, -(2**63)), 2**63 - 1) for v in whole], dtype=np.int64)

    def join(self, anchors: np.ndarray, least: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of the allowed pairs that reach the anchor's threshold, by anchor."""
        a = anchors.astype(float)
        rest = self.remaining(a)
        # float sums of whole numbers may be off by this much
        bar = least - 1 - 1e-9 * rest[0] * self.rest[0].max(initial=0)
        lowest, rows, pairs = bar.min(initial=np.inf), np.flatnonzero(allowed.any(axis=0)), []
        partial = np.zeros((len(a), len(rows)))

        def reach(i: int, some: np.ndarray, sums: np.ndarray) -> np.ndarray:
            """Pairs that reach their thresholds if the dimensions from edge ``i`` on are alike."""
            return (sums + np.outer(rest[i], self.rest[i][some]) >= bar[:, None]) & allowed[:, some]

        def close(i: int, some: np.ndarray, sums: np.ndarray) -> None:
            at, row = np.nonzero(reach(i, some, sums))
            pairs.append((at, some[row]))

        for i, block in enumerate(self.blocks):
            # rows for which the dimensions from here on can make a score by themselves are in this block's list
            listed = self.rest[i][rows] * rest[i].max(initial=0) >= lowest
            if not listed.all():
                close(i, rows[~listed], partial[:, ~listed])
                rows, partial = rows[listed], partial[:, listed]
            if not len(rows):
                break
            partial += a[:, self.edges[i] : self.edges[i + 1]] @ (block if len(rows) == len(block) else block[rows]).T
            if rest[i + 1].mean() * self.rest[i + 1][rows].mean() < bar.mean():  # else norms hardly drop any row
                open_ = reach(i + 1, rows, partial).any(axis=0)
                if open_.mean() < 0.7:
                    rows, partial = rows[open_], partial[:, open_]
        close(len(self.blocks), rows, partial)
        at, row = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
        by_anchor = np.argsort(at, kind="stable")
        at, row = at[by_anchor], row[by_anchor]
        parts = [self.scores(anchors[at[s : s + (1 << 16)]], row[s : s + (1 << 16)]) for s in range(0, len(at), 1 << 16)]
        score = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
        found = score >= least[at]
        return at[found], row[found], score[found]


def descend(index: Index, anchors: np.ndarray, start: np.ndarray, stop: np.ndarray, allowed: np.ndarray, windows) -> list[tuple]:
    """Threshold joins at falling thresholds.

    ``windows(anchor, rows, scores)`` gives (filled, picked) of what an anchor has found;
    an anchor is done once its windows have filled or its threshold has come down to ``stop``.
    """
    done: list[tuple] = []
    stop = stop - 1e-12 * np.abs(stop)  # large bounds are rounded; windows are told apart exactly
    span = np.maximum(start - stop, 0)
    todo = np.arange(len(stop))
    while len(todo):
        at_end = span[todo] < 1
        least = np.where(at_end, stop[todo], stop[todo] + span[todo])
        pair, row, score = index.join(anchors[todo], least, allowed[todo])
        edges = np.searchsorted(pair, np.arange(len(todo) + 1))
        left = []
        for i, anchor in enumerate(todo):
            some = slice(edges[i], edges[i + 1])
            filled, picked = windows(anchor, row[some], score[some])
            if filled or at_end[i]:
                done += [(anchor, *p) for p in picked]
            else:
                left.append(anchor)
        todo = np.array(left, dtype=np.int64)
        span[todo] = np.where(span[todo] < 64, 0, span[todo] * STEP - 32)
    return done


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == d).all():
        return flat.reshape(-1, d)
    out = np.zeros((len(sizes), d), dtype=np.int64)
    out[np.arange(d)[None, :] < sizes[:, None]] = flat
    return out


def _best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(row, score) of the k best: highest scores, then smallest ids."""
    order = np.lexsort((rows, ids[rows], ~scores))[:k]
    return [(int(rows[j]), int(scores[j])) for j in order]


def _shard(d: int, order: np.ndarray, mining: bool):
    """The work of a task: each shard's rows, then the anchors in batches."""
    names = ["anchor", "positive", "row", "score"]
    k = NEGATIVES if mining else POSITIVES

    def search(index: Index, held: dict[str, np.ndarray], batch: list[dict]) -> list[tuple]:
        anchors = np.array([b["x"] for b in batch])[:, order]
        same = np.array([b["label"] for b in batch])[:, None] == held["label"][None, :]
        other = np.array([b["anchor"] for b in batch])[:, None] != held["row"][None, :]
        most = np.outer(index.remaining(anchors.astype(float))[0], index.rest[0]).max(axis=1, initial=0)
        if mining:
            ranges = [b["windows"] for b in batch]  # (positive, low, high), never empty
            stop = np.array([float(min(w["low"] for w in r)) for r in ranges])
            start = np.minimum(most, [float(max(w["high"] for w in r)) for r in ranges])
            start = np.where([b["seeded"] for b in batch], stop, start)

            def windows(anchor, rows, scores):
                filled, picked = True, []
                for w in ranges[anchor]:
                    inside = np.flatnonzero((scores >= w["low"]) & (scores <= w["high"]))
                    filled &= len(inside) >= k
                    picked += [(w["positive"], *p) for p in _best(rows[inside], scores[inside], held["id"], k)]
                return filled, picked

            return descend(index, anchors, start, np.minimum(stop, start), ~same & other, windows)
        stop = np.array([-m if b["low"] is None else b["low"] for m, b in zip(most, batch)])
        found = lambda _, rows, scores: (len(rows) >= k, [(-1, *p) for p in _best(rows, scores, held["id"], k)])
        start = np.where([b["seeded"] for b in batch], stop, np.maximum(most, stop))
        return descend(index, anchors, start, stop, same & other, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, waiting, held, index = None, [], [], {}, None

        def answers() -> Iterator[pa.RecordBatch]:
            nonlocal index, held
            if parts and waiting:
                if index is None:
                    held = {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}
                    index = Index(held.pop("x"), order)
                found = search(index, held, waiting)
                rows = np.array([f[2] for f in found], dtype=np.int64)
                columns = [[waiting[f[0]]["anchor"] for f in found], [f[1] for f in found], held["row"][rows], [f[3] for f in found]]
                ids = pa.array(held["id"][rows], pa.int64(), mask=held["no_id"][rows])
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), ids], [*names, "vec_id"])
            waiting.clear()

        for batch in rows_of(batches):
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            shards = column["shard"].to_numpy()
            asks = column["anchor"].is_valid().to_numpy(zero_copy_only=False)
            x = _matrix(column["x"], d)
            edges = [0, *(np.flatnonzero((np.diff(shards) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1), len(shards)]
            for at, end in zip(edges, edges[1:]):
                if shards[at] != shard:
                    yield from answers()
                    shard, index = shards[at], None
                    parts.clear()
                some = {name: c.slice(at, end - at) for name, c in column.items()}
                if not asks[at]:
                    ids = some["vec_id"]
                    parts.append({
                        "row": some["row"].to_numpy(), "label": some["label"].to_numpy(), "x": x[at:end],
                        "id": ids.fill_null(2**63 - 1).to_numpy(), "no_id": ids.is_null().to_numpy(zero_copy_only=False),
                    })
                    continue
                fields = [some[c].to_pylist() for c in ("anchor", "label", "seeded", "low", "windows")]
                for i, (anchor, label, seeded, low, windows) in enumerate(zip(*fields)):
                    waiting.append({"anchor": anchor, "label": label, "seeded": seeded, "low": low, "windows": windows, "x": x[at + i]})
                    if len(waiting) >= BATCH:
                        yield from answers()
        yield from answers()

    return run


_FOUND = "anchor long, positive long, row long, score long, vec_id long"


def _join(rows: DataFrame, anchors: DataFrame, shards: int, first: int, end: int, d: int, order: np.ndarray, mining: bool) -> DataFrame:
    """What the shards from ``first`` to before ``end`` find for the anchors."""
    extra = {"anchor": "long", "seeded": "boolean", "low": "double", "windows": "array<struct<positive: long, low: long, high: long>>"}
    shard = F.expr(f"int(pmod(xxhash64(row), {shards}))")
    here = rows.withColumn("shard", shard).where(F.col("shard").between(first, end - 1))
    here = here.select("shard", *[F.lit(None).cast(t).alias(c) for c, t in extra.items()], "row", "vec_id", "label", "x")
    # each anchor goes to each shard: the stated queries against all rows, in blocks
    asked = anchors.withColumn("seeded", F.lit(first > 0)).withColumn("shard", F.explode(F.sequence(F.lit(first), F.lit(end - 1)))).select(*here.columns)
    dealt = here.union(asked).repartitionById(end - first, F.col("shard") - first).sortWithinPartitions("shard", F.col("anchor").isNotNull())
    return dealt.mapInArrow(_shard(d, order, mining), _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each (anchor, positive), with their ranks."""
    best = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _searched(rows: DataFrame, anchors: DataFrame, shards: int, d: int, order: np.ndarray, mining: bool) -> DataFrame:
    """The best of all shards: seeds first, then the others from the thresholds that seeds give."""
    k = NEGATIVES if mining else POSITIVES
    seeds = max(1, shards // SEED_SHARE)
    found = cut_lineage(_ranked(_join(rows, anchors, shards, 0, seeds, d, order, mining), k).drop("rank"), "seeds")
    if seeds == shards:
        return found
    full = found.groupBy("anchor", "positive").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") >= k)
    if mining:
        each = anchors.select("anchor", F.explode("windows").alias("w")).select("anchor", "w.*")
        each = each.join(full.drop("n"), ["anchor", "positive"], "left")
        window = F.struct("positive", F.greatest("low", F.coalesce("least", "low")).alias("low"), "high")
        bounds = each.groupBy("anchor").agg(F.collect_list(window).alias("windows"))  # POSITIVES at most
        asked = anchors.drop("windows").join(bounds, "anchor")
    else:
        asked = anchors.drop("low").join(full.select("anchor", F.col("least").cast("double").alias("low")), "anchor", "left")
    rest = _join(rows, asked.select(*anchors.columns), shards, seeds, shards, d, order, mining)
    return _ranked(found.union(rest), k)


def mine(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", anchors: F.Column | None = None, relabel: bool = False) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows for which ``anchors`` holds (ids that ANCHOR_EVERY divides, unless
    given).  An anchor's positives are the POSITIVES best other rows of its label, and each
    positive's negatives the NEGATIVES best rows of other labels with a score between LOWEST and
    HIGHEST hundredths of the positive's.  Higher scores come first, ties by smaller id, null
    ids last.  With ``relabel``, labels first pass ``relabelled``.

    A row that another one repeats is a row of its own: it can be its copy's positive, and
    repeated anchors give repeated results.  Rows without label or with a broken vector take no
    part; a shorter vector counts as one that ends in zeros.  Scores are exact whole numbers; one
    beyond 64 bits counts as the nearest number that 64 bits hold.  Other columns are not read,
    and an empty table gives no rows.
    """
    if relabel:
        slim = df.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("v"), F.col(f"`{label}`").alias("label"))
        df, vec_id, vector, label = slim.withColumn("label", relabelled()), "vec_id", "v", "label"
    rows = prepared(df, vec_id, vector, label)
    n, d = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    d = max(d or 0, 1)
    spark = df.sparkSession
    shards = max(ceil(n / SHARD_ROWS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(n / 256)), 1)
    # dimensions with the most energy first
    energy = np.zeros(d)
    each = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast("double") * F.col("x")).alias("e"))
    for r in each.collect():  # a row for each dimension
        energy[r["at"]] = r["e"]
    order = np.argsort(-energy, kind="stable")

    chosen = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0 if anchors is None else anchors)
    chosen = chosen.select(F.col("row").alias("anchor"), F.lit(None).cast("double").alias("low"),
                           F.lit(None).cast("array<struct<positive: long, low: long, high: long>>").alias("windows"), "row", "vec_id", "label", "x")
    positives = cut_lineage(_searched(rows, chosen, shards, d, order, False).select("anchor", F.col("row").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # low: the least whole number n with 100 n >= LOWEST p, high: the greatest with 100 n <= HIGHEST p
    p = F.col("positive_score").cast("decimal(38,0)")
    low, high = F.ceil(p * LOWEST / 100).cast("long"), F.floor(p * HIGHEST / 100).cast("long")
    windows = positives.select("anchor", "positive", low.alias("low"), high.alias("high")).where("low <= high")
    asked = windows.groupBy("anchor").agg(F.collect_list(F.struct("positive", "low", "high")).alias("windows"))  # POSITIVES at most
    asked = cut_lineage(chosen.drop("windows").join(asked, "anchor").select(*chosen.columns), "windows")
    negatives = _ranked(_searched(rows, asked, shards, d, order, True).select("anchor", "positive", "row", "score", "vec_id"), NEGATIVES)
    ids = rows.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    out = negatives.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(positives, ["anchor", "positive"]).join(ids, "anchor")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
