"""Quality scores by a factorisation machine.

A text's features are hashed words, hashed word ends, and statistics of its structure and size
in bins.  The score is the logistic of

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

with vectors v of a few numbers.  The pair sum is half of |sum_i v_i x_i|^2 minus the sum of
|v_i x_i|^2, so that it takes time linear in the features present.

The model is fitted on the driver from at most ``FIT_ROWS`` labelled rows, those with the
smallest hash of their id among the rows not held out; a bounded number of feature lists is all
that comes there.  Scoring runs in tasks over whole texts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import binary_column, held_out, rows_of

FIT_ROWS = 8000
WORD_BUCKETS = 1 << 12
END_BUCKETS = 1 << 9
RANK = 8
EPOCHS = 20
THRESHOLD = 0.3

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = b"0123456789"
_SPACES = b" \t\n\r\x0b\x0c"
_SYMBOLS = bytes(c for c in range(33, 127) if c not in _LETTERS + _DIGITS + b".,'\"-")
#: Bins of each statistic begin at these values.
_SHARES = np.array([0.002, 0.01, 0.03, 0.06, 0.1, 0.15, 0.22, 0.3, 0.4, 0.55, 0.7, 0.85])
_LENGTHS = np.array([1, 5, 15, 40, 80, 150, 300, 600, 1200, 3000, 8000, 20000])
_WORD_SIZES = np.array([2, 3, 3.5, 4, 4.5, 5, 5.5, 6, 7, 8, 10, 14])
_EDGES = [_LENGTHS, _LENGTHS, _WORD_SIZES] + [_SHARES] * 9
_BINS = 13
STATS = len(_EDGES)
FEATURES = WORD_BUCKETS + END_BUCKETS + STATS * _BINS


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def features(text: bytes) -> tuple[list[int], np.ndarray]:
    """Numbers and values of the features that a text has."""
    words = text.split()
    counts = Counter(words)
    n, size = len(words), len(text)
    solid = len(text.translate(None, _SPACES))
    letters = size - len(text.translate(None, _LETTERS))
    lines = Counter(x for x in text.split(b"\n") if x.strip())
    n_lines = sum(lines.values())
    stats = [
        n, n_lines, _share(solid, n),
        _share(size - len(text.translate(None, _UPPER)), letters), _share(size - len(text.translate(None, _DIGITS)), solid),
        _share(size - len(text.translate(None, _SYMBOLS)), solid), _share(text.count(b"!"), n), _share(text.count(b"|"), n),
        _share(max(counts.values(), default=0), n), 1 - _share(len(counts), n), 1 - _share(len(lines), n_lines),
        _share(text.count(b".") + text.count(b","), n),
    ]
    low = {w.lower() for w in counts}
    buckets = {zlib.crc32(w) % WORD_BUCKETS for w in low}
    ends = Counter(zlib.crc32(w[-2:]) % END_BUCKETS for w in words)
    index = list(buckets)
    values = [1 / len(buckets) ** 0.5] * len(buckets) if buckets else []
    index += [WORD_BUCKETS + e for e in ends]
    values += [(c / n) ** 0.5 for c in ends.values()]
    base = WORD_BUCKETS + END_BUCKETS
    index += [base + i * _BINS + int(np.searchsorted(e, x, "right")) for i, (e, x) in enumerate(zip(_EDGES, stats))]
    values += [STATS**-0.5] * STATS
    return index, np.array(values, dtype=np.float32)


@dataclass
class Machine:
    """Weights of a factorisation machine."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, index: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log odds of rows whose features lie one after the other; each row has some."""
        part = self.factors[index] * values[:, None]
        sums = np.add.reduceat(part, starts, axis=0)
        squares = np.add.reduceat((part * part).sum(axis=1), starts)
        return self.bias + np.add.reduceat(self.linear[index] * values, starts) + 0.5 * ((sums * sums).sum(axis=1) - squares)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Logistic loss, small steps with running means of the gradients; deterministic."""
    rng = np.random.default_rng(seed)
    factors = rng.normal(0, 0.05, (FEATURES, RANK)).astype(np.float32)
    if not len(rows):
        return Machine(0.0, np.zeros(FEATURES, np.float32), np.zeros_like(factors))
    rate = np.clip(labels.mean(), 0.01, 0.99)
    theta = np.concatenate([np.zeros((FEATURES, 1), np.float32), factors], axis=1)
    bias, first, second, step = float(np.log(rate / (1 - rate))), np.zeros_like(theta), np.zeros_like(theta), 0
    for epoch in range(epochs):
        pace = 0.05 * (1 - epoch / epochs) + 0.002
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 128):
            some = order[at : at + 128]
            x = np.zeros((len(some), FEATURES), np.float32)
            for r, i in enumerate(some):
                x[r, rows[i][0]] = rows[i][1]
            v = theta[:, 1:]
            sums = x @ v
            out = bias + x @ theta[:, 0] + 0.5 * ((sums * sums).sum(axis=1) - (x * x) @ (v * v).sum(axis=1))
            error = ((sigmoid(out) - labels[some]) / len(some)).astype(np.float32)
            scaled = x * error[:, None]
            grad = np.concatenate([scaled.sum(axis=0)[:, None], scaled.T @ sums - v * (scaled * x).sum(axis=0)[:, None]], axis=1)
            grad += 1e-5 * theta
            step += 1
            first += 0.1 * (grad - first)
            second += 0.01 * (grad * grad - second)
            theta -= pace * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
            bias -= pace * float(error.sum())
    return Machine(bias, theta[:, 0].copy(), theta[:, 1:].copy())


def labelled_sample(labels: DataFrame, doc_id: str, label: str, limit: int) -> DataFrame:
    """(_id, _label) of at most ``limit`` labelled rows that aren't held out, one per id."""
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(doc_id)))
    known = known.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
    return known.orderBy(F.xxhash64("_id"), "_id").limit(limit)


def one_per_id(rows: DataFrame) -> DataFrame:
    """(_id, _label, text): of rows that share an id, the one whose text has the smallest hash."""
    text = F.coalesce("text", F.lit(""))
    least = F.min(F.struct(F.xxhash64(text).alias("h"), text.alias("text")))
    return rows.groupBy("_id", "_label").agg(least.alias("t")).select("_id", "_label", "t.text")


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_of(batches):
        made = [features(t) for t in binary_column(batch, "text")]
        index = pa.array([np.array(i, dtype="<u2").tobytes() for i, _ in made], pa.binary())
        values = pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), index, values], ["_id", "_label", "index", "vals"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", limit: int = FIT_ROWS) -> Machine:
    """A machine for P(label = 1), from labelled rows that aren't held out.

    The sample's ids, at most ``limit``, are broadcast to the scan of the texts.  Of rows of
    ``docs`` that share an id, the one whose text has the smallest hash counts.  Without
    labelled rows every score is 0.5.
    """
    sample = F.broadcast(labelled_sample(labels, doc_id, label, limit))
    rows = one_per_id(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(sample, "_id"))
    schema = rows.select("_id", "_label").schema.add("index", "binary").add("vals", "binary")
    taken = sorted(rows.mapInArrow(_feature_rows, schema).collect(), key=lambda r: (str(r["_id"]), r["vals"], r["index"]))
    lists = [(np.frombuffer(r["index"], "<u2").astype(np.int64), np.frombuffer(r["vals"], "<f4")) for r in taken]
    return train(lists, np.array([r["_label"] for r in taken], dtype=np.float32))


def _scores(machine: Machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            texts = binary_column(batch, "_read_text")
            scores = []
            for at in range(0, len(texts), 200):
                made = [features(t) for t in texts[at : at + 200]]
                starts = np.cumsum([0, *(len(i) for i, _ in made)])[:-1]
                index = np.concatenate([np.array(i, dtype=np.int64) for i, _ in made])
                scores.append(sigmoid(machine.raw(index, np.concatenate([v for _, v in made]), starts).astype(np.float64)))
            names = [n for n in batch.schema.names if n != "_read_text"]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(scores))], [*names, "_score"])

    return run


def with_score(docs: DataFrame, machine: Machine, name: str = "score", text: str = "text") -> DataFrame:
    """``docs`` and a column ``name`` in place of any such column: P(label = 1), for null and
    empty texts too (their statistics are zeros).  Rows are scored one by one, whole, however
    long, and repeated ones alike."""
    kept = [c for c in docs.columns if c != name]
    schema = docs.select(*kept).schema.add("_score", "double")
    scored = docs.select(*kept, F.col(text).alias("_read_text")).mapInArrow(_scores(machine), schema)
    return scored.withColumnRenamed("_score", name)


def keep_good(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, as they came."""
    return with_score(docs, machine, "_quality", text).where(F.col("_quality") >= threshold).drop("_quality")
