"""Toxicity by a weighted lexicon.

A text is lower-cased, letters that look like Latin ones are folded into them, and digits and
signs that stand for letters inside words too.  Its words, each after a blank, are searched for
all terms of the lexicon at once with an Aho-Corasick automaton.  A term matches the words that
begin with it; with a ``+`` at its end, only those that are longer.  Hits inside an exception
phrase don't count.  The weights of the hits, by themselves and per 100 words, give the score
through a fitted logistic curve.

Terms, weights and exceptions all come from labelled texts that aren't held out, at most
``FIT_ROWS`` of them; no list is built in.  A user's own list can be given as candidates, which
the labelled texts weigh, or drop.  Texts that share their smallest shingle hash count once, so
that copies don't vote for the chance words they share.  A term's weight is the logarithm of
how much more frequent it is in toxic texts than in others.  Terms that many toxic texts and
hardly any others have are all taken; of the rest only those that explain toxic texts which no
other term explains.  An exception is a term's word with a neighbour that only other texts have.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobweave.llm.common import held_out, rows_of
from jobweave.llm.quality import labelled_sample, one_per_id, sigmoid

FIT_ROWS = 16000
THRESHOLD = 0.5
#: Lengths of the beginnings of words that can become terms; whole words up to LONGEST too.
SHORTEST, LONGEST = 3, 12
#: A term needs so many different toxic texts at least, or so much of all of them.
MIN_TEXTS, MIN_SHARE = 4, 0.004
#: And so much of the texts that have it must be toxic.
MIN_PRECISION = 0.4
MAX_TERMS = 2000

#: Terms with so many toxic texts, and so much of their texts toxic, are taken in any case.
SURE_TEXTS, SURE_PRECISION = 8, 0.9

# Letters of other alphabets that look like Latin ones, and what they look like.
_LOOKS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ω": "w", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g",
}
_FOLD = {ord(k): v for k, v in _LOOKS.items()}
_FOLD |= {c: unicodedata.normalize("NFKC", chr(c)).lower() for c in range(0xFF10, 0xFF5B) if unicodedata.normalize("NFKC", chr(c)).isalnum()}
_FOREIGN = re.compile("[ıɑɡͰ-ԯ０-ｚ]")
_DIGITS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"})
_MIXED = re.compile(r"(?:[^\W\d_]+[0134578@$]+|[0134578@$]+(?=[^\W\d_]))(?:[^\W_]|[@$])*")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """The words of a text as the automaton reads them, each after a blank."""
    low = text.lower()
    if not low.isascii() and _FOREIGN.search(low):
        low = low.translate(_FOLD)
    words = _WORD.findall(low)
    folded = " " + " ".join(words) + " "
    if any(c in low for c in "0134578@$"):
        # read again with signs for letters; what is new goes behind
        again = [m.translate(_DIGITS) for m in _MIXED.findall(low)]
        if again:
            folded += " ".join(" ".join(_WORD.findall(w)) for w in again) + " "
    return folded


@dataclass
class Lexicon:
    """Terms with weights, exception phrases, and the curve from hits to a score."""

    terms: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, ...] = (-4.0, 2.0, 1.0, 3.0)
    _automaton: object = field(default=None, repr=False, compare=False)

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            found = ahocorasick.Automaton()
            both: dict[str, list[float]] = {}  # weights where the word may end and where it goes on
            for term, weight in self.terms.items():
                either = both.setdefault(term.removesuffix("+"), [0.0, 0.0])
                for at in (1,) if term.endswith("+") else (0, 1):
                    either[at] = max(either[at], weight)
            for term, weights in both.items():
                found.add_word(" " + term, (len(term) + 1, weights))
            for phrase in self.exceptions:
                found.add_word(" " + phrase + " ", (len(phrase) + 2, None))
            found.add_word("\x00", (1, [0.0, 0.0]))  # an automaton needs a word
            found.make_automaton()
            self._automaton = found
        return self._automaton

    def hits(self, folded: str) -> tuple[float, int]:
        """Summed weight and number of the hits."""
        found, allowed = [], []
        for end, (size, weights) in self.automaton().iter(folded):
            if weights is None:
                allowed.append((end - size + 1, end))
            elif weight := weights[folded[end + 1 : end + 2] not in ("", " ")]:
                found.append((end - size + 1, end, weight))
        if allowed:
            found = [h for h in found if not any(a <= h[0] and h[1] <= b for a, b in allowed)]
        best: dict[int, float] = {}
        for start, _, weight in found:  # of the terms that begin one word, the heaviest counts
            best[start] = max(weight, best.get(start, weight))
        return sum(best.values()), len(best)

    def inputs(self, text: str) -> tuple[float, float, float]:
        folded = fold(text)
        weight, n = self.hits(folded)
        words = max(1, folded.count(" ") - 1)
        return float(n > 0), float(np.log1p(weight)), float(np.log1p(100 * weight / words))

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.inputs(t) for t in texts], dtype=np.float64).reshape(-1, 3)
        return sigmoid(self.curve[0] + x @ np.array(self.curve[1:]))


def _texts(batch: pa.RecordBatch, name: str) -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def beginnings(words: set[str]) -> set[str]:
    """Every term that could match one of the words."""
    own = set()
    for w in words:
        for n in range(SHORTEST, min(LONGEST, len(w)) + 1):
            own.add(w[:n])
            if n < len(w):
                own.add(w[:n] + "+")
    return own


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_of(batches):
        signs, terms = [], []
        for text in _texts(batch, "text"):
            words = fold(text).split()
            raw = [w.encode() for w in words]
            signs.append(min((zlib.crc32(b" ".join(raw[i : i + 3])) for i in range(max(1, len(raw) - 2))), default=0))
            terms.append(sorted(beginnings(set(words))))
        columns = [batch.column(0), batch.column(1), pa.array(signs, pa.int64()), pa.array(terms, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["_id", "_label", "sign", "terms"])


def weight_of(toxic: int, other: int, n_toxic: int, n_other: int) -> float:
    """How much more frequent a term is in toxic texts, as a logarithm."""
    return float(np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1)))


def choose(candidates: dict[str, tuple[int, int]], have: dict[str, set[int]], least: int) -> list[str]:
    """Terms from candidates: term -> (toxic texts, other texts); have: term -> its toxic texts.

    Of terms for one word that equally many toxic texts have, the longest stands for all.  Sure
    ones are taken; then the term that explains most unexplained texts, again and again, until
    none explains ``least``.
    """
    stems: dict[str, tuple[int, int]] = {}
    by_start: dict[str, list[str]] = {}
    for term in sorted(candidates, key=lambda t: (-len(t.removesuffix("+")), t)):
        toxic, other = candidates[term]
        bare = term.removesuffix("+")
        longer = by_start.get(bare, [])
        if any(stems[t][0] >= 0.97 * toxic and stems[t][1] <= other for t in longer):
            continue
        stems[term] = (toxic, other)
        for n in range(SHORTEST, len(bare) + 1):
            by_start.setdefault(bare[:n], []).append(term)
    sure = [t for t, (toxic, other) in stems.items() if toxic >= max(SURE_TEXTS, 2 * least) and toxic >= SURE_PRECISION * (toxic + other)]
    chosen = sorted(sure, key=lambda t: (-stems[t][0], t))[:MAX_TERMS]
    explained = set().union(*(have[t] for t in chosen))
    open_ = {t: set(have[t]) - explained for t in stems if t not in set(chosen)}
    while open_ and len(chosen) < MAX_TERMS:
        best = max(open_, key=lambda t: (len(open_[t]) - 0.1 * stems[t][1], len(t), t))
        gain = set(open_.pop(best))
        if len(gain) < least:
            break
        chosen.append(best)
        for texts in open_.values():
            texts -= gain
    return chosen


def neighbours(lexicon: Lexicon, folded: str) -> set[str]:
    """The phrases of two words in which one is a hit."""
    words = folded.split()
    hit = [bool(lexicon.hits(f" {w} ")[1]) for w in words]
    return {f"{a} {b}" for a, b, x, y in zip(words, words[1:], hit, hit[1:]) if x or y}


def _phrase_rows(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            phrases = [sorted(neighbours(lexicon, fold(t))) for t in _texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(phrases, pa.list_(pa.string()))], ["_label", "phrases"])

    return run


def fit_curve(inputs: np.ndarray, labels: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps, with a small penalty."""
    x = np.concatenate([np.ones((len(inputs), 1)), inputs], axis=1)
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ beta)
        grad = x.T @ (p - labels) + 0.05 * beta
        beta -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(beta)), grad)
    return tuple(float(b) for b in beta)


def _input_rows(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            x = np.array([lexicon.inputs(t) for t in _texts(batch, "text")]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(x[:, i]) for i in range(3))], ["_label", "x0", "x1", "x2"])

    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", limit: int = FIT_ROWS,
        candidates: Iterable[str] = ()) -> Lexicon:
    """A lexicon from labelled rows that aren't held out, at most ``limit`` of them.

    Of rows that share an id the one whose text has the smallest hash counts; null texts are
    empty.  ``candidates`` are terms to weigh however few texts have them; those that are no
    more frequent in toxic texts are dropped.  Without labelled rows there are no terms, and
    every text scores alike and below the threshold.  The result is the same at every run.
    """
    sample = F.broadcast(labelled_sample(labels, doc_id, label, limit))
    rows = one_per_id(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(sample, "_id"))
    made = rows.mapInArrow(_term_rows, rows.select("_id", "_label").schema.add("sign", "long").add("terms", T.ArrayType(T.StringType())))
    # of texts that share their smallest shingle, the one with the smallest id
    made = made.groupBy("_label", "sign").agg(F.min(F.struct("_id", "terms")).alias("t")).select("_label", "sign", "t.terms").persist()
    given = {c.lower() for c in candidates}
    try:
        n = {r["_label"]: r["n"] for r in made.groupBy("_label").agg(F.count("*").alias("n")).collect()}
        n_toxic, n_other = n.get(1, 0), n.get(0, 0)
        terms: dict[str, float] = {}
        if n_toxic:
            least = max(MIN_TEXTS, int(MIN_SHARE * n_toxic))
            every = made.select("_label", "sign", F.explode("terms").alias("term"))
            counts = every.groupBy("term").agg(F.count_if(F.col("_label") == 1).alias("toxic"), F.count_if(F.col("_label") == 0).alias("other"))
            good = counts.where((F.col("toxic") >= least) & (F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + F.col("other"))))
            have = every.where("_label = 1").join(good, "term").groupBy("term", "toxic", "other").agg(F.collect_set("sign").alias("signs")).collect()
            found = {r["term"]: (r["toxic"], r["other"]) for r in have}
            chosen = choose(found, {r["term"]: set(r["signs"]) for r in have}, max(3, least // 2))
            if given:
                found |= {r["term"]: (r["toxic"], r["other"]) for r in counts.where(F.col("term").isin(sorted(given))).collect()}
            weights = {t: weight_of(*found[t], n_toxic, n_other) for t in [*chosen, *sorted(given & found.keys())]}
            terms = {t: w for t, w in weights.items() if w > 0}
    finally:
        made.unpersist()
    lexicon = Lexicon(terms)
    if terms:
        phrases = rows.mapInArrow(_phrase_rows(lexicon), "_label int, phrases array<string>").select("_label", F.explode("phrases").alias("p"))
        counts = phrases.groupBy("p").agg(F.count_if(F.col("_label") == 1).alias("toxic"), F.count_if(F.col("_label") == 0).alias("other"))
        harmless = counts.where((F.col("toxic") == 0) & (F.col("other") >= MIN_TEXTS)).orderBy(F.desc("other"), "p").limit(MAX_TERMS)
        lexicon = Lexicon(terms, tuple(sorted(r["p"] for r in harmless.collect())))
    seen = rows.mapInArrow(_input_rows(lexicon), "_label int, x0 double, x1 double, x2 double").toPandas()
    if len(seen):
        seen = seen.sort_values(list(seen.columns))
        lexicon.curve = fit_curve(seen[["x0", "x1", "x2"]].to_numpy(), seen["_label"].to_numpy())
    return lexicon


def _scores(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            names = [n for n in batch.schema.names if n != "_read_text"]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lexicon.score(_texts(batch, "_read_text")))], [*names, "_score"])

    return run


def with_score(docs: DataFrame, lexicon: Lexicon, name: str = "score", text: str = "text") -> DataFrame:
    """``docs`` and a column ``name``, in place of any such column: how likely the text is toxic.
    Null and empty texts have no hits.  Rows are scored one by one, whole, however long, and
    repeated ones alike."""
    lexicon._automaton = None  # built in the tasks
    kept = [c for c in docs.columns if c != name]
    schema = docs.select(*kept).schema.add("_score", "double")
    scored = docs.select(*kept, F.col(text).alias("_read_text")).mapInArrow(_scores(lexicon), schema)
    return scored.withColumnRenamed("_score", name)
