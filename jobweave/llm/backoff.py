"""Language-model scores with stupid backoff over word pairs.

The score of a word after another is

    c(v w) / c(v)          if the pair occurs at least MIN_COUNT times in the corpus,
    BACKOFF * c(w) / N     otherwise,

and a document's score is the sum of the logarithms.  A document begins after an empty word.

All counts are taken over the whole corpus and of every word, however rare or long.  A word is
a number with the sign bit and 63 bits of its hash; of words that share a number, all but the
smallest are hashed again, under other seeds, until none do.  The VOCABULARY most frequent
words have ranks instead, by a table of fixed size that is broadcast; it saves work and changes
no result.

The pairs of the HOT most frequent words, which make up the frequent pairs, are counted and
scored where their rows are, by a broadcast table of at most (HOT + 2)^2 scores.  All other
pairs have a word that fewer than one in HOT places has, so no pair's rows are many; they are
dealt out once, a pair of ranked words by the pair, any other by a word without a rank, the
second if both are.  Each gets its pair's count where the pair's rows meet.  Since every word
comes after something, the rows dealt by their second word are as many as that word is
frequent, so its count is there too.  Only a repeated pair of two words without ranks needs
its first word's count from a table, joined by the word.
Sums per document are taken before the rows are dealt out by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobweave.llm.common import cut_lineage, split_words

#: Words with ranks.
VOCABULARY = 1 << 16
HOT = 512
MIN_COUNT = 2
BACKOFF = 0.4
#: Rank of the beginning; words have theirs from 2 on.
BEGIN = 1
_SHIFT = 20
#: Added to a rank that stands after a word without one.
_AFTER = 1 << 40


def words_of(text: Column) -> Column:
    """Words between ASCII white space, in lower case; a null text has none."""
    return split_words(F.lower(F.coalesce(text, F.lit(""))))


def begun(text: Column) -> Column:
    """The words after the empty one that a document begins with; nothing without words."""
    filled = F.ltrim(text, F.lit(" \t\n\x0b\x0c\r")) != ""
    return F.when(filled, F.concat(F.array(F.lit("")), words_of(text))).otherwise(F.array().cast("array<string>"))


def vocabulary(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) of every word and of the beginning (''), which is there with count 0 if nothing is."""
    words = docs.select(F.explode(begun(F.col(text))).alias("word"))
    counts = cut_lineage(words.groupBy("word").agg(F.count("*").alias("n")), "words")
    begin = counts.where("word = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return counts.where("word <> ''").union(docs.sparkSession.createDataFrame([("", begin)], "word string, n long"))


def word_id(word: Column, seeds: dict[str, int]) -> Column:
    """A negative number; ``seeds`` has the words that aren't hashed under seed 0."""
    seed = F.lit(0)
    for other in sorted(set(seeds.values())):
        seed = F.when(word.isin([w for w, s in seeds.items() if s == other]), other).otherwise(seed)
    return F.xxhash64(word, seed).bitwiseOR(F.lit(-(1 << 63)))


def numbered(vocab: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """(id, n, begin) of the words of ``vocab``, with ids that all differ, and the words with other seeds.

    The driver gets the words that share an id: of n words about n^2 / 2^64 pairs, ten among
    ten thousand million words.
    """
    seeds: dict[str, int] = {}
    while True:
        named = vocab.select("word", word_id(F.col("word"), seeds).alias("id"), "n")
        ids = cut_lineage(named.select("id", "n", (F.col("word") == "").alias("begin")), "ids")
        shared = ids.groupBy("id").count().where("count > 1").select("id")
        if shared.isEmpty():
            return ids, seeds
        first = named.join(shared, "id").groupBy("id").agg(F.min("word").alias("first"))
        for row in named.join(first, "id").where("word <> first").select("word").collect():
            seeds[row["word"]] = seeds.get(row["word"], 0) + 1


def pairs(docs: DataFrame, row: Column, text: str, seeds: dict[str, int]) -> DataFrame:
    """(row, v, w): the ids of every two words in a row, of every document with words."""
    base = docs.select(row.alias("row"), begun(F.col(text)).alias("w"))
    size = F.greatest(F.size("w") - 1, F.lit(0))
    zipped = F.arrays_zip(F.slice("w", 1, size).alias("v"), F.slice("w", 2, size).alias("w"))
    return base.select("row", F.explode(zipped).alias("p")).select("row", *[word_id(F.col(f"p.{c}"), seeds).alias(c) for c in ("v", "w")])


def _ranked(rows: DataFrame, ranks: DataFrame, how: str) -> DataFrame:
    for column, rank in (("v", "a"), ("w", "b")):
        rows = rows.join(F.broadcast(ranks.select(F.col("id").alias(column), F.col("rank").alias(rank))), column, how)
    return rows


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) of every row of ``docs``.

    Natural logarithms; ``mean_log_score`` is null for a document without words, whose sum is
    0.  Repeated rows stay and count as often as they are there.
    """
    vocab = vocabulary(docs, text)
    ids, seeds = numbered(vocab)
    n = ids.where("not begin").agg(F.sum("n")).first()[0] or 1
    top = ids.where("not begin").orderBy(F.desc("n"), "id").limit(VOCABULARY)
    rank = F.expr("row_number() over (order by n desc, id)") + 1
    begin = ids.where("begin").select("id", F.lit(BEGIN).cast("long").alias("rank"), "n")
    top = top.select("id", rank.cast("long").alias("rank"), "n").union(begin)
    top = cut_lineage(top, "top")

    # rows are told apart by what they hold, the same in every pass; equal ones share their sums
    row = F.xxhash64(F.col(doc_id), F.col(doc_id).isNull(), F.col(text))
    every = pairs(docs, row, text, seeds)
    is_hot = F.col("a").between(0, HOT + 1) & F.col("b").between(0, HOT + 1)
    read = _ranked(every, top, "left").select("row", F.coalesce("a", "v").alias("a"), F.coalesce("b", "w").alias("b"))
    hot = _ranked(every, top.where(F.col("rank") < HOT + 2), "inner")
    hot = cut_lineage(hot.select("row", F.col("a").cast("short").alias("a"), F.col("b").cast("short").alias("b")), "hot")
    sizes = F.broadcast(top.select(F.col("rank").alias("r"), F.log(F.greatest(F.col("n"), F.lit(1)).cast("double")).alias("log_n")))

    seen = F.col("c") >= MIN_COUNT
    own = F.when(seen, F.log(F.col("c").cast("double"))).otherwise(F.log(F.lit(BACKOFF / n)))
    side = F.when(seen, F.lit(-1.0)).otherwise(F.lit(1.0))
    first, second = F.shiftright("x", _SHIFT), F.col("x").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    pair = F.shiftleft(F.col("a").cast("long"), _SHIFT).bitwiseOR(F.col("b").cast("long"))

    hot_scores = hot.groupBy("a", "b").agg(F.count("*").alias("c")).select(pair.alias("x"), "c")
    hot_scores = hot_scores.withColumn("r", F.when(seen, first).otherwise(second)).join(sizes, "r")
    hot_scores = cut_lineage(hot_scores.select("x", (own + side * F.col("log_n")).alias("s")), "hot-scores")
    none = F.lit(None).cast("long").alias("need")
    hot_parts = hot.select("row", pair.alias("x")).join(F.broadcast(hot_scores), "x").select("row", none, "s")

    # x >= 0: two ranks; else y < _AFTER: y before x, and y >= _AFTER: the rank after x
    x = F.when(F.col("b") < 0, F.col("b")).when(F.col("a") < 0, F.col("a")).otherwise(pair)
    y = F.when(F.col("b") < 0, F.col("a")).when(F.col("a") < 0, F.col("b") + _AFTER)
    dealt = read.where(~is_hot).select(x.alias("x"), y.alias("y"), "row").repartition("x").sortWithinPartitions("x", "y")
    before = F.col("y") < _AFTER
    counted = dealt.withColumn("c", F.count("*").over(W.partitionBy("x", "y"))).withColumn("n_x", F.count(F.when(before, 1)).over(W.partitionBy("x")))
    ranked = F.when(F.col("x") >= 0, F.when(seen, first).otherwise(second))
    ranked = ranked.when(before, F.when(seen & (F.col("y") >= 0), F.col("y"))).otherwise(F.when(~seen, F.col("y") - _AFTER))
    need = F.when((F.col("x") < 0) & (F.col("y") < 0) & seen, F.col("y"))
    met = F.when((F.col("x") < 0) & (before != seen), F.log(F.col("n_x").cast("double"))).otherwise(F.lit(0.0))
    scored = counted.select("row", need.alias("need"), ranked.alias("r"), side.alias("side"), (own + side * met).alias("s"))
    cold_parts = scored.join(sizes, "r", "left").select("row", "need", (F.col("s") + F.col("side") * F.coalesce("log_n", F.lit(0.0))).alias("s"))

    parts = cold_parts.union(hot_parts).groupBy("row", "need").agg(F.sum("s").alias("s"), F.count("*").alias("k"))
    parts = cut_lineage(parts, "parts")
    lacking = parts.where("need is not null").join(ids.where(f"n >= {MIN_COUNT}").select(F.col("id").alias("need"), "n"), "need")
    lacking = lacking.select("row", (F.col("s") - F.col("k") * F.log(F.col("n").cast("double"))).alias("s"), "k")
    sums = parts.where("need is null").select("row", "s", "k").union(lacking).groupBy("row").agg(F.sum("s").alias("s"), F.sum("k").alias("k"))
    rows = cut_lineage(docs.select(F.col(doc_id).alias("doc_id"), row.alias("row")), "rows")
    times = rows.groupBy("row").agg(F.count("*").alias("times"))
    each = sums.join(times, "row").select("row", (F.col("s") / F.col("times")).alias("s"), F.expr("k div times").alias("k"))
    done = rows.join(each, "row", "left")
    done = done.select("doc_id", F.coalesce("k", F.lit(0)).cast("long").alias("n_words"), F.coalesce("s", F.lit(0.0)).alias("log_score"))
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return done.select("doc_id", "n_words", "log_score", mean.alias("mean_log_score"))
