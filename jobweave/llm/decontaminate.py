"""Benchmark decontamination: passages of test items found in training texts.

Words are lower-cased (A-Z) runs of ASCII letters, digits and all other non-ASCII characters.
An item's windows are its runs of 13 words; an item of fewer words is one window.  A document
word inside any occurrence of any window is hit.

Every window has an anchor: three words in a row of it (fewer, if it is shorter) that are
longest in characters, so that few other places of a corpus have them.  The hash set of the
anchors is broadcast while the benchmark is small, which is checked; beyond that the same join
runs as an equi-join over a shuffle.  Each document is scanned once: its word triples probe the
set, and where one is found the whole window is compared, word by word, before the row leaves
the scan.  Only true hits are shuffled.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import cut_lineage

WINDOW = 13
ANCHOR = 3
#: Largest set of windows, in bytes of their words, that is broadcast.
BROADCAST_BYTES = 64 << 20
#: A document is contaminated if hits make up at least one word in so many.
SHARE = 20

# Everything that parts words, once A-Z are lower case.
_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text; a null text has none."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(low, _APART), lambda w: w != "")


def windows_of(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(w1, w2, w3, offset, length, words, item_id) of each item's windows.

    ``w1``-``w3`` are the anchor, null where the window is shorter, and ``offset`` its place in
    the window.  Equal windows of an item are one row.
    """
    own = items.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("all")).where(F.size("all") > 0)
    length = F.least(F.size("all"), F.lit(WINDOW))
    own = own.select("item_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("all") - length + 1), lambda i: F.slice("all", i, length))).alias("words"))
    own = own.distinct().withColumn("length", F.size("words"))
    places = F.sequence(F.lit(1), F.greatest(F.col("length") - ANCHOR + 1, F.lit(1)))
    weighed = F.transform(places, lambda i: F.struct(F.length(F.concat_ws("", F.slice("words", i, ANCHOR))).alias("chars"), (-i).alias("back")))
    own = own.withColumn("offset", -F.array_max(weighed)["back"] - 1)
    return own.select(*(F.get("words", F.col("offset") + i).alias(f"w{i + 1}") for i in range(ANCHOR)), "offset", "length", "words", "item_id")


def hits(docs: DataFrame, items: DataFrame, key: list[str], words: Column, windows: DataFrame | None = None) -> DataFrame:
    """(key…, start, length, item_id) of every occurrence of an item's window.

    ``words``: the documents' words, an expression over ``docs``; ``start`` counts from 0.
    """
    found = windows if windows is not None else cut_lineage(windows_of(items), "windows")
    size = found.agg(F.count("*").alias("n"), F.sum(F.length(F.concat_ws(" ", "words")) + 100).alias("bytes"), F.min("length").alias("shortest")).first()
    sized = F.broadcast if (size["bytes"] or 0) <= BROADCAST_BYTES else lambda x: x
    wide = docs.select(*key, words.alias("doc_words"))
    out = None
    for n in range(1, ANCHOR + 1):
        # only a benchmark with items of one or two words needs the scans for them
        if n < ANCHOR and not (size["shortest"] is not None and size["shortest"] < ANCHOR):
            continue
        zipped = F.arrays_zip(*(F.slice("doc_words", i + 1, F.greatest(F.size("doc_words") - n + 1, F.lit(0))).alias(f"p{i}") for i in range(n)))
        scan = wide.select(*key, "doc_words", F.posexplode(zipped).alias("at", "gram"))
        own = found.where(F.col("length") == n if n < ANCHOR else F.col("length") >= n)
        same = [F.col("gram")[f"p{i}"] == F.col(f"w{i + 1}") for i in range(n)]
        joined = scan.join(sized(own), same)
        start = F.col("at") - F.col("offset")
        whole = joined.where((start >= 0) & (F.slice("doc_words", F.greatest(start, F.lit(0)) + 1, F.col("length")) == F.col("words")))
        part = whole.select(*key, start.alias("start"), "length", "item_id")
        out = part if out is None else out.union(part)
    return out


def covered(spans: Column) -> Column:
    """Words covered by an array of (start, length), overlaps once."""
    state = F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, span: Column) -> Column:
        end = (span["start"] + span["length"]).cast("long")
        return F.struct(
            F.greatest(acc["to"], end).alias("to"),
            (acc["n"] + F.greatest(end - F.greatest(acc["to"], span["start"].cast("long")), F.lit(0).cast("long"))).alias("n"),
        )

    return F.aggregate(F.array_sort(spans), state, step, lambda acc: acc["n"])


# Separators in a text as it came, so that words can be counted without lower-casing it.
_APART_RAW = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def word_count(text: Column) -> Column:
    """How many words a text has: its pieces between separators, less empty ends."""
    cut = F.split(F.coalesce(text, F.lit("")), _APART_RAW)
    ends = (F.element_at(cut, 1) == "").cast("int") + ((F.size(cut) > 1) & (F.element_at(cut, -1) == "")).cast("int")
    return (F.size(cut) - ends).cast("long")


def text_key(text: Column) -> Column:
    """Equal texts have equal results, so hits are kept by text: its MD5, as bytes."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def judge(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, n_items, items, contaminated) of every row of ``docs``.

    ``items``: ids of the items with occurring windows, as sorted strings; items without an id
    are found but not listed.  A null or empty text has no words and isn't contaminated; an
    empty benchmark finds nothing.  Repeated rows stay, each with its own result.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    keyed = slim.select(text_key(F.col("text")).alias("text_key"), "text")
    found = hits(keyed, items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")), ["text_key"], words_of(F.col("text")))
    by_text = found.groupBy("text_key").agg(
        F.collect_set(F.struct("start", "length")).alias("spans"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    by_text = by_text.select("text_key", covered(F.col("spans")).alias("n_hit"), "items")
    every = slim.select("doc_id", text_key(F.col("text")).alias("text_key"), word_count(F.col("text")).alias("n_words"))
    out = every.join(by_text, "text_key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), listed.alias("items"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, as they came."""
    judged = judge(docs, items, doc_id, text, item_id, item_text)
    bad = judged.where("contaminated").select(F.col("text_key").alias("_bad_text")).distinct()
    return docs.join(bad, text_key(docs[text]) == F.col("_bad_text"), "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with every hit word taken out of its text, its separator with it.

    Texts without hits, and null texts, stay as they are.  A text with hits is put together from
    its other words, each with the separators that follow it in the text.
    """
    keyed = docs.select(text_key(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    found = hits(keyed, items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")), ["text_key"], words_of(F.col("text")))
    spans = found.groupBy(F.col("text_key").alias("_hit_text")).agg(F.collect_set(F.struct("start", "length")).alias("_spans"))
    joined = docs.join(spans, text_key(docs[text]) == F.col("_hit_text"), "left")
    unit = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+" + _APART_RAW[:-1] + "*"
    units = F.regexp_extract_all(F.col(text), F.lit(unit), F.lit(0))
    inside = lambda i: F.exists("_spans", lambda s: (i >= s["start"]) & (i < s["start"] + s["length"]))
    lead = F.regexp_extract(F.col(text), "^" + _APART_RAW[:-1] + "*", 0)
    kept = F.concat(lead, F.concat_ws("", F.filter(units, lambda u, i: ~inside(i))))
    cleaned = F.when(F.col("_spans").isNull(), F.col(text)).otherwise(kept)
    return joined.withColumn(text, cleaned).select(*docs.columns)
