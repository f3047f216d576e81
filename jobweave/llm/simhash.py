"""Near-duplicates by SimHash fingerprints, with pivot distance tables.

A fingerprint has 64 bits.  The pivot table of a fingerprint holds its Hamming distances to
``PIVOTS`` reference fingerprints.  Distances obey the triangle inequality: two fingerprints
at most 3 bits apart differ by at most 3 in every coordinate of their tables.  Pairs are
discarded by the largest coordinate difference; the survivors are verified bit by bit.

Pivots alone would have every pair looked at: the distances of unrelated fingerprints to a
reference crowd around 32, and a coordinate keeps about six random pairs in ten.  So which
pairs meet at all is decided by references that cover one of five segments each.  At most 3
differing bits leave two of the five segments untouched, so a linked pair shares the
distances to all references of two segments, that is, those segments' bits: ten keys of 25 or
26 bits per distinct fingerprint, exact, joined by equality.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import binary_column, cut_lineage, rows_of
from jobweave.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 3
PIVOTS = 16
#: Bits of the five segments, from the lowest.
SEGMENTS = (13, 13, 13, 13, 12)
#: A block holds about so many fingerprints of one key; a key with more is cut into blocks,
#: and every pair of blocks is looked at by itself.
BLOCK = 1024


def fingerprint(text: bytes) -> int:
    """The fingerprint of one text, see ``op2``."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        starts = [0, *ends[:-1]]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :])]
    total, value = len(hashes), 0
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, total, 1 << 16):  # a long text needs no more memory than a short one
        part = np.array(hashes[at : at + (1 << 16)], dtype=">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    for bit in (counts * 2 > total).tolist():
        value = value * 2 + bit
    return value


def _fingerprints(text: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            prints = np.array([fingerprint(t) for t in binary_column(batch, text)], dtype=np.uint64)
            kept = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != text]
            names = [n for n in batch.schema.names if n != text]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(prints.view(np.int64))], [*names, name])

    return run


def with_fingerprints(docs: DataFrame, keep: list[str], text: str = "text", name: str = "fp") -> DataFrame:
    """``keep`` columns and ``name``, the fingerprint as a signed 64-bit number."""
    schema = docs.select(*keep).schema.add(name, "long")
    return docs.select(*keep, text).mapInArrow(_fingerprints(text, name), schema)


def references() -> list[int]:
    """The pivots: fixed, spread fingerprints."""
    return [xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(PIVOTS)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def pivot_table(prints: DataFrame) -> DataFrame:
    """fp and its distances to the references, packed 8 to a long (lo, hi)."""

    def packed(refs: list[int]):
        out = F.lit(0).cast("long")
        for i, ref in enumerate(refs):
            out = out.bitwiseOR(F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(ref)))).cast("long"), 8 * i))
        return out

    refs = references()
    return prints.select("fp", packed(refs[:8]).alias("lo"), packed(refs[8:]).alias("hi"))


def _keyed(pivots: DataFrame) -> DataFrame:
    """A row per pair of segments, with the segments' bits and the pair's number as key."""
    masks, at = [], 0
    for width in SEGMENTS:
        masks.append(((1 << width) - 1) << at)
        at += width
    keys = [
        F.struct(F.lit(i).cast("int").alias("pair"), F.col("fp").bitwiseAND(F.lit(_signed(a | b))).alias("bits"))
        for i, (a, b) in enumerate(combinations(masks, 2))
    ]
    return pivots.select("*", F.explode(F.array(*keys)).alias("k")).select("fp", "lo", "hi", "k.pair", "k.bits")


def forest(prints: np.ndarray, tables: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the links inside one block pair connect, at most one per row.

    ``tables``: the pivot distances by row.  A pair is discarded if a distance differs by more
    than RADIUS, else verified on the fingerprints.
    """
    left = np.arange(len(prints))
    links = []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = (np.abs(tables[left] - tables[at]) <= RADIUS).all(axis=1)
            if near.any():
                some = left[near]
                some = some[np.bitwise_count(prints[some] ^ prints[at]) <= RADIUS]
                if len(some):
                    links += [(int(at), int(x)) for x in some]
                    front += some.tolist()
                    left = left[~np.isin(left, some, assume_unique=True)]
    return links


def _block_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by block pair; a group may go on in the next batch."""
    group = ["pair", "bits", "b1", "b2"]
    rest = None

    def links_of(frame: pd.DataFrame) -> pd.DataFrame:
        keys = frame[group].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        fp = frame["fp"].to_numpy()
        prints = fp.view(np.uint64)
        tables = np.ascontiguousarray(frame[["lo", "hi"]].to_numpy()).view(np.uint8).reshape(len(frame), 16).astype(np.int16)
        out: list[tuple[int, int]] = []
        starts, ends = [0, *cuts.tolist()], [*cuts.tolist(), len(frame)]
        for a, b in zip(starts, ends):
            if b - a == 2:
                if abs(tables[a] - tables[a + 1]).max() <= RADIUS and int(prints[a] ^ prints[a + 1]).bit_count() <= RADIUS:
                    out.append((a, a + 1))
            elif b - a > 2:
                out += [(a + i, a + j) for i, j in forest(prints[a:b], tables[a:b])]
        ends_ = np.array(out, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": fp[ends_[:, 0]], "b": fp[ends_[:, 1]]})

    for frame in batches:
        if not len(frame):
            continue
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        last = frame[group].to_numpy()
        open_ = (last == last[-1]).all(axis=1)
        first = int(np.argmax(open_)) if open_.any() else len(frame)
        if first:
            yield links_of(frame.iloc[:first])
        rest = frame.iloc[first:].reset_index(drop=True)
    if rest is not None:
        yield links_of(rest)


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` whose components are those of all
    pairs at most RADIUS bits apart.

    Keys that one fingerprint has alone are dropped.  A key with more than BLOCK fingerprints
    is dealt by hash into blocks, and each pair of blocks is a group of its own, so that no
    group outgrows a task however many near copies share a key.
    """
    keyed = _keyed(pivot_table(prints))
    sizes = keyed.groupBy("pair", "bits").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = keyed.join(sizes, ["pair", "bits"]).withColumn("blocks", blocks)
    dealt = dealt.withColumn("home", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("pair", "bits", F.least("home", "other").alias("b1"), F.greatest("home", "other").alias("b2"), "fp", "lo", "hi")
    sorted_ = dealt.repartition("pair", "bits", "b1", "b2").sortWithinPartitions("pair", "bits", "b1", "b2")
    return sorted_.mapInPandas(_block_links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, root, component_id) of every row of ``docs``.

    Words are split at ASCII white space after lower-casing A-Z; a null text has none.  Texts
    without words have fingerprint zero and are linked like any other.  ``component_id`` is the
    smallest id reachable over links; null ids don't count, and a component of null ids only
    has a null; ``root``, the component's smallest fingerprint, names it always.  Repeated rows
    and ids stay.  Equal fingerprints are joined first, so a group
    of copies costs one row in the search.
    """
    prints = cut_lineage(with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), ["doc_id"]), "prints")
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp")))
    member = cut_lineage(distinct.join(roots.withColumnRenamed("node", "fp"), "fp").select("fp", "least", "root"), "members")
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = member.join(least, "root").select("fp", "root", "component_id")
    alone = F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id"))
    whole = distinct.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), alone.alias("component_id"))
    return prints.join(whole, "fp").select("doc_id", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component, the row with its
    ``component_id`` stays.

    Several texts may share an id: each component is looked up by its id and the smallest
    fingerprint that it has under that id.  Of several such rows one stays, and of a component
    without any id one row.  All columns are returned as they came.
    """
    found = cut_lineage(near_duplicates(docs, doc_id, text), "found")
    first = found.where("doc_id = component_id").groupBy("root").agg(F.min("doc_id").alias("_kept_id"), F.min("fp").alias("_fp"))
    rows = found.where("doc_id is not null").groupBy(F.col("doc_id").alias("_kept_id")).agg(F.count("*").alias("_kept_n"))
    chosen = cut_lineage(first.withColumnRenamed("root", "_root").join(rows, "_kept_id"), "chosen")
    ids = chosen.select("_kept_id", "_kept_n").distinct()
    kept = docs.join(ids, docs[doc_id] == F.col("_kept_id"))
    single = kept.where("_kept_n = 1").select(*docs.columns)
    # only rows that share their id are read again for their fingerprints
    shared = kept.where("_kept_n > 1").select(*docs.columns, "_kept_id", F.col(text).alias("_read_text"))
    shared = with_fingerprints(shared, [*docs.columns, "_kept_id"], "_read_text", "_fp")
    several = shared.join(chosen.select("_kept_id", "_fp", "_root"), ["_kept_id", "_fp"]).dropDuplicates(["_root"]).select(*docs.columns)
    nameless = docs.where(docs[doc_id].isNull()).select(*docs.columns, F.col(text).alias("_read_text"))
    printed = with_fingerprints(nameless, docs.columns, "_read_text", "_fp")
    roots = found.where("doc_id is null and component_id is null").select(F.col("fp").alias("_fp"), F.col("root").alias("_root")).distinct()
    nameless = printed.join(roots, "_fp").dropDuplicates(["_root"]).select(*docs.columns)
    return single.union(several).union(nameless)


def fingerprint_hex(fp) -> object:
    """16 lower-case hex digits of a signed 64-bit number."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
