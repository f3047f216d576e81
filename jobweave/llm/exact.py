"""Exact duplicates by Grace hashing.

Texts are equal when they are identical after lower-casing A-Z.  Each task reads its records
into an open-addressing table that holds distinct whole texts and compares them whole; what
leaves the task is one *entry* per distinct text, so that a text that fills a third of the
corpus leaves every task once.  A table holds ``TABLE_BYTES`` at most; a full one is emptied
and begun anew.

Entries are then partitioned by a hash of their digest, each bucket to a task and its table, as
many buckets as it takes for half-full tables.  Where all of a bucket went through one table,
its entries are the groups.  Any other bucket's entries, fewer than before because copies have
met, are spilled and partitioned again by another hash, until each bucket fits.  More than
``MAX_BUCKETS`` buckets are first spilled into folders, which are then partitioned one by one.

What a pass returns is written to the shared folder before it is read, so a lost executor costs
the tasks it ran.  Every record keeps the number of its entry, and every entry that of the entry
it went into; rows get their group by joins along these numbers, whose keys are as frequent as
one task's records at most.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from jobweave.llm.common import rows_of, shared_folder

#: Bytes of text in a table.
TABLE_BYTES = 64 << 20
MAX_BUCKETS = 8192
#: Bytes of text in a batch that leaves a task.
_BATCH_BYTES = 8 << 20
#: A number is the task's, then its own within the task.
_TASK_SHIFT = 40


class Table:
    """Distinct texts with their digests, in slots found by linear probing."""

    def __init__(self) -> None:
        self.digests: list[bytes] = []
        self.texts: list[bytes] = []
        self.bytes = 0
        self._slots = array("q", bytes(8 * 1024))

    def _slot(self, digest: bytes, text: bytes) -> int:
        mask = len(self._slots) - 1
        at = int.from_bytes(digest[:8], "little") & mask
        while entry := self._slots[at]:
            if self.digests[entry - 1] == digest and self.texts[entry - 1] == text:
                break
            at = (at + 1) & mask
        return at

    def find(self, digest: bytes, text: bytes) -> int:
        """The text's entry, or -1."""
        return self._slots[self._slot(digest, text)] - 1

    def add(self, digest: bytes, text: bytes) -> int:
        """A new entry for a text that has none."""
        if 2 * len(self.texts) >= len(self._slots):
            self._slots = array("q", bytes(16 * len(self._slots)))
            for i in range(len(self.texts)):
                self._slots[self._slot(self.digests[i], self.texts[i])] = i + 1
        self._slots[self._slot(digest, text)] = len(self.texts) + 1
        self.digests.append(digest)
        self.texts.append(text)
        self.bytes += len(text) + 200
        return len(self.texts) - 1


def normalised(text: str | bytes | None) -> bytes:
    """UTF-8 with A-Z lower-cased; null as an empty text."""
    return (text.encode() if isinstance(text, str) else text or b"").lower()


def _rank(doc_id, tie: int, row: int) -> tuple:
    """Of equal texts the row with the greatest rank stays: ids fall back on nulls last."""
    return (doc_id is not None, 0 if doc_id is None else doc_id, tie, row)


def _pass(first: bool, schema: pa.Schema, limit: int, level: int, folders: int, whole: bool):
    """The work of a task: records (or, after the first pass, entries) through a bounded table.

    Emits a link for each record and a row for each entry.  An entry is ``settled`` when its
    bucket can hold no other of its text: after the first pass, if the table was never emptied
    and the entries were not to be spilled anyway (``whole``).
    """
    entry_names = ("digest", "text", "size", "n", "best_id", "best_tie", "best_row")
    own = [f.name for f in schema if f.name not in {"node", "parent", "settled", "folder", *entry_names}]

    def batch(n: int, columns: dict) -> pa.RecordBatch:
        arrays = []
        for field in schema:
            values = columns.get(field.name)
            if values is None:
                values = pa.nulls(n, field.type)
            elif not isinstance(values, (pa.Array, pa.ChunkedArray)):
                values = pa.array(values, field.type)
            elif values.type != field.type:
                values = values.cast(field.type)
            arrays.append(values)
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def emptied(table: Table, stats: list[list], base: int, settled: bool) -> Iterator[pa.RecordBatch]:
        at = 0
        while at < len(table.texts):
            end, size = at, 0
            while end < len(table.texts) and (end == at or size < _BATCH_BYTES):
                size += len(table.texts[end])
                end += 1
            some = stats[at:end]
            # the digits that choose a folder are not those that chose the bucket
            folder = [int.from_bytes(hashlib.blake2b(d, digest_size=8, salt=level.to_bytes(8, "little")).digest()[:8], "little") % folders for d in table.digests[at:end]]
            yield batch(end - at, {
                "node": range(base + at, base + end), "settled": [settled] * (end - at), "folder": folder, "digest": table.digests[at:end],
                "text": None if settled else table.texts[at:end], "size": [len(x) for x in table.texts[at:end]],
                "n": [s[0] for s in some], "best_id": [s[1] for s in some], "best_tie": [s[2] for s in some], "best_row": [s[3] for s in some],
            })
            at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << _TASK_SHIFT
        base, table, stats, row, emptied_once = task, Table(), [], task, False
        for b in rows_of(batches):
            column = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            value = lambda name: column[name].to_pylist()
            if first:
                texts = [normalised(x) for x in value("_text")]
                digests = [hashlib.sha256(x).digest() for x in texts]
                nodes = range(row, row + b.num_rows)
                entries = zip([1] * b.num_rows, value("_id"), value("_tie"), nodes)
            else:
                texts, digests, nodes = value("text"), value("digest"), value("node")
                entries = zip(value("n"), value("best_id"), value("best_tie"), value("best_row"))
            row += b.num_rows
            parents = []
            for digest, text, (n, *best) in zip(digests, texts, entries):
                at = table.find(digest, text)
                if at < 0 and table.texts and table.bytes + len(text) > limit:
                    yield from emptied(table, stats, base, False)
                    base, table, stats, emptied_once = base + len(table.texts), Table(), [], True
                if at < 0:
                    at = table.add(digest, text)
                    stats.append([n, *best])
                else:
                    had = stats[at]
                    had[0] += n
                    if _rank(*best) > _rank(*had[1:]):
                        had[1:] = best
                parents.append(base + at)
            yield batch(b.num_rows, {"node": nodes, "parent": parents} | {name: column[name] for name in own})
        yield from emptied(table, stats, base, not first and whole and not emptied_once)

    return run


def _written(rows: DataFrame, run, schema: T.StructType, name: str, folders: int = 1) -> DataFrame:
    """A pass, written to the shared folder, one folder of entries for each group of buckets."""
    spark = rows.sparkSession
    path = shared_folder(spark, name)
    made = rows.mapInArrow(run, schema).write.option("compression", "zstd")
    (made.partitionBy("folder") if folders > 1 else made).parquet(path)
    return spark.read.schema(schema).parquet(path)


def _settle(entries: DataFrame, entry_schema: T.StructType, level: int) -> DataFrame:
    """(node, digest, n, best_id, best_row) of every entry, the last four those of the group it ends in."""
    spark = entries.sparkSession
    size, n = entries.agg(F.sum("size"), F.count("*")).first()
    needed = max(1, min(n, ceil(2 * ((size or 0) + 200 * n) / TABLE_BYTES)))
    folders = ceil(needed / MAX_BUCKETS)
    buckets = min(MAX_BUCKETS, max(needed, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    bucket = F.expr(f"int(pmod(xxhash64(digest, {level}), {buckets}))")
    run = _pass(False, to_arrow_schema(entry_schema), TABLE_BYTES, level, folders, folders == 1)
    seen = entries.select("node", "digest", "text", "n", "best_id", "best_tie", "best_row")
    out = _written(seen.repartitionById(buckets, bucket), run, entry_schema, f"entries-{level}", folders)
    links = out.where("parent is not null").select("node", "parent")
    ends = out.where("settled").select(F.col("node").alias("parent"), "digest", "n", "best_id", "best_row")
    spilled = out.where("parent is null and not settled")
    left = {r["folder"] for r in spilled.select("folder").distinct().collect()}
    for folder in sorted(left):  # at most one folder for MAX_BUCKETS tables of all text
        below = _settle(spilled.where(F.col("folder") == folder), entry_schema, level + 1)
        ends = ends.union(below.select(F.col("node").alias("parent"), "digest", "n", "best_id", "best_row"))
    return links.join(ends, "parent").drop("parent")


def _classified(docs: DataFrame, doc_id: str, text: str, keep: list[str]) -> DataFrame:
    """(row, best_id, n, kept, digest) of every row; ``row`` holds the columns ``keep``."""
    hashed = [f.name for f in docs.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(None).cast("int").alias("_none"))
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in hashed])
    read = docs.select(row.alias("row"), F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"), tie.alias("_tie"))
    entry = T.StructType().add("node", "long").add("parent", "long").add("settled", "boolean").add("digest", "binary").add("text", "binary")
    entry = entry.add("size", "long").add("n", "long").add("best_id", read.schema["_id"].dataType).add("best_tie", "long").add("best_row", "long")
    folder = T.StructField("folder", T.IntegerType())  # last, as readers of folders want it
    first_schema = T.StructType([*entry.fields, T.StructField("row", read.schema["row"].dataType), folder])
    out = _written(read, _pass(True, to_arrow_schema(first_schema), TABLE_BYTES, 0, 1, False), first_schema, "entries-0")
    groups = _settle(out.where("parent is null"), T.StructType([*entry.fields, folder]), 1)
    groups = groups.select(F.col("node").alias("parent"), "digest", "n", "best_id", "best_row")
    rows = out.where("parent is not null").select("parent", "node", "row")
    return rows.join(groups, "parent").select("row", "best_id", "n", (F.col("node") == F.col("best_row")).alias("kept"), "digest")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the class of equal texts that each row is in.

    ``keep`` names the columns of ``docs`` to return (all unless given).  Added are, in place of
    any columns so named: ``keep_id`` (id of the row that stays), ``group_size``, ``kept`` and
    ``text_sha256`` (lower-case hex digest of the normalised text).

    The row with the largest id stays, nulls being the smallest.  Of rows that share text and id
    one stays, chosen by a hash of all columns but maps; rows that are alike in every column
    can't be told apart, and one of them stays.  Null texts are empty ones, and empty texts are
    equal like any others.  Texts of any length are compared whole; one longer than a table has
    a table for itself.  An empty table has no rows.
    """
    added = ("keep_id", "group_size", "kept", "text_sha256")
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    found = _classified(docs, doc_id, text, names)
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    return found.select(*[F.col("row").getField(c).alias(c) for c in names], F.col("best_id").alias("keep_id"), F.col("n").alias("group_size"), "kept", sha)


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class of equal texts (see ``classes``), with the columns of ``docs``."""
    return _classified(docs, doc_id, text, docs.columns).where("kept").select("row.*")
