"""Token files with random access: directly addressable codes.

A file is a Parquet table of segments.  Each segment holds the ids of whole documents in one
binary value, split into levels of 8 bits: level 0 has the low 8 bits of every id, level 1 the
next 8 bits of the ids that need them, and so on.  A bitmap per level says which ids go on, and
a directory of counts per 512 bits gives the rank of a set bit, which is the id's place on the
next level.  Any id is found with one look per level; nothing else is decoded.

Layout of a segment's value (little-endian): magic ``DAC1``, u32 number of levels, then for
every level u64 its number of chunks; then per level its chunks, a byte each, padded to 8
bytes, and, but for the last level, its bitmap (bit i of the level is bit ``i % 8`` of byte
``i // 8``) padded to 64 bytes, and a u32 count of set bits before each 64 bytes of it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobweave.llm.common import rows_of
from jobweave.llm.tokens import Encoder

MAGIC = b"DAC1"
BLOCK_BYTES = 64
#: A segment is closed by the document that brings it to so many ids.
SEGMENT_IDS = 1 << 19


def _pad(data: bytes, to: int) -> bytes:
    return data + bytes(-len(data) % to)


def pack(ids: np.ndarray) -> bytes:
    """One segment's value."""
    rest = ids.astype("<u4")
    sizes, body = [], []
    while True:
        sizes.append(len(rest))
        body.append(_pad((rest & 255).astype(np.uint8).tobytes(), 8))
        rest = rest >> 8
        on = rest > 0
        if not on.any():
            break
        bitmap = np.frombuffer(_pad(np.packbits(on, bitorder="little").tobytes(), BLOCK_BYTES), dtype=np.uint8)
        counts = np.bitwise_count(bitmap).reshape(-1, BLOCK_BYTES).sum(axis=1, dtype=np.uint32)
        before = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u4")
        body += [bitmap.tobytes(), _pad(before.tobytes(), 8)]
        rest = rest[on]
    return MAGIC + struct.pack(f"<I{len(sizes)}Q", len(sizes), *sizes) + b"".join(body)


class Codes:
    """Reads a segment's value without unpacking it."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of token codes")
        (count,) = struct.unpack_from("<I", data, 4)
        sizes = struct.unpack_from(f"<{count}Q", data, 8)
        at = 8 + 8 * count
        self.levels = []
        for i, n in enumerate(sizes):
            chunks, at = np.frombuffer(data, np.uint8, n, at), at + n + -n % 8
            bitmap = before = None
            if i + 1 < count:
                size = -(-n // 8) + -(-(-n // 8)) % BLOCK_BYTES
                bitmap, at = np.frombuffer(data, np.uint8, size, at), at + size
                blocks = size // BLOCK_BYTES
                before, at = np.frombuffer(data, "<u4", blocks, at), at + 4 * blocks + -4 * blocks % 8
            self.levels.append((chunks, bitmap, before))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, level: int, i: int) -> int:
        """Set bits before bit i of a level."""
        _, bitmap, before = self.levels[level]
        block = i // (8 * BLOCK_BYTES)
        if block == len(before):
            return len(self.levels[level + 1][0])
        part = bitmap[block * BLOCK_BYTES : i // 8 + 1]
        whole = i // 8 - block * BLOCK_BYTES
        rest = int(part[whole]) & ((1 << i % 8) - 1) if whole < len(part) else 0
        return int(before[block]) + int(np.bitwise_count(part[:whole]).sum()) + rest.bit_count()

    def get(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value, level = 0, 0
        while True:
            chunks, bitmap, _ = self.levels[level]
            value |= int(chunks[i]) << 8 * level
            if bitmap is None or not bitmap[i // 8] >> i % 8 & 1:
                return value
            i, level = self._rank(level, i), level + 1

    def slice(self, a: int, b: int) -> np.ndarray:
        """The ids from place a to before b."""
        out = np.zeros(max(0, b - a), dtype="<u4")
        where = np.arange(len(out))
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            if a >= b:
                break
            out[where] |= chunks[a:b].astype(np.uint32) << np.uint32(8 * level)
            if bitmap is None:
                break
            bits = np.unpackbits(bitmap[a // 8 : -(-b // 8)], bitorder="little")[a % 8 : a % 8 + b - a]
            where = where[bits.astype(bool)]
            a = self._rank(level, a)
            b = a + len(where)
        return out


def _segments(tokenizer: str, end_id: int, limit: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, seq = TaskContext.get().partitionId(), 0
        encoder = Encoder(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        held: list[bytes] = []
        names: list = []
        ends: list[int] = []

        def close() -> pa.RecordBatch:
            blob = pack(np.frombuffer(b"".join(held), dtype="<u4"))
            values = [[shard], [seq], [ends[-1]], [list(names)], [list(ends)], [blob]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in rows_of(batches):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                held += [ids, end]
                names.append(doc_id)
                ends.append((ends[-1] if ends else 0) + len(ids) // 4 + 1)
                if ends[-1] >= limit:
                    yield close()
                    seq += 1
                    held, names, ends = [], [], []
        if names:
            yield close()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every text and write the token table at ``path``, in ascending order of id.

    A null text is empty; each document ends with ``end_id``.  Null ids come first; rows of one
    id are ordered by their texts' hash, and a range of ids that many rows share is still
    divided among tasks.  Other columns are left out.  An empty table gives an empty file.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()), T.StructField("seq", T.IntegerType()), T.StructField("n_ids", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(rows.schema["doc_id"].dataType)), T.StructField("ends", T.ArrayType(T.LongType())),
            T.StructField("codes", T.BinaryType()),
        ]
    )
    done = rows.mapInArrow(_segments(tokenizer, end_id, segment_ids, to_arrow_schema(schema)), schema)
    done.write.option("parquet.block.size", str(16 << 20)).option("compression", "none").parquet(path)
    spark.catalog.refreshByPath(path)


def segment_starts(segments: DataFrame) -> DataFrame:
    """(shard, seq, segment_start): ids before each segment.

    Sums run over the segments of a shard, and over shards, of which there are as many as the
    writing job had tasks.
    """
    index = segments.select("shard", "seq", "n_ids")
    shards = index.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    shards = shards.withColumn("base", F.sum("n").over(W.orderBy("shard")) - F.col("n")).select("shard", "base")
    within = F.sum("n_ids").over(W.partitionBy("shard").orderBy("seq")) - F.col("n_ids")
    return index.withColumn("within", within).join(shards, "shard").select("shard", "seq", (F.col("base") + F.col("within")).alias("segment_start"))


def _documents(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            for i in range(batch.num_rows):
                shard, seq, doc_ids, ends, data = (batch.column(k)[i].as_py() for k in range(5))
                codes = Codes(data)
                starts = [0, *ends[:-1]]
                sums = [zlib.crc32(codes.slice(a, b).tobytes()) for a, b in zip(starts, ends)]
                n = len(ends)
                values = [doc_ids, [shard] * n, [seq] * n, starts, [b - a for a, b in zip(starts, ends)], sums]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)

    return run


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in a token table.

    ``start`` counts the ids of all documents before it.  Each document's ids are taken out of
    the codes by their place.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    segments = spark.read.parquet(path)
    fields = [("shard", T.IntegerType()), ("seq", T.IntegerType()), ("offset", T.LongType()), ("n_tokens", T.LongType()), ("ids_crc32", T.LongType())]
    schema = T.StructType([T.StructField("doc_id", segments.schema["doc_ids"].dataType.elementType), *(T.StructField(*f) for f in fields)])
    docs = segments.select("shard", "seq", "doc_ids", "ends", "codes").mapInArrow(_documents(to_arrow_schema(schema)), schema)
    placed = docs.join(segment_starts(segments), ["shard", "seq"])
    return placed.select("doc_id", (F.col("segment_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str, start: int, stop: int) -> list[int]:
    """The ids of the whole table from place ``start`` to before ``stop``.

    Only the segments that hold them are read, and of those only the codes asked for are
    decoded.  The caller bounds the range: its ids come to the driver.
    """
    segments = spark.read.parquet(path)
    wanted = segments.join(segment_starts(segments), ["shard", "seq"])
    wanted = wanted.where((F.col("segment_start") < stop) & (F.col("segment_start") + F.col("n_ids") > start))

    @F.udf(T.ArrayType(T.LongType()))
    def part(codes, first, n):
        return Codes(codes).slice(max(0, start - first), min(n, stop - first)).tolist()

    rows = wanted.select("segment_start", part("codes", "segment_start", "n_ids").alias("ids")).orderBy("segment_start").collect()
    return [i for r in rows for i in r["ids"]]
