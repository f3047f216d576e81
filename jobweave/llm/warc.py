"""Web archives (WARC): writing with revisit records, and reading by boundary chains.

Writing.  A record is a row of text; Spark's text writer puts the blank line after it that ends
a record, so that the files are plain, uncompressed WARC files and appear when their task is
committed.

Reading.  Spark splits the files at ``CRLF CRLF WARC/1.``, which every record but a file's
first follows.  That also happens inside payloads which contain these bytes, so a piece is
only a candidate: its header says where its successor would begin.  Tasks emit these
record-to-successor offsets, and for each candidate where its chain leaves the split.  Pointer
jumping over the splits of a file, from the file's start, finds each split's true entry; from
there the split's own chain is followed.  Candidates that no chain reaches are parts of a
payload.  A record whose payload was cut like that is put together again from its pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobweave.llm.common import cut_lineage, rows_of

CRLF = "\r\n"
END = CRLF + CRLF
MAGIC = "WARC/1."
SEPARATOR = END + MAGIC
#: Payloads of fewer bytes are always written out.
LEAST_REVISIT = 100
#: Payloads that several rows have, as many as are broadcast; each takes about 200 bytes.
BROADCAST_GROUPS = 200_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_URN = "urn:x-page:"


def _name(page_id: Column, mark: Column) -> Column:
    return F.concat(F.lit(f"<{_URN}"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), mark, F.lit(">"))


def _groups(rows: DataFrame) -> DataFrame:
    """(_digest, first, ties) of every payload that several rows have: the smallest id, null if
    there is none, and how many rows have that id."""
    by_id = rows.where(F.col("n_bytes") >= LEAST_REVISIT).groupBy("digest", "page_id").agg(F.count("*").alias("n"))
    least = F.min(F.struct(F.col("page_id").isNull().alias("nameless"), "page_id", "n"))
    groups = by_id.groupBy(F.col("digest").alias("_digest")).agg(least.alias("least"), F.sum("n").alias("n")).where("n > 1")
    return groups.select("_digest", F.col("least.page_id").alias("first"), F.col("least.n").alias("ties"))


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, n_bytes, digest, role, first) of every row of ``pages``.

    ``role`` is null for payloads that one row has alone or that are too small, "response" for
    the row with the smallest id among equal payloads of LEAST_REVISIT bytes or more, and
    "revisit" for the others, with ``first``, the response's id.  Of rows with that id, the one
    with the smallest URL is the response; rows without an id come last.

    The payloads that several rows have are broadcast while their list is small, which is
    checked, so that pages stay where they are read; beyond that the pages are dealt out by
    digest.  Payloads of revisits are not moved further.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("n_bytes"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
    )
    groups = cut_lineage(_groups(rows), "payload-groups")
    sized = F.broadcast if groups.count() <= BROADCAST_GROUPS else lambda x: x
    joined = rows.join(sized(groups), (F.col("digest") == F.col("_digest")) & (F.col("n_bytes") >= LEAST_REVISIT), "left")
    is_first = F.col("_digest").isNotNull() & F.col("page_id").eqNullSafe(F.col("first"))
    columns = ["page_id", "url", "payload", "n_bytes", "digest", "role", "first"]
    role = F.when(is_first, "response").when(F.col("_digest").isNotNull(), "revisit")
    plain = joined.where(~is_first | (F.col("ties") == 1)).withColumn("role", role).select(*columns)
    # rows that share the smallest id: one response, chosen with its payload, and the rest without
    tied = joined.where(is_first & (F.col("ties") > 1))
    place = F.row_number().over(W.partitionBy("digest").orderBy("url"))
    one = tied.withColumn("_place", place).where("_place = 1").withColumn("role", F.lit("response")).select(*columns)
    rest = tied.withColumn("payload", F.lit("")).withColumn("_place", place).where("_place > 1").withColumn("role", F.lit("revisit")).select(*columns)
    return plain.union(one).union(rest)


def write_archives(records: DataFrame, path: str) -> None:
    """Write planned records as WARC files below ``path``."""
    is_revisit = F.coalesce(F.col("role") == "revisit", F.lit(False))
    # a name that others refer to is made of id and payload; any other just has to be one
    mark = F.when(F.col("role") == "response", F.col("digest")).otherwise(F.concat(F.lit("m"), F.monotonically_increasing_id().cast("string")))
    clean = F.replace(F.replace(F.coalesce(F.col("url"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(END))
    length = F.octet_length(http) + F.when(is_revisit, 0).otherwise(F.col("n_bytes"))
    refers = F.concat(F.lit(f"WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: "), _name(F.col("first"), F.col("digest")), F.lit(CRLF))
    head = F.concat(
        F.lit(f"{MAGIC}1{CRLF}WARC-Type: "), F.when(is_revisit, "revisit").otherwise("response"), F.lit(f"{CRLF}WARC-Record-ID: "), _name(F.col("page_id"), mark),
        F.lit(f"{CRLF}WARC-Date: {DATE}{CRLF}WARC-Target-URI: "), clean, F.lit(f"{CRLF}WARC-Payload-Digest: sha256:"), F.col("digest"), F.lit(CRLF),
        F.when(is_revisit, refers).otherwise(""), F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), length.cast("string"), F.lit(END),
    )
    text = F.concat(head, http, F.when(is_revisit, "").otherwise(F.col("payload")))
    records.select(text.alias("value")).write.option("lineSep", END).text(path)


def parse(piece: bytes) -> tuple[int, dict[bytes, bytes]] | None:
    """Length of a record's header, without its magic, and its fields; None if it isn't one."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    lines = piece[:end].split(b"\r\n")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    if not lines[0].isdigit() or not fields.get(b"content-length", b"").isdigit():
        return None
    return end + 4, fields


def _identity(name: bytes | None) -> str | None:
    """The page id in a record's name."""
    text = (name or b"").decode("utf-8", "replace").strip("<>")
    return text.removeprefix(_URN).rpartition(":")[0] or None if text.startswith(_URN) else None


def describe(fields: dict[bytes, bytes], block: bytes) -> dict:
    """What is known of a whole record: its payload's size and digest among it."""
    kind = fields.get(b"warc-type", b"").decode("utf-8", "replace")
    payload, size, digest = block, None, None
    if fields.get(b"content-type", b"").startswith(b"application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        for line in http.split(b"\r\n"):
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length" and value.strip().isdigit():
                size = int(value)
    if kind == "revisit":
        digest = fields.get(b"warc-payload-digest", b"").decode("utf-8", "replace").rpartition(":")[2]
    else:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    return {
        "record_type": kind, "page_id": _identity(fields.get(b"warc-record-id")), "refers_to": _identity(fields.get(b"warc-refers-to")),
        "uri": fields.get(b"warc-target-uri", b"").decode("utf-8", "replace"), "payload_bytes": size, "payload_digest": digest,
    }


_INFO = "record_type string, page_id string, refers_to string, uri string, payload_bytes long, payload_digest string"
_SCAN = f"kind string, file string, block long, at long, whole boolean, {_INFO}, starts binary, nexts binary, length long, total long, last long"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, int, bytes]]:
    """(file, split, its length, offset, piece): offsets are from the first piece of the split,
    without the magic, which the separator holds."""
    split, at = None, 0
    for batch in rows_of(batches):
        files, blocks, lengths = (batch.column(k).to_pylist() for k in (1, 2, 3))
        for i in range(batch.num_rows):
            piece = batch.column(0)[i].as_py()
            if split != (files[i], blocks[i]):
                split, at = (files[i], blocks[i]), 0
                if blocks[i] == 0:  # the file's own magic comes without a separator
                    piece = piece[len(MAGIC) :] if piece.startswith(MAGIC.encode()) else b""
            yield *split, lengths[i], at, piece
            at += len(piece) + len(SEPARATOR)


def _scan(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        starts: list[int] = []
        nexts: list[int] = []
        split, length, last, upto = None, 0, 0, 0

        def close() -> dict:
            pack = lambda x: np.array(x, dtype="<i8").tobytes()
            return {"kind": "split", "file": split[0], "block": split[1], "starts": pack(starts), "nexts": pack(nexts), "length": length, "total": upto, "last": last}

        for file, block, size_of, at, piece in _pieces(batches):
            if split is not None and split != (file, block):
                rows.append(close())
                starts, nexts = [], []
            split, length, last, upto = (file, block), size_of, at, at + len(piece) + len(SEPARATOR)
            row = {"kind": "piece", "file": file, "block": block, "at": at, "whole": False}
            found = parse(piece)
            if found:
                head, fields = found
                size = int(fields[b"content-length"])
                starts.append(at)
                nexts.append(at + head + size + len(SEPARATOR))
                if piece[head + size :] in (b"", END.encode()) and head + size <= len(piece):
                    row |= {"whole": True, **describe(fields, piece[head : head + size])}
            rows.append(row)
            if len(rows) >= 2000:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows = []
        if split is not None:
            rows.append(close())
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _place(frame: pd.DataFrame) -> pd.DataFrame:
    """Where each split's first piece lies in its file, and ``until``: the split's pieces before
    this offset are its own.

    The line reader goes on for one piece more if a split ends on bytes that a separator could
    begin with.  If no separator is there, the next split reads that piece too.  A split owns no
    piece whose separator begins at or beyond the split's end, so such a last piece is left to
    the next split.
    """
    frame = frame.sort_values("block")
    bases, untils, base = [], [], 0
    for i, (block, length, total, last) in enumerate(frame[["block", "length", "total", "last"]].itertuples(index=False)):
        extra = i + 1 < len(frame) and base + last + len(MAGIC) - len(SEPARATOR) >= block + length
        bases.append(base)
        untils.append(last if extra else total)
        base += untils[-1]
    return frame.assign(base=bases, until=untils)[["file", "block", "base", "until"]]


def _exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each candidate, where its chain leaves the split; offsets are the file's."""
    for frame in batches:
        for file, block, base, until, starts, nexts in frame.itertuples(index=False):
            own, after = np.frombuffer(starts, "<i8"), np.frombuffer(nexts, "<i8")
            own, after = own[own < until], after[own < until]
            leave: dict[int, int] = {}
            for a, b in zip(own[::-1].tolist(), after[::-1].tolist()):
                leave[a] = leave.get(b, b)
            yield pd.DataFrame({"file": file, "block": block, "at": own + base, "out": np.array([leave[a] for a in own.tolist()], dtype=np.int64) + base})


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The candidates that the chain from a split's entry reaches."""
    for frame in batches:
        for file, block, base, until, starts, nexts, entry in frame.itertuples(index=False):
            step = dict(zip(np.frombuffer(starts, "<i8").tolist(), np.frombuffer(nexts, "<i8").tolist()))
            at, found = int(entry - base), []
            while at in step and at < until:
                found.append(at)
                at = step[at]
            yield pd.DataFrame({"file": file, "block": block, "at": np.array(found, dtype=np.int64)})


def _reached(splits: DataFrame, places: DataFrame) -> DataFrame:
    """(file, block, at) of every true record, ``at`` within the split."""
    placed = cut_lineage(splits.select("file", "block", "starts", "nexts").join(places, ["file", "block"]).select("file", "block", "base", "until", "starts", "nexts"), "splits")
    chains = placed.mapInPandas(_exits, "file string, block long, at long, out long")
    outs = chains.select("file", F.col("out").alias("at")).distinct()
    entries = chains.join(outs, ["file", "at"], "left_semi").union(chains.where("at = 0")).distinct()
    jumps = cut_lineage(entries, "entries")
    nodes = jumps.select("file", "block", "at")
    jumps = jumps.select("file", "at", "out")
    seen = cut_lineage(jumps.where("at = 0").select("file", "at"), "seen")
    count = seen.count()
    while True:  # after k rounds, jumps go over 2^k splits, and all entries within that are seen
        further = seen.join(jumps, ["file", "at"]).select("file", F.col("out").alias("at")).join(nodes, ["file", "at"], "left_semi")
        seen = cut_lineage(seen.union(further).distinct(), "seen")
        if (now := seen.count()) == count:
            break
        count = now
        twice = jumps.join(jumps.select("file", F.col("at").alias("out"), F.col("out").alias("far")), ["file", "out"], "left")
        jumps = cut_lineage(twice.select("file", "at", F.coalesce("far", "out").alias("out")), "jumps")
    entered = nodes.join(seen, ["file", "at"]).select("file", "block", F.col("at").alias("entry"))
    walked = placed.join(entered, ["file", "block"]).select("file", "block", "base", "until", "starts", "nexts", "entry")
    return walked.mapInPandas(_walk, "file string, block long, at long")


def _raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file, block, _, at, piece in _pieces(batches):
        yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "at": at, "data": piece}])


def _join_pieces(schema: pa.Schema):
    """One record from its pieces; nothing if the file ends inside it."""

    def run(group: pa.Table) -> pa.Table:
        joined = SEPARATOR.encode().join(group.sort_by([("block", "ascending"), ("at", "ascending")]).column("data").to_pylist())
        head, fields = parse(joined)
        size = int(fields[b"content-length"])
        whole = [describe(fields, joined[head : head + size])] if len(joined) >= head + size else []
        return pa.Table.from_pylist(whole, schema=schema)

    return run


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(record_type, page_id, refers_to, uri, payload_bytes, payload_digest) of every record
    that a chain from its file's start reaches.

    Sizes and digests of responses are computed from the payload; those of revisits are what
    their headers say.  A record that its file cuts off is left out, and so is what follows a
    header that isn't one.  A payload is held by one task at a time, never a file.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    raw = spark.read.option("lineSep", SEPARATOR).text(path)
    raw = raw.select(F.col("value").cast("binary"), F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.col("_metadata.file_block_length"))
    schema = T._parse_datatype_string(_SCAN)
    scanned = cut_lineage(raw.mapInArrow(_scan(to_arrow_schema(schema)), schema), "scan")
    pieces = scanned.where("kind = 'piece'")
    splits = scanned.where("kind = 'split'")
    places = splits.select("file", "block", "length", "total", "last").groupBy("file").applyInPandas(_place, "file string, block long, base long, until long")
    places = cut_lineage(places, "places")
    reached = cut_lineage(_reached(splits, places), "reached")
    info = [f.name for f in T._parse_datatype_string(_INFO)]
    true = pieces.join(reached, ["file", "block", "at"])
    records = true.where("whole").select(*info)
    broken = true.where("not whole").select("file").distinct()
    if broken.isEmpty():
        return records
    own = pieces.join(broken, "file", "left_semi").join(places, ["file", "block"]).where("at < until")
    marked = own.select("file", "block", "at", "whole").join(reached.withColumn("true", F.lit(True)), ["file", "block", "at"], "left")
    order = W.partitionBy("file").orderBy("block", "at").rowsBetween(W.unboundedPreceding, W.currentRow)
    owner = F.last(F.when(F.col("true"), F.struct("block", "at", "whole")), ignorenulls=True).over(order)
    parts = marked.withColumn("owner", owner).where("owner is not null and not owner.whole").select("file", "block", "at", "owner")
    data = raw.mapInArrow(_raw, "file string, block long, at long, data binary")
    joined = data.join(parts, ["file", "block", "at"]).select("file", F.col("owner.block").alias("ob"), F.col("owner.at").alias("oa"), "block", "at", "data")
    mended = joined.groupBy("file", "ob", "oa").applyInArrow(_join_pieces(to_arrow_schema(T._parse_datatype_string(_INFO))), _INFO)
    return records.union(mended)
