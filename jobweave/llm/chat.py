"""Chat formatting, put together from token segments.

A conversation becomes, turn after turn,

    ### Role: text</turn>

where ``### ``, ``: `` after the role, and ``</turn>`` are control strings with reserved ids of
their own.  Role and text are encoded by themselves, as ordinary text, and the reserved ids are
spliced between them, so no text can produce a reserved id.  The formatted string has to be
as safe as the ids: control strings inside a text are escaped by a backslash before them, and
so is each backslash, which is undone by taking every backslash away and the character after it
as it is.

The loss mask covers the ids of assistant texts.  It is the running sum of +1 where such a text
begins and -1 where it ends; the place of a turn in its conversation is the running sum of the
lengths of the turns before it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobweave.llm.common import rows_of
from jobweave.llm.tokens import Encoder

OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
#: Reserved ids, counted from the first id that the tokenizer doesn't use.
RESERVED = 3
ASSISTANT = "assistant"

_CONTROL = re.compile(r"\\|(?=### |</turn>)")
_HEAD = re.compile(r"\\|(?=### |</turn>|: )")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """Text with a backslash before every backslash and control string."""
    return _CONTROL.sub(lambda m: "\\" + m.group(), text)


def escape_role(role: str) -> str:
    return _HEAD.sub(lambda m: "\\" + m.group(), role)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def _encoded(tokenizer: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, plain_specials=True)
        base = encoder.tokenizer.get_vocab_size(with_added_tokens=True)
        mark = [np.array([base + i], dtype="<u4").tobytes() for i in range(RESERVED)]
        for batch in rows_of(batches):
            roles = [r or "" for r in batch.column(2).to_pylist()]
            heads = [escape_role(r) for r in roles]
            bodies = [escape(t or "") for t in batch.column(3).to_pylist()]
            shown, ids, lengths, masks = [], [], [], []
            for role, head, body, head_ids, body_ids in zip(roles, heads, bodies, encoder.encode(heads), encoder.encode(bodies)):
                segments = [mark[0], head_ids, mark[1], body_ids, mark[2]]
                ids.append(b"".join(segments))
                at = np.cumsum([len(s) // 4 for s in segments])
                lengths.append(int(at[-1]))
                steps = np.zeros(at[-1] + 1, dtype=np.int8)
                if role == ASSISTANT:
                    np.add.at(steps, [at[2], at[3]], [1, -1])
                masks.append(np.cumsum(steps[:-1], dtype=np.int8).astype(np.uint8).tobytes())
                shown.append(f"{OPEN}{head}{COLON}{body}{CLOSE}")
            columns = [batch.column(0), batch.column(1), shown, ids, masks, lengths, roles, [len(OPEN + h + COLON) + 1 for h in heads]]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def format_turns(rows: DataFrame, tokenizer: str, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, seq, start, formatted, ids, mask, n_ids), a row per turn.

    ``seq`` numbers a conversation's turns from 0; rows of one turn number are ordered by role
    and text, and a null number comes first.  ``start`` is the turn's place among the
    conversation's ids; ``ids`` are little-endian unsigned 32-bit integers and ``mask`` has a
    byte per id.  Null roles and texts are empty.  Rows without a conv_id form a conversation.
    Turns are encoded wherever their rows are; only then are they ordered, one conversation
    running through one task as a stream of rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    slim = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    fields = [("formatted", T.StringType()), ("ids", T.BinaryType()), ("mask", T.BinaryType()), ("n_ids", T.LongType()), ("role", T.StringType()), ("body", T.IntegerType())]
    schema = T.StructType([slim.schema["conv_id"], slim.schema["turn"], *(T.StructField(*f) for f in fields)])
    made = slim.mapInArrow(_encoded(tokenizer, to_arrow_schema(schema)), schema)
    # the text as it was, without a second copy of it on the way: CLOSE is behind it in every row
    text = F.regexp_replace(F.substr("formatted", F.col("body")), r"(?s)\\(.)", "$1")
    order = W.partitionBy("conv_id").orderBy("turn", "role", F.left(text, F.length(text) - len(CLOSE)))
    running = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    made = made.withColumn("seq", F.row_number().over(order) - 1).withColumn("start", F.sum("n_ids").over(running) - F.col("n_ids"))
    return made.select("conv_id", "turn", "seq", "start", "formatted", "ids", "mask", "n_ids")


def split_turn(ids: np.ndarray, mask: np.ndarray, base: int, decode) -> tuple[str, str, str]:
    """Role, text, and text under the mask, read from a turn's ids."""
    at = [int(np.flatnonzero(ids == base + i)[0]) for i in range(RESERVED)]
    head, body = decode(ids[at[0] + 1 : at[1]].tolist()), decode(ids[at[1] + 1 : at[2]].tolist())
    lossy = ids[mask.astype(bool)].tolist()
    return unescape(head), unescape(body), unescape(decode(lossy)) if lossy else ""


def _digests(tokenizer: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        read = Tokenizer.from_file(tokenizer)
        base = read.get_vocab_size(with_added_tokens=True)
        decode = lambda ids: read.decode(ids, skip_special_tokens=False)
        now, state, done = None, None, []

        def close() -> None:
            conv_id, turns, text, loss, loss_chars, chars, n_ids = state
            done.append((conv_id, turns, text.hexdigest(), loss_chars, loss.hexdigest(), chars, n_ids))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [[] for _ in schema]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in rows_of(batches):
            conv_ids, shown = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, (conv_id, formatted) in enumerate(zip(conv_ids, shown)):
                if now != (conv_id,):
                    if state:
                        close()
                    now, state = (conv_id,), [conv_id, 0, hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                ids = np.frombuffer(batch.column(2)[i].as_py(), dtype="<u4")
                role, text, lossy = split_turn(ids, np.frombuffer(batch.column(3)[i].as_py(), dtype=np.uint8), base, decode)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3].update(lossy.encode())
                state[4] += len(lossy)
                state[5] += len(formatted)
                state[6] += len(ids)
            yield flush()
        if state:
            close()
        yield flush()

    return run


def read_conversations(turns: DataFrame, tokenizer: str) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_ids) of each
    conversation, from the formatted turns' ids and masks.

    Conversations stream through tasks turn by turn, so a long one needs no more memory than
    its longest turn.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    sums = [
        ("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()), ("loss_sha256", T.StringType()),
        ("formatted_chars", T.LongType()), ("n_ids", T.LongType()),
    ]
    schema = T.StructType([turns.schema["conv_id"], *(T.StructField(*s) for s in sums)])
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "seq").select("conv_id", "formatted", "ids", "mask")
    return ordered.mapInArrow(_digests(tokenizer, to_arrow_schema(schema)), schema)
