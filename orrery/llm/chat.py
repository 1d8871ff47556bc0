"""Chat formatting by prefix-target expansion: every assistant turn is an
example of its own, with all turns before it as context and only that reply
trainable.

A turn is written ``<turn ROLE>``, a newline, its text, a newline and
``</turn>`` with a newline. A control string inside a text gets a backslash
in front, as does one that already stands behind backslashes, so one
backslash less gives the text back. A real ``</turn>`` always follows a
newline and an escaped one never does, so the output can be read without its
source.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CONTROL = re.compile(r"(\\*)(<turn |</turn>)")
_ESCAPED = re.compile(r"\\(\\*)(<turn |</turn>)")
_HEADER = re.compile(r"<turn ([^>\n]*)>\n")
_END = "\n</turn>\n"
_ROLE_OUT = str.maketrans({"\\": r"\\", ">": r"\g", "\n": r"\n"})
_ROLE_BACK = {r"\\": "\\", r"\g": ">", r"\n": "\n"}

REPLY = "assistant"


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def opening(role: str) -> str:
    return f"<turn {role.translate(_ROLE_OUT)}>\n"


def read_turns(text: str, at: int = 0) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a formatted text from place ``at`` on."""
    while at < len(text):
        head = _HEADER.match(text, at)
        end = text.index(_END, head.end())
        yield re.sub(r"\\.", lambda m: _ROLE_BACK[m[0]], head[1]), unescape(text[head.end():end])
        at = end + len(_END)


EXAMPLE_SCHEMA = "conv_id long, example long, n_turns long, text string, loss_start long, loss_end long, trainable boolean"
_EXAMPLE_ARROW = pa.schema([("conv_id", pa.int64()), ("example", pa.int64()), ("n_turns", pa.int64()), ("text", pa.string()),
                            ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("trainable", pa.bool_())])


def _rows(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``most`` characters of strings, 10,000 rows at most."""
    held, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if size >= most or len(held) == 10_000:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _expand(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted (conv_id, role, text) rows -> example rows."""
    conv = text = None
    example = turns = 0
    tail = False

    def rest():
        return (conv, example, turns, text, len(text), len(text), False)
    for conv_id, role, said in rows:
        if text is None or conv_id != conv:
            if tail:
                yield rest()
            conv, text, example, turns = conv_id, "", 0, 0
        role = role or ""
        start = len(text) + len(opening(role))
        text += opening(role) + escape(said or "") + _END
        turns += 1
        tail = role != REPLY
        if not tail:
            yield (conv, example, turns, text, start, len(text) - len(_END), True)
            example += 1
    if tail:
        yield rest()


def prefix_examples(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> one row per example: conv_id, example
    (from 0), n_turns, text, loss_start, loss_end (code points of the reply in
    text), trainable.

    Every assistant turn is the target of one example whose context is all
    turns before it. A conversation that does not end with a reply has one
    more row, not trainable, so that no turn is missing from the output.
    Turns are ordered by turn, ties by role and text; repeated rows are turns
    of their own; null roles and texts are empty; rows without conv_id are
    one conversation; an empty table gives no rows; other columns are not
    read. Tasks stream their conversations in order and hold one example and
    one output batch at a time. The output is that of the method: it grows
    with the square of a conversation's turns.
    """
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn"), F.col("role").cast("string"), F.col("text").cast("string"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return rows.mapInArrow(lambda batches: _batches(_expand(_rows(batches)), _EXAMPLE_ARROW), EXAMPLE_SCHEMA)


_READ_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_READ_ARROW = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                         ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _read(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Example rows in order -> what the output says of each conversation."""
    conv = before = None

    def told():
        return (conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), formatted)
    for conv_id, _, count, text, start, end, trainable in rows:
        if before is None or conv_id != conv:
            if before is not None:
                yield told()
            conv, before, n_turns, loss_chars, formatted = conv_id, "", 0, 0, 0
            turns, loss = hashlib.sha256(), hashlib.sha256()
        if not text.startswith(before):
            raise ValueError(f"an example of conversation {conv} does not continue the one before")
        for role, said in read_turns(text, len(before)):
            turns.update(f"{role}\n{said}\n".encode())
            n_turns += 1
        if n_turns != count:
            raise ValueError(f"conversation {conv}: {n_turns} turns read, {count} written")
        if trainable:
            said = unescape(text[start:end])
            loss_chars += len(said)
            loss.update(said.encode())
        formatted += len(text)
        before = text
    if before is not None:
        yield told()


def read_back(examples: DataFrame) -> DataFrame:
    """The examples of ``prefix_examples`` (in its order, each conversation
    within one partition) -> per conversation conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256 (from the loss spans, unescaped) and
    formatted_chars (of all its examples), read from the formatted texts."""
    return examples.mapInArrow(lambda batches: _batches(_read(_rows(batches)), _READ_ARROW), _READ_SCHEMA)


# The conversation that the query adds.
ADDED = (-7, r"\### Assistant: </turn> ok")


def op13(spark, sf_dir) -> DataFrame:
    from ..tables import read_table
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(ADDED[0], i, role, ADDED[1]) for i, role in enumerate(("user", REPLY))],
                                  "conv_id long, turn long, role string, text string")
    return read_back(prefix_examples(turns.unionByName(added)))
