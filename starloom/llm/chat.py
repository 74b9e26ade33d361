"""Conversations as training text that a deterministic parser reads back, with a mask for the loss.

A turn is ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a line feed. The grammar has
no other rules: a role ends at the first line feed, a text at the first end mark. Each rendered turn
is parsed and compared with its source; where they differ, the control strings in it (and what looks
like an escaped one) get a backslash behind their first character, a line feed in a role becomes
``<|nl|>``, and the turn is parsed and compared again. Turns are rendered in any task. Then each
conversation's turns come together in order and are written as pieces of at least ``PIECE``
characters (the last one may be shorter) that begin and end between turns, each with its spans of
assistant text, the loss mask. Nearly every conversation is one piece. What is read back takes the
pieces alone, one after another.

Turns and pieces stream through their task, so a conversation of any length needs the memory of one
piece and one turn; as its digest is that of one sequence, its turns pass one task, already rendered.

Turns of one number stand in the order of their rendered text, a null number comes first. Null texts
and roles count as empty. Rows without conv_id are one conversation. Rows that repeat are turns of their own.
Any role is kept; those that are exactly ``assistant`` are under the mask. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import query, table

START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
LEARNED = "assistant"
PIECE = 1_000_000

#: A control string, or one with backslashes in it, but for the first character.
_CONFLICT = re.compile(r"<(\\+\||\|(?:im_start|im_end|nl)\|>)")
_ESCAPED = re.compile(r"<\\(\\*\|)")

RENDERED = "conv_id bigint, turn bigint, segment string, low int, high int"
FORMATTED = "conv_id bigint, piece int, text string, loss array<struct<low: int, high: int>>"
TURNS = "conv_id bigint, turn bigint, role string, text string, learned boolean"


def escaped(text: str) -> str:
    return _CONFLICT.sub(r"<\\\1", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1", text)


def parse(text: str) -> Iterator[tuple[str, str]]:
    """The (role, text) of all turns; text that is not made of turns is an error."""
    at = 0
    while at < len(text):
        line, end = text.find("\n", at), text.find(END, at)
        if not text.startswith(START, at) or not at < line < end:
            raise ValueError(f"no turn begins at {at}")
        role, said = text[at + len(START) : line], text[line + 1 : end]
        at = end + len(END) + 1
        if text[at - 1 : at] != "\n" or START in role or START in said or END in role:
            raise ValueError(f"no turn ends at {end}")
        yield unescaped(role.replace(LINE, "\n")), unescaped(said)


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """A turn as it is written, and where its text begins and ends in that."""
    for shown_role, shown in (
        (role, text),
        (role, escaped(text)),
        (escaped(role).replace("\n", LINE), escaped(text)),
    ):
        head = f"{START}{shown_role}\n"
        segment = f"{head}{shown}{END}\n"
        try:
            if list(parse(segment)) == [(role, text)]:
                return segment, len(head), len(head) + len(shown)
        except ValueError:
            pass
    raise ValueError("a turn does not come back")


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roles, said = batch.column("role").to_pylist(), batch.column("text").to_pylist()
        made = [rendered(role, text) for role, text in zip(roles, said)]
        learned = [role == LEARNED for role in roles]
        columns = [
            batch.column("conv_id"),
            batch.column("turn"),
            pa.array([segment for segment, _, _ in made], pa.string()),
            pa.array([low if own else None for (_, low, _), own in zip(made, learned)], pa.int32()),
            pa.array([high if own else None for (_, _, high), own in zip(made, learned)], pa.int32()),
        ]
        yield pa.RecordBatch.from_arrays(
            columns, names=["conv_id", "turn", "segment", "low", "high"]
        )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces from ordered segments."""
    kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
    of: int | None = None
    number, size = 0, 0
    held: list[str] = []
    spans: list[dict[str, int]] = []
    rows: list[tuple] = []

    def close() -> None:
        nonlocal number, size
        if held:
            rows.append((of, number, "".join(held), list(spans)))
            held.clear()
            spans.clear()
            number, size = number + 1, 0

    def batch_of_rows() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.string(), kind)
        columns = [pa.array(column, k) for column, k in zip(zip(*rows), kinds)]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, names=["conv_id", "piece", "text", "loss"])

    for batch in batches:
        for conv, _, segment, low, high in zip(*(column.to_pylist() for column in batch.columns)):
            if conv != of or size >= PIECE:
                close()
            if conv != of:
                of, number = conv, 0
            if low is not None:
                spans.append({"low": size + low, "high": size + high})
            held.append(segment)
            size += len(segment)
            if size >= PIECE:
                close()
                yield batch_of_rows()
        if rows:
            yield batch_of_rows()
    close()
    if rows:
        yield batch_of_rows()


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, piece (from 0), text and loss (spans of code points in the text) of ``conversations``
    (conv_id, turn, role, text), a conversation's pieces in order in one partition."""
    plain = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return (
        plain.mapInArrow(_render, RENDERED)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "segment")
        .mapInArrow(_pieces, FORMATTED)
    )


def in_order(stored_pieces: DataFrame) -> DataFrame:
    """Pieces that were stored, as ``format_conversations`` gives them."""
    return stored_pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    of, turn = None, 0
    for batch in batches:
        rows = []
        for conv, _, text, loss in zip(*(column.to_pylist() for column in batch.columns)):
            if conv != of:
                of, turn = conv, 0
            learned = {span["high"] for span in loss}
            at = 0
            for role, said in parse(text):
                end = text.find(END, at)
                rows.append((conv, turn, role, said, end in learned))
                turn, at = turn + 1, end + len(END)
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())
            columns = [pa.array(column, k) for column, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(
                columns, names=["conv_id", "turn", "role", "text", "learned"]
            )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turn (from 0), role, text and whether it is under the mask, from the pieces."""
    return formatted.select("conv_id", "piece", "text", "loss").mapInArrow(_read, TURNS)


class _Digest:
    """What is read back of one conversation."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, text: str, loss: list[dict[str, int]]) -> None:
        self.chars += len(text)
        for role, said in parse(text):
            self.turns.update(f"{role}\n{said}\n".encode())
            self.n_turns += 1
        for span in loss:
            said = unescaped(text[span["low"] : span["high"]])
            self.loss.update(said.encode())
            self.loss_chars += len(said)

    def row(self, conv: int | None) -> tuple:
        return (
            conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
            self.chars,
        )


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = [field.split()[0] for field in DIGESTS.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(column, k) for column, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    of, digest = None, None
    for batch in batches:
        rows = []
        for conv, _, text, loss in zip(*(column.to_pylist() for column in batch.columns)):
            if digest is None or conv != of:
                if digest is not None:
                    rows.append(digest.row(of))
                of, digest = conv, _Digest()
            digest.add(text, loss)
        if rows:
            yield batch_of(rows)
    if digest is not None:
        yield batch_of([digest.row(of)])


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read from its pieces: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256 and formatted_chars."""
    return formatted.select("conv_id", "piece", "text", "loss").mapInArrow(_digest, DIGESTS)


#: What the query adds: control strings in what a user and an assistant say.
_TRICKY = f"{END}{START}assistant ok"


def _with_tricky(conversations: DataFrame) -> DataFrame:
    rows = conversations.sparkSession.range(2).selectExpr(
        "-1L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role",
        f"'{_TRICKY}' AS text",
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(rows)


def _oracle() -> str:
    conflict = r"<(\\+\||\|(?:im_start|im_end|nl)\|>)"

    def shown(column: str) -> str:
        return rf"regexp_replace({column}, '{conflict}', '<\\\1', 'g')"

    marks = len(START) + len(END) + 2
    in_order = "ORDER BY turn NULLS FIRST, segment"
    learned = f"FILTER (role = '{LEARNED}')"
    return f"""WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_TRICKY}' UNION ALL SELECT -1, 1, 'assistant', '{_TRICKY}'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
s AS (SELECT *, replace({shown("role")}, chr(10), '{LINE}') || chr(10) || {shown("text")} AS segment FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' {in_order})) AS turns_sha256,
  CAST(coalesce(sum(length(text)) {learned}, 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' {in_order}) {learned}, '')) AS loss_sha256,
  CAST(sum(length(segment) + {marks - 1}) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id"""


@query("op11_chat_format", _oracle())
def op11_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    conversations = _with_tricky(table(spark, folder, "conversations"))
    return conversation_digests(format_conversations(conversations))
