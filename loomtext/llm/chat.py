"""Operator 10: chat formatting by prefix-target expansion.

A conversation is rendered turn by turn: `<s>[INST] user [/INST]` for a user, ` assistant </s>` for an assistant,
`<<SYS>>...<</SYS>>` for the system, `<<role>>...` for any other role. Control strings inside texts are escaped by a
backslash after their first character, and backslashes are doubled, so no text can pass for a control string and every
text can be read back.

Every assistant turn is an example of its own: its context is the rendering of all turns before it, and only its own
text is trainable. Examples are written in full at any length, in pieces of PIECE_CHARS characters, so no row is large; what they take grows
with the square of a conversation's turns, as the method has it (5.6 times the texts on the largest tables at hand, whose longest
conversation has 399 turns). Turns that no example holds are written as segments. Reading back puts an example's pieces together, and
one whose context is not what was read before it is an error.

Rows are dealt by conversation and sorted by turn, then read as a stream: a task holds the rendering of one conversation and one batch. (A
digest of a whole conversation is sequential by definition, so the turns of one conversation meet in one task.)

Defined cases: a null text is empty; a null role is "other"; a null conv_id is a conversation like any other; turns that tie
are ordered by role, then text; repeated rows are turns of their own; an empty table gives an empty result. Ids are passed on
untouched. Other columns may have any names; they are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import materialise_small, table

#: Characters of an example in one row.
PIECE_CHARS = 1 << 16
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<", ">>")
#: A backslash, or a character that could go on to a control string.
_ESCAPE = re.compile(r"\\|<(?=[<s/])|\[(?=[I/])|>(?=>)")
_ROLE = re.compile(r"[\\<>]")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
#: Prefix and suffix around the text of a turn.
_MARKS = {"user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>>", "<</SYS>>")}
_OTHER = re.compile(r"<<((?:[^\\>]|\\.)*)>>(.*)<</>>", re.DOTALL)
_OTHER_START = re.compile(r"<<((?:[^\\>]|\\.)*)>>", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The segment of a turn and where its (escaped) text begins and ends in it."""
    before, after = _MARKS.get(role) or ("<<" + ("\\" if role == "SYS" else "") + _ROLE.sub(r"\\\g<0>", role) + ">>", "<</>>")
    body = escape(text)
    return before + body + after, len(before), len(before) + len(body)


def parse_segment(segment: str) -> tuple[str, str]:
    """Role and text of a rendered turn."""
    for role, (before, after) in _MARKS.items():
        if segment.startswith(before) and segment.endswith(after) and len(segment) >= len(before) + len(after):
            return role, unescape(segment[len(before) : len(segment) - len(after)])
    found = _OTHER.fullmatch(segment)
    if not found:
        raise ValueError("not a rendered turn")
    return unescape(found[1]), unescape(found[2])


def parse_rendering(text: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a rendering. No mark can occur inside an escaped text, so each ends at the next one."""
    turns, at = [], 0
    while at < len(text):
        for role, (before, after) in _MARKS.items():
            if text.startswith(before, at):
                begin = at + len(before)
                break
        else:
            found = _OTHER_START.match(text, at)
            if not found:
                raise ValueError("not a rendered turn")
            role, after, begin = unescape(found[1]), "<</>>", found.end()
        end = text.find(after, begin)
        if end < 0:
            raise ValueError("an unfinished turn")
        turns.append((role, unescape(text[begin:end])))
        at = end + len(after)
    return turns


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """The examples of every conversation, and the segments that no example holds, in order within a conversation.

    Columns: conv_id, position (of the turn, from 0), kind ("example": context and reply; "segment": a turn that is no example's), piece (of
    the example, from 0), text (of the piece), chars (of the whole example), context_chars, loss_start and loss_end (in the whole example;
    the only trainable part).
    """
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("other")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kinds = {"position": LongType(), "kind": StringType(), "piece": LongType(), "text": StringType(), **{n: LongType() for n in ("chars", "context_chars", "loss_start", "loss_end")}}
    schema = StructType([rows.schema["conv_id"], *[StructField(n, k) for n, k in kinds.items()]])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        now, position, rendering, waiting = object(), 0, "", []  # waiting: segments that an example may still hold
        out: list[tuple] = []
        written = 0
        for batch in found:
            kind = batch.schema.field("conv_id").type
            for conv, who, body in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")], strict=True):
                if conv != now:
                    out += waiting
                    now, position, rendering, waiting = conv, 0, "", []
                segment, begin, end = render_turn(who, body)
                start, rendering = len(rendering), rendering + segment
                if who == "assistant":
                    waiting = []
                    for piece, at in enumerate(range(0, len(rendering), piece_chars)):
                        part = rendering[at : at + piece_chars]
                        out.append((conv, position, "example", piece, part, len(rendering), start, start + begin, start + end))
                        written += len(part)
                        if written > 1 << 20:
                            yield _rows(out, kind, schema.names)
                            out, written = [], 0
                else:
                    waiting.append((conv, position, "segment", 0, segment, None, None, None, None))
                position += 1
        out += waiting
        if out:
            yield _rows(out, kind, schema.names)

    return rows.mapInArrow(run, schema)


def _rows(rows: list[tuple], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 4]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


class _Reading:
    """What has been read back of a conversation."""

    def __init__(self):
        self.turns, self.n_turns, self.loss, self.loss_chars = hashlib.sha256(), 0, hashlib.sha256(), 0
        self.formatted, self.examples, self.last, self.pieces, self.held = 0, 0, "", [], 0

    def add(self, kind: str, piece: int, text: str, chars: int | None, context: int | None, begin: int | None, end: int | None) -> None:
        if kind == "example":
            if piece != len(self.pieces):
                raise ValueError("a piece of an example is missing")
            self.pieces.append(text)
            self.held += len(text)
            if self.held < chars:
                return
            text, self.pieces, self.held = "".join(self.pieces), [], 0
            if len(text) != chars or context < len(self.last) or not text.startswith(self.last):
                raise ValueError("an example's context is not what was read before it")
            new, self.last = text[len(self.last) :], text
            trained = unescape(text[begin:end])
            self.loss_chars += len(trained)
            self.loss.update(trained.encode("utf-8", "surrogatepass"))
            self.formatted += chars
            self.examples += 1
        else:
            new, self.last = text, self.last + text
        for role, body in parse_rendering(new):
            self.n_turns += 1
            self.turns.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))

    def row(self, conv: object) -> tuple:
        return conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted, self.examples


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its examples and segments (in the order that format_conversations leaves)."""
    kinds = {"n_turns": LongType(), "turns_sha256": StringType(), "loss_chars": LongType(), "loss_sha256": StringType(), "formatted_chars": LongType(), "n_examples": LongType()}
    schema = StructType([formatted.schema["conv_id"], *[StructField(n, k) for n, k in kinds.items()]])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, kind = None, None, None
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate([kind, *types])], schema.names)
        for batch in found:
            kind, done = batch.schema.field("conv_id").type, []
            for conv, *rest in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "kind", "piece", "text", "chars", "context_chars", "loss_start", "loss_end")], strict=True):
                if state is None or conv != now:
                    if state is not None:
                        done.append(state.row(now))
                    now, state = conv, _Reading()
                state.add(*rest)
            if done:
                yield pack(done)
        if state is not None:
            yield pack([state.row(now)])

    return formatted.mapInArrow(run, schema)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 whose texts are made of control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hostile).alias("text"))
    return materialise_small(conversation_digests(format_conversations(turns.unionByName(own))), "conversations")
