"""Operator 4: chat formatting with a grammar round trip.

Each turn is rendered as one self-delimiting segment; a conversation's text is
its segments in order.  A deterministic parser reads rendered text back, and a
turn whose recovered content differs from its source is escaped until it does not.

Grammar: ``segment = "<s>" open "\\n" content "\\n" close "</s>\\n"`` with ``[INST]``,
``[ANS]``, ``[SYS]`` for user, assistant, system, and ``[ROLE hex]`` for any other
role name in UTF-8 hex.  A control string after backslashes is content with one
backslash less, which makes the escape (one more backslash) reversible.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the template.
TAGS = {"user": "INST", "assistant": "ANS", "system": "SYS"}
_ROLE_OF = {tag: role for role, tag in TAGS.items()}
_CONTROL = r"</?s>|\[/?(?:INST|ANS|SYS|ROLE(?: [0-9a-f]*)?)\]"
_TOKEN = re.compile(rf"(\\*)({_CONTROL})")


def escape(text: str) -> str:
    return _TOKEN.sub(r"\\\1\2", text)


def unescape(content: str) -> str:
    """Content to text: one backslash less before each control string; a bare control string is an error."""

    def less(m: re.Match) -> str:
        if not m[1]:
            raise ValueError("control string in content")
        return m[1][1:] + m[2]

    return _TOKEN.sub(less, content)


def _wrap(role: str, content: str) -> tuple[str, int]:
    tag = TAGS.get(role)
    head = f"<s>[{tag}]\n" if tag else f"<s>[ROLE {role.encode('utf-8').hex()}]\n"
    return f"{head}{content}\n[/{tag or 'ROLE'}]</s>\n", len(head)


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, content start, content end) of each turn of rendered text; ValueError when it is not in the grammar."""
    out, at = [], 0
    while at < len(text):
        controls = (m for m in _TOKEN.finditer(text, at) if not m[1])
        begin, opening = next(controls, None), next(controls, None)
        if begin is None or opening is None or begin[2] != "<s>" or begin.start() != at or opening.start() != begin.end():
            raise ValueError(f"no segment at {at}")
        tag = opening[2][1:-1]
        name, _, code = tag.partition(" ")
        closing, finish = next(controls, None), next(controls, None)
        if closing is None or finish is None or closing[2] != f"[/{name}]" or finish[2] != "</s>" or finish.start() != closing.end():
            raise ValueError(f"segment at {at} does not close")
        low, high = opening.end() + 1, closing.start() - 1
        if high < low or text[low - 1] != "\n" or text[high] != "\n" or text[finish.end() : finish.end() + 1] != "\n":
            raise ValueError(f"segment at {at} has no line ends")
        role = _ROLE_OF.get(name) if name != "ROLE" else bytes.fromhex(code).decode("utf-8")
        if role is None:
            raise ValueError(f"unknown role at {at}")
        out.append((role, unescape(text[low:high]), low, high))
        at = finish.end() + 1
    return out


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """(segment, content start, content end); reparsed, and escaped until the recovered turn is identical."""
    content = text
    for _ in range(2):
        segment, low = _wrap(role, content)
        try:
            turns = parse(segment)
        except ValueError:
            turns = []
        if [t[:2] for t in turns] == [(role, text)]:
            return segment, low, low + len(content)
        content = escape(text)
    raise ValueError("a turn does not survive the round trip")


def render(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, segment, loss_start, loss_end): one segment per row; the span is the assistant's content, else null.

    Null text and null role count as empty, texts of any length are one segment;
    repeated rows and equal turns repeat their segments, null ids are rendered as
    others, extra columns are not read, an empty table gives an empty result.  No
    shuffle is needed, since segments are self-delimiting.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments, low, high = [], [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                segment, a, b = render_turn(role or "", text or "")
                segments.append(segment)
                low.append(a if role == "assistant" else None)
                high.append(b if role == "assistant" else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(segments, pa.string()), pa.array(low, pa.int64()), pa.array(high, pa.int64())],
                names=[conv_col, turn_col, "segment", "loss_start", "loss_end"],
            )

    kinds = conversations.schema
    schema = f"`{conv_col}` {kinds[conv_col].dataType.simpleString()}, `{turn_col}` {kinds[turn_col].dataType.simpleString()}, segment string, loss_start bigint, loss_end bigint"
    return conversations.select(conv_col, turn_col, role_col, text_col).mapInArrow(run, schema)


def read_back(rendered: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), all read from the rendered text.

    Rows of a conversation are taken by ascending turn (null first), ties by
    segment, repeated rows as often as they come; rows with a null id are one
    conversation.  Sorted rows stream through running digests, so that a
    conversation of any length needs the memory of one batch.  No rows give no
    result; extra columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None

        def emit(rows: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], kind),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2].hexdigest() for r in rows], pa.string()),
                    pa.array([r[3] for r in rows], pa.int64()),
                    pa.array([r[4].hexdigest() for r in rows], pa.string()),
                    pa.array([r[5] for r in rows], pa.int64()),
                ],
                names=[conv_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

        kind = pa.int64()
        for batch in batches:
            kind = batch.schema.field(0).type
            done = []
            for conv, segment, low, high in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4)), strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append(now)
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in parse(segment):
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                if low is not None:
                    text = unescape(segment[low:high])
                    now[3] += len(text)
                    now[4].update(text.encode("utf-8"))
                now[5] += len(segment)
            if done:
                yield emit(done)
        if now is not None:
            yield emit([now])

    conv_kind = rendered.schema[conv_col].dataType.simpleString()
    schema = f"`{conv_col}` {conv_kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    rows = rendered.select(conv_col, turn_col, "segment", "loss_start", "loss_end")
    return rows.repartition(F.col(conv_col)).sortWithinPartitions(conv_col, turn_col, "segment").mapInArrow(run, schema)
