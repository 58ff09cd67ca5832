"""Conversations as training text, proved by reading them back.

Template of a turn: ``<|turn|>`` role newline text newline ``<|end|>`` newline. Every turn is
rendered, parsed by the same deterministic parser that reads whole conversations, and
compared with its source; only if they differ are the control strings inside it escaped (one
more backslash before each), and the result is parsed again until it is identical.
Turns are rendered one by one and conversations read back as a stream of turns, so a
conversation of any length needs no more memory than its longest turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyspark.llm.common import small_batches

START, END = "<|turn|>", "<|end|>"
#: Strings with a meaning in this template or in common others: none appears bare in a text.
CONTROL = (START, END, "<|endoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = "|".join(map(re.escape, CONTROL))
_BARE = re.compile(rf"(\\*)({_CONTROL})")
_ESCAPED = re.compile(rf"\\(\\*)({_CONTROL})")
_TOKEN = re.compile(rf"(?<!\\)(?:{_CONTROL})")
# A role is one line of its own: its line breaks, percent signs and brackets are written as codes.
_ROLE_CODES = {c: f"%{ord(c):02X}" for c in "%\n<[\\"}
_CODE = re.compile("%([0-9A-F]{2})")
MASKED_ROLE = "assistant"


def escape(text: str) -> str:
    """One more backslash before every control string: none is bare, and none is lost."""
    return _BARE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn's segment and where its text begins and ends in it."""
    head = START + "".join(_ROLE_CODES.get(c, c) for c in role) + "\n"
    body = text
    while True:
        segment = f"{head}{body}\n{END}\n"
        if parse(segment) == [(role, text)]:
            return segment, len(head), len(head) + len(body)
        if body != text:
            raise ValueError("a turn does not survive the round trip")
        body = escape(text)


def parse(formatted: str) -> list[tuple[str, str]] | None:
    """The turns of a formatted conversation, None if it does not follow the grammar."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            return None
        line = formatted.find("\n", at)
        stop = _TOKEN.search(formatted, line + 1) if line >= 0 else None
        if stop is None or stop[0] != END or stop.start() < line + 2 or formatted[stop.start() - 1] != "\n":
            return None
        if not formatted.startswith("\n", stop.end()):
            return None
        role = _CODE.sub(lambda m: chr(int(m[1], 16)), formatted[at + len(START) : line])
        turns.append((role, unescape(formatted[line + 1 : stop.start() - 1])))
        at = stop.end() + 1
    return turns


def format_turns(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, turn, role, segment, text_start, text_stop), one row per turn: the formatted text
    of a conversation is its segments in order of turn. ``text_start`` and ``text_stop`` mark the
    (escaped) text inside the segment, in code points; it is under the loss mask if ``role``
    is the assistant's.

    A null text or role is empty. Turns with equal or null numbers are ordered by role, then text,
    null numbers first; turns with a null conversation form one of their own. Repeated rows are
    turns of their own. An empty table gives no rows; other columns are ignored.
    """
    source = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 22):
            made = [render_turn(r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("conv_id", "turn", "role")]
                + [pa.array([m[0] for m in made], pa.string())]
                + [pa.array([m[i] for m in made], pa.int32()) for i in (1, 2)],
                ["conv_id", "turn", "role", "segment", "text_start", "text_stop"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    return source.mapInArrow(
        run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, segment string, text_start int, text_stop int"
    )


class _Reading:
    """What reading one conversation back has gathered so far."""

    def __init__(self) -> None:
        self.turns = self.loss_chars = self.chars = 0
        self.digest, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int, stop: int) -> None:
        parsed = parse(segment)
        if parsed is None or len(parsed) != 1:
            raise ValueError("a segment does not follow the grammar")
        role, text = parsed[0]
        self.turns += 1
        self.chars += len(segment)
        self.digest.update(f"{role}\n{text}\n".encode())
        if role == MASKED_ROLE:
            learned = unescape(segment[start:stop])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())

    def row(self) -> tuple:
        return self.turns, self.digest.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


READ_COLUMNS = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, parsed from its segments: conv_id, n_turns, turns_sha256 (of
    role, newline, text, newline per turn), loss_chars and loss_sha256 (of the text under the
    loss mask, unescaped), formatted_chars.

    The segments of a conversation pass through one task in order, one at a time: a digest over a
    whole conversation can only be taken in order, but nothing is gathered.
    """
    ordered = formatted.select(
        "conv_id", "turn", "role", "segment", "text_start", "text_stop"
    ).repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "segment")
    kind = formatted.schema["conv_id"].dataType.simpleString()
    arrow_kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, reading = None, None
        for batch in batches:
            ids, done = [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "text_start", "text_stop")))
            for conv, segment, start, stop in rows:
                if reading is None or conv != current:
                    if reading is not None:
                        ids.append(current)
                        done.append(reading.row())
                    current, reading = conv, _Reading()
                reading.add(segment, start, stop)
            id_type = batch.schema.field("conv_id").type
            yield _batch(ids, done, id_type)
        if reading is not None:
            yield _batch([current], [reading.row()], id_type)

    def _batch(ids: list, done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        columns = [pa.array([row[i] for row in done], t) for i, t in enumerate(arrow_kinds)]
        return pa.RecordBatch.from_arrays([pa.array(ids, id_type), *columns], ["conv_id", *READ_COLUMNS])

    return ordered.mapInArrow(
        run,
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
