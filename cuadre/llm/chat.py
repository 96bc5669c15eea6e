"""Chat rendering with a checked grammar round trip.

A conversation renders as, for each turn, `<|im_start|>role\\ntext<|im_end|>\\n`. Inside roles and texts the
control strings must not stand: escaped, `<|` is written `<\\|`, a line break `\\n` and a backslash twice. A turn is
rendered as it is first, and escaped when the parse of the rendered turn does not give back the turn; a flag in the
turn's head (`+` after the start mark) tells the parser that it is escaped. `parse` is deterministic: it reads
from left to right and looks only at the next mark.

Turns are rendered where they lie; whole conversations are then streamed in order of turn, one turn in memory at
a time, parsed again and compared, and only their digests are kept.

Defined cases: null texts and roles are empty; turns of equal number are ordered by role and text; repeated rows are
turns of their own; rows without a conversation id form one conversation; an empty table gives no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>", "\n"
MARK = "<|"  # begins every control string
ESCAPED = "+"  # follows START in turns whose role and text are escaped
OWN_TEXT = "assistant"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace(MARK, "<\\|").replace("\n", "\\n")


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    parts, at = [], 0
    while (back := text.find("\\", at)) >= 0:
        following = text[back + 1 : back + 2]
        parts += [text[at:back], "\n" if following == "n" else following]
        at = back + 2
    parts.append(text[at:])
    return "".join(parts)


def written(role: str, text: str, escaped: bool) -> str:
    if escaped:
        return f"{START}{ESCAPED}{escape(role)}{BREAK}{escape(text)}{END}{BREAK}"
    return f"{START}{role}{BREAK}{text}{END}{BREAK}"


class GrammarError(ValueError):
    """The text is not what the grammar derives."""


def parse(rendered: str) -> Iterator[tuple[str, str, int, int]]:
    """Turns of a rendered text: role, text, and from where to where the text stands (as it is written).

    turns = { START [ESCAPED] role BREAK text END BREAK }; marks in role or text are escaped.
    """
    at = 0
    while at < len(rendered):
        if not rendered.startswith(START, at):
            raise GrammarError(f"no turn begins at {at}")
        at += len(START)
        escaped = rendered.startswith(ESCAPED, at)
        at += len(ESCAPED) if escaped else 0
        head = rendered.find(BREAK, at)
        end = rendered.find(END + BREAK, head + 1)
        if head < 0 or end < 0:
            raise GrammarError(f"the turn before {at} does not end")
        role, text = rendered[at:head], rendered[head + 1 : end]
        if not escaped and (MARK in role or MARK in text):
            raise GrammarError(f"a mark stands in the turn before {end}")
        yield (unescape(role), unescape(text), head + 1, end) if escaped else (role, text, head + 1, end)
        at = end + len(END) + len(BREAK)


def render_turn(role: str, text: str) -> str:
    """The plain form where it parses to just this turn, else the escaped one; raises if neither does."""
    for escaped in (False, True):
        rendered = written(role, text, escaped)
        try:
            if [turn[:2] for turn in parse(rendered)] == [(role, text)]:
                return rendered
        except GrammarError:
            pass
    raise GrammarError(f"the turn of {role!r} cannot be rendered")


def render(conversations: DataFrame) -> DataFrame:
    """`conversations` (conv_id, turn, role, text) with `rendered` for each turn, in order of turn within
    partitions that hold whole conversations. Joined in order, the turns of a conversation are its rendered text."""
    filled = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    fields = [(f.name, f.dataType.simpleString()) for f in filled.schema.fields]
    schema = ", ".join(f"{name} {kind}" for name, kind in [*fields, ("rendered", "string")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rendered = [render_turn(*x) for x in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rendered, pa.string())], names=[*batch.schema.names, "rendered"]
            )

    turns = filled.mapInArrow(run, schema)
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


class Reader:
    """Reads one conversation back, turn by turn."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.whole, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str, rendered: str) -> None:
        read = list(parse(rendered))
        if [turn[:2] for turn in read] != [(role, text)]:
            raise GrammarError(f"turn {self.turns} of conversation {self.conv_id} reads back as something else")
        for found_role, found_text, _, _ in read:
            self.turns += 1
            self.whole.update(f"{found_role}\n{found_text}\n".encode())
            if found_role == OWN_TEXT:
                self.loss_chars += len(found_text)
                self.loss.update(found_text.encode())
        self.chars += len(rendered)

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.whole.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
        )


def read_back(rendered: DataFrame) -> DataFrame:
    """A row for each conversation of `render`'s result, recovered from the rendered turns."""
    kind = rendered.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, rows, schema = None, [], None

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=schema)

        for batch in batches:
            schema = pa.schema(
                [("conv_id", batch.schema.field("conv_id").type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                 ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
            )
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "role", "text", "rendered"))
            for conv_id, role, text, turn in zip(*columns):
                if reader is None or reader.conv_id != conv_id:
                    if reader is not None:
                        rows.append(reader.row())
                    reader = Reader(conv_id)
                reader.add(role, text, turn)
            if len(rows) >= 1_000:
                yield full()
                rows = []
        if reader is not None:
            rows.append(reader.row())
            yield full()

    return rendered.select("conv_id", "role", "text", "rendered").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def loss_spans(rendered: str) -> list[tuple[int, int]]:
    """Where the assistant texts stand in a rendered conversation."""
    return [(start, end) for role, _, start, end in parse(rendered) if role == OWN_TEXT]
