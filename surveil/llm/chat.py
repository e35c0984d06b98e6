"""Chat formatting: a finite-state machine over roles, and a declarative template."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What stands around a turn's text, which roles bear loss, and which role may follow which.

    ``headers`` and ``end`` are the control strings. Inside a text, a backslash before a control
    string's first character and before any backslash escapes it.
    """

    headers: dict[str, str] = field(default_factory=lambda: {
        "system": "### System: ", "user": "### User: ", "assistant": "### Assistant: ",
    })
    other: str = "### Other: "  # roles without a header; the role is part of the text
    end: str = "</turn>"
    separator: str = "\n"
    loss: tuple[str, ...] = ("assistant",)
    start: str = "start"
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    final: tuple[str, ...] = ("assistant",)

    def controls(self) -> list[str]:
        return sorted({*self.headers.values(), self.other, self.end}, key=lambda c: (-len(c), c))

    def escape(self, text: str) -> str:
        marks = "|".join(map(re.escape, ["\\", *self.controls()]))
        return re.sub(marks, lambda m: "\\" + m[0], text)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)

    def segments(self, role: str | None, text: str | None) -> list[tuple[str, bool]]:
        """The turn's (text, loss) segments: mark, text, end."""
        head = self.headers.get(role)
        body = self.escape(text or "")
        if head is None:  # the role's length says where the text begins
            head = f"{self.other}{len(role or '')} {self.escape(role or '')} "
        return [(head, False), (body, role in self.loss), (self.end + self.separator, False)]

    def parse(self, formatted: str) -> list[tuple[str, str, int, int]]:
        """(role, text, begin, end) of each turn in a formatted string; begin and end bound its text there."""
        heads = {v: k for k, v in self.headers.items()}
        mark = re.compile("|".join([r"\\.", *map(re.escape, self.controls())]), re.S)
        turns, at = [], 0
        while at < len(formatted):
            head = next((h for h in [*heads, self.other] if formatted.startswith(h, at)), None)
            if head is None:
                raise ValueError(f"no turn begins at {at}")
            begin = at = at + len(head)
            while (m := mark.search(formatted, at)) and m[0] != self.end:
                if m[0][0] != "\\":
                    raise ValueError(f"a control string inside a text at {m.start()}")
                at = m.end()
            if not m or not formatted.startswith(self.separator, m.end()):
                raise ValueError("a turn has no end")
            role, text = heads.get(head), self.unescape(formatted[begin : m.start()])
            if role is None:
                n, _, text = text.partition(" ")
                role, text = text[: int(n)], text[int(n) + 1 :]
            turns.append((role, text, begin, m.start()))
            at = m.end() + len(self.separator)
        return turns


FORMATTED = "{conv} {kind}, turn_no long, role string, segments array<struct<text:string,loss:boolean>>, valid boolean, state string"


def format_turns(
    turns: DataFrame, template: Template | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per turn, in order inside its partition: conv_id, turn_no (from 0), role, segments, valid, state.

    The machine starts anew at each conversation; ``valid`` says whether every turn so far was allowed
    by ``Template.follows``, ``state`` is the role it is in. Wrong orders are told, not mended, and
    nothing is dropped. A conversation ends well if its last row is valid and in a final state.

    Rows are dealt by conversation and stream through sorted, one turn in memory at a time, however
    long a conversation is. Turns with equal numbers are ordered by role and text; null turn numbers
    come first. A null text is empty, a null role is a role without a name, rows with a null
    conversation form one conversation. Other columns are not read.
    """
    template = template or Template()
    kind = turns.schema[conv].dataType.simpleString()
    rows = turns.select(F.col(conv), F.col(turn), F.col(role), F.col(text))
    rows = rows.repartition(conv).sortWithinPartitions(conv, turn, role, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, valid, number = object(), template.start, True, 0
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for c, r, t in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if c != last:
                    last, state, valid, number = c, template.start, True, 0
                valid = valid and r in template.follows.get(state, ())
                state = r if r in template.headers else "?"
                row = number, r, [{"text": s, "loss": loss} for s, loss in template.segments(r, t)], valid, state
                for col, value in zip(out, row):
                    col.append(value)
                number += 1
            types = [pa.int64(), pa.string(), pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())])), pa.bool_(), pa.string()]
            names = [conv, "turn_no", "role", "segments", "valid", "state"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, t) for v, t in zip(out, types)]], names=names)

    return rows.mapInArrow(run, FORMATTED.format(conv=f"`{conv}`", kind=kind))


DIGEST = "{conv} {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def read_back(formatted: DataFrame, template: Template | None = None, conv: str = "conv_id") -> DataFrame:
    """One row per conversation, from what ``format_turns`` put out: the turns parsed again and all text under the loss mask.

    Conversations stream as they came, by way of running digests. ``valid``: the order was right and the
    last turn may end a conversation.
    """
    template = template or Template()
    kind = formatted.schema[conv].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
        held: list = []  # the open conversation

        def close(rows: list) -> None:
            key, n, said, chars, lost, size, ok, state = held
            rows.append((key, n, said.hexdigest(), chars, lost.hexdigest(), size, ok and state in template.final))

        def batch_of(rows: list, key_type: pa.DataType) -> pa.RecordBatch:
            cols = list(zip(*rows)) or [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [key_type, *types])], names=names)

        key_type = None
        for batch in batches:
            key_type = batch.schema.field(conv).type
            done: list = []
            for row in batch.select([conv, "segments", "valid", "state"]).to_pylist():
                if not held or held[0] != row[conv]:
                    if held:
                        close(done)
                    held = [row[conv], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, True, template.start]
                text, spans = "", []
                for s in row["segments"]:
                    spans.append((len(text), len(text) + len(s["text"]), s["loss"]))
                    text += s["text"]
                for role, said, _, _ in template.parse(text):
                    held[1] += 1
                    held[2].update(f"{role}\n{said}\n".encode())
                for begin, end, loss in spans:
                    if loss:
                        plain = template.unescape(text[begin:end])
                        held[3] += len(plain)
                        held[4].update(plain.encode())
                held[5] += len(text)
                held[6], held[7] = row["valid"], row["state"]
            yield batch_of(done, key_type)
        if held:
            done = []
            close(done)
            yield batch_of(done, key_type)

    return formatted.mapInArrow(run, DIGEST.format(conv=f"`{conv}`", kind=kind))
