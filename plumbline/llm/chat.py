"""Chat formatting: a state machine over roles, a declarative template, and loss flags.

A template states the marks around a turn and the allowed order of roles.  Each turn becomes
text segments, each with a flag that says whether a model is trained on it.  Control strings
inside roles and texts are escaped, so a reader of the output gets every turn back.  Turns
are streamed through sorted partitions: a conversation of any length needs no group in
memory, and format and reading back are row by row.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

SEGMENT = "struct<text: string, loss: boolean>"


@dataclass(frozen=True)
class Template:
    """Marks of a turn, the roles trained on, and the roles that may follow each role.

    ``turn`` is written as segments: ``{role}`` and ``{text}`` stand for the escaped values.
    ``follows[""]`` are the roles that may come first, and a conversation may end after
    ``last``.  ``escape`` comes before the ``<`` of any control string and of itself.
    """

    turn: tuple[str, ...] = ("<|im_start|>", "{role}", "\n", "{text}", "<|im_end|>", "\n")
    trained: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )
    last: frozenset[str] = frozenset({"assistant"})
    escape: str = "\\"
    control: str = "<|"

    def hidden(self, value: str, more: str = "") -> str:
        """``value`` with the escape mark before escapes, control strings and ``more``."""
        value = value.replace(self.escape, self.escape * 2)
        value = value.replace(self.control, self.escape + self.control)
        return value.replace(more, self.escape + more) if more else value

    def shown(self, value: str) -> str:
        """The inverse of ``hidden``: what follows an escape mark stands for itself."""
        parts = value.split(self.escape)
        out, i = [parts[0]], 1
        while i < len(parts):
            if parts[i] or i + 1 == len(parts):
                out.append(parts[i])
                i += 1
            else:  # two marks in a row are one mark
                out.append(self.escape + parts[i + 1])
                i += 2
        return "".join(out)

    def segments(self, role: str, text: str) -> list[dict]:
        out = []
        for piece in self.turn:
            if piece == "{text}":
                out.append({"text": self.hidden(text), "loss": role in self.trained})
            else:
                out.append({"text": self.hidden(role, "\n") if piece == "{role}" else piece, "loss": False})
        return out


def format_chats(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, at, segments, in_order, ends_well`` for each row of ``rows(conv_id, turn, role, text)``.

    Turns are ordered by turn, then role and text; ``at`` counts them from 0.  ``in_order`` is
    false from the first turn on whose role may not follow the one before it; ``ends_well``
    is set on the last turn of a conversation.  A null role or text is empty; an empty role
    is not allowed anywhere.  A null turn comes first; a null conv_id is one conversation.
    Rows come out sorted within partitions that hold whole conversations.
    """
    kind = dict(rows.dtypes)["conv_id"]

    def work(batches):
        now, state, good, count, held = None, "", True, 0, None
        fresh = True
        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for conv, role, text in zip(*columns, strict=True):
                if fresh or conv != now:
                    if held is not None:
                        held["ends_well"] = good and state in template.last
                    now, state, good, count, fresh = conv, "", True, 0, False
                good = good and role in template.follows.get(state, ())
                state = role
                if held is not None:
                    out.append(held)
                held = {
                    "conv_id": conv, "at": count, "segments": template.segments(role, text),
                    "in_order": good, "ends_well": None,
                }
                count += 1
            yield pa.RecordBatch.from_pylist(out, schema)
        if held is not None:
            held["ends_well"] = good and state in template.last
            yield pa.RecordBatch.from_pylist([held], schema)

    schema = pa.schema(
        [
            ("conv_id", _arrow(rows)),
            ("at", pa.int64()),
            ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))),
            ("in_order", pa.bool_()),
            ("ends_well", pa.bool_()),
        ]
    )
    plain = rows.select(
        "conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    )
    sorted_rows = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return sorted_rows.select("conv_id", "role", "text").mapInArrow(
        work, f"conv_id {kind}, at long, segments array<{SEGMENT}>, in_order boolean, ends_well boolean"
    )


def _arrow(rows: DataFrame) -> pa.DataType:
    """The type of ``conv_id``, as Arrow has it."""
    return to_arrow_type(rows.schema["conv_id"].dataType)


def read_turns(text: str, template: Template = Template()) -> list[tuple[str, str]]:
    """The turns of a formatted text: role and text, unescaped.  Raises on any other text."""
    start, _, middle, _, *end = template.turn
    stop = "".join(end)
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(start, at):
            raise ValueError(f"no turn starts at {at}")
        split = _next(text, middle, at + len(start), template.escape)
        close = _next(text, stop, split + len(middle), template.escape)
        turns.append((template.shown(text[at + len(start) : split]), template.shown(text[split + len(middle) : close])))
        at = close + len(stop)
    return turns


def _next(text: str, mark: str, start: int, escape: str) -> int:
    """The first place of ``mark`` from ``start`` with an even number of escapes before it."""
    while (at := text.find(mark, start)) >= 0:
        before = at
        while before > 0 and text[before - 1] == escape:
            before -= 1
        if (at - before) % 2 == 0:
            return at
        start = at + 1
    raise ValueError(f"no {mark!r} after {start}")


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of each conversation, from the segments of ``format_chats`` alone.

    ``turns_sha256`` is over role, line end, text, line end of each turn; ``loss_sha256`` over
    the unescaped text under the loss mask; lengths are in code points.  ``in_order`` is true
    if all roles follow as the template allows, ``ends_well`` if the conversation may also end
    as it does.  One row per conversation; rows must come as ``format_chats`` gives them.
    """
    kind = dict(formatted.dtypes)["conv_id"]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "in_order", "ends_well"]

    def work(batches):
        now, state = None, None
        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for conv, segments, good, ends in zip(*columns, strict=True):
                if state is None or conv != now:
                    if state is not None:
                        out.append(_closed(now, state))
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, True, False]
                whole = "".join(s["text"] for s in segments)
                for role, text in read_turns(whole, template):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for s in segments:
                    if s["loss"]:
                        shown = template.shown(s["text"])
                        state[2] += len(shown)
                        state[3].update(shown.encode())
                state[4] += len(whole)
                state[5] = state[5] and good
                state[6] = bool(ends)
            yield pa.RecordBatch.from_pylist(out, schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([_closed(now, state)], schema)

    def _closed(conv, state):
        n, turns, chars, loss, size, good, ends = state
        return dict(zip(names, [conv, n, turns.hexdigest(), chars, loss.hexdigest(), size, good, ends], strict=True))

    schema = pa.schema(
        list(
            zip(
                names,
                [_arrow(formatted), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_()],
                strict=True,
            )
        )
    )
    return formatted.select("conv_id", "segments", "in_order", "ends_well").mapInArrow(
        work,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long, in_order boolean, ends_well boolean",
    )
