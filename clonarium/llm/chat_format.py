"""Chat formatting from an event log (operator 4).

A conversation is a log of events with a sequence number: ``message`` opens a turn, ``delta``
adds streamed text to it, ``edit`` replaces its text, ``regenerate`` drops its text so that
following deltas write it anew, and ``delete`` removes it. Logs are dealt by conversation, those of
more than STRETCH turns in stretches of so many, and sorted by turn and sequence; each turn is folded
while it streams past, so neither a conversation nor a group of them is ever held whole. The
folded turns are rendered one by one; a conversation's text is its turns' texts in order.

Template: ``[INST]`` text ``[/INST]`` for the user, ``<s>`` text ``</s>`` for the assistant,
``<<SYS>>`` text ``<</SYS>>`` for the system, ``[ROLE name]`` text ``[/ROLE]`` for others.
Control strings inside texts and names get a backslash after their first character, and one
more if they have some already, so that they can be told from marks and be restored exactly.

Null text counts as empty and a null role as the empty name. Turns with one number are ordered
by role, then text, and repeated rows are turns of their own. A conversation without turns has
no output. Events before a turn's ``message`` belong to it all the same; a turn without one has
the role of its first event. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clonarium.llm.common import spread

MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
# What follows the first character of a control string; escaped ones have backslashes between.
_REST = r"(?=/?INST\]|/?s>|</?SYS>>|ROLE |/ROLE\])"
_PLAIN = re.compile(r"([<\[])(\\*)" + _REST)
_ESCAPED = re.compile(r"([<\[])\\(\\*)" + _REST)
_OPEN = re.compile(r"\[INST\]|<s>|<<SYS>>|\[ROLE ((?:[^\]\\]|\\.)*)\]", re.DOTALL)
_CLOSE = {"[INST]": "[/INST]", "<s>": "</s>", "<<SYS>>": "<</SYS>>"}

TURN_SCHEMA = "conv_id long, turn long, place long, formatted string, loss_start long, loss_end long"
DELTA_CHARS, STRETCH = 512, 128


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def _name(role: str) -> str:
    return re.sub(r"([\\\]])", r"\\\1", escape(role))


def _role(name: str) -> str:
    return unescape(re.sub(r"\\([\\\]])", r"\1", name))


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's text in the template, and the span of it that is trained on."""
    before, after = MARKS.get(role) or (f"[ROLE {_name(role)}]", "[/ROLE]")
    body = escape(text)
    trained = len(body) if role == "assistant" else 0
    return before + body + after, len(before), len(before) + trained


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    roles = {marks[0]: role for role, marks in MARKS.items()}
    at = 0
    while at < len(formatted):
        opening = _OPEN.match(formatted, at)
        if not opening:
            raise ValueError(f"no turn begins at {at}")
        close = _CLOSE.get(opening.group(), "[/ROLE]")
        end = formatted.find(close, opening.end())
        if end < 0:
            raise ValueError(f"the turn at {at} does not end")
        role = roles.get(opening.group())
        yield _role(opening.group(1)) if role is None else role, unescape(formatted[opening.end() : end])
        at = end + len(close)


def fold(events: Iterable[tuple[str, str, str]]) -> tuple[str, str] | None:
    """The final (role, text) of one turn from its (kind, role, text) in order; None if deleted."""
    role, parts, alive = None, [], False
    for kind, by, text in events:
        if kind == "message":
            role, parts, alive = by, [text], True
        elif kind == "delta":
            parts.append(text)
            alive = True
        elif kind == "edit":
            parts, alive = [text], True
        elif kind == "regenerate":
            parts, alive = [], True
        elif kind == "delete":
            parts, alive = [], False
        else:
            raise ValueError(f"unknown event {kind}")
        role = by if role is None else role
    return (role, "".join(parts)) if alive else None


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` by conversation and ``stretch`` of turns."""
    rows = rows.withColumn("stretch", F.expr(f"turn div {STRETCH}"))
    return spread(rows, "conv_id", "stretch")


def message_events(conversations: DataFrame) -> DataFrame:
    """A log that ends in the given turns, dealt as ``format_turns`` wants it.

    (conv_id, turn, place, seq, kind, role, text); ``place`` tells turns of one number apart. Turns
    are streamed in pieces of DELTA_CHARS. By a hash of its place each is written at once, or after
    a draft: regenerated, edited, or deleted and sent again; after some a further turn was deleted
    for good.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # One shuffle serves the window, the explosion and the fold.
    one_number = Window.partitionBy("conv_id", "stretch", "turn").orderBy("role", "text")
    placed = _dealt(rows).withColumn("place", F.row_number().over(one_number).cast("long"))

    def event(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    nothing, draft = F.lit(""), F.reverse(F.substring("text", 1, 64))
    pieces = F.ceil(F.length("text") / DELTA_CHARS).cast("int")
    begin = F.when(pieces > 0, F.sequence(F.lit(0), pieces - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    deltas = F.transform(begin, lambda i: event("delta", F.substr("text", i * DELTA_CHARS + 1, F.lit(DELTA_CHARS))))
    begun = [event("message", draft), event("delta", draft)]
    histories = [
        F.concat(F.array(event("message", nothing)), deltas),
        F.concat(F.array(*begun, event("regenerate", nothing)), deltas),
        F.array(*begun, event("edit", F.col("text"))),
        F.concat(F.array(*begun, event("delete", nothing), event("message", nothing)), deltas),
    ]
    mark = F.pmod(F.xxhash64("conv_id", "turn", "place"), F.lit(8))
    history = F.when(mark % 4 == 0, histories[0]).when(mark % 4 == 1, histories[1]).when(mark % 4 == 2, histories[2]).otherwise(histories[3])
    gone = F.struct((-F.col("place")).alias("place"), F.array(*begun, event("delete", nothing)).alias("events"))
    own = F.struct("place", history.alias("events"))
    logs = placed.select("conv_id", "turn", "role", F.explode(F.when(mark == 5, F.array(own, gone)).otherwise(F.array(own))).alias("log"))
    events = logs.select("conv_id", "turn", "log.place", "role", F.posexplode("log.events").alias("seq", "e"))
    return events.select("conv_id", "turn", "place", "seq", "e.kind", "role", "e.text")


_TURN = ("conv_id", "turn", "place")


def format_turns(events: DataFrame, dealt: bool = False) -> DataFrame:
    """Every turn that is left, folded and rendered, with the span of its text under the loss.

    A turn's events must lie in one partition: if they do already, the log is ``dealt``.
    """

    def stream(batches) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in (*_TURN, "kind", "role", "text")), strict=True)

    def rendered(batches) -> Iterator[pa.RecordBatch]:
        held, name, log = [], None, []

        def close() -> None:
            if log and (done := fold(log)):
                held.append((*name, *render(*done)))

        for row in stream(batches):
            if row[:3] != name:
                close()
                name, log = row[:3], []
                if len(held) >= 1000:
                    yield _batch(held, TURN_SCHEMA)
                    held = []
            log.append(row[3:])
        close()
        if held:
            yield _batch(held, TURN_SCHEMA)

    placed = events if dealt else _dealt(events)
    return placed.sortWithinPartitions(*_TURN, "seq").mapInArrow(rendered, TURN_SCHEMA)


_KINDS = {"long": pa.int64(), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(",")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)],
        names=[name for name, _ in fields],
    )


DIGEST_SCHEMA = """conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,
                   formatted_chars long"""


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its formatted text turn by turn."""

    def digests(batches) -> Iterator[pa.RecordBatch]:
        rows, name, state = [], None, None

        def close() -> None:
            if state:
                rows.append((name, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            columns = ("conv_id", "formatted", "loss_start", "loss_end")
            for conv, text, begin, end in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if state is None or conv != name:
                    close()
                    name, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                loss = unescape(text[begin:end])
                state[2] += len(loss)
                state[3].update(loss.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
            if len(rows) >= 1000:
                yield _batch(rows, DIGEST_SCHEMA)
                rows.clear()
        close()
        if rows:
            yield _batch(rows, DIGEST_SCHEMA)

    order = ("conv_id", "turn", "place")
    return spread(turns, "conv_id").sortWithinPartitions(*order).mapInArrow(digests, DIGEST_SCHEMA)
