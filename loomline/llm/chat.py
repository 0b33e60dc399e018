"""Chat formatting by event-sourced reconstruction.

A log row is an event of a conversation: (conv_id, seq, kind, message, role, text).

* message     starts a message with a role and a first text
* delta       appends text to a message
* edit        replaces a message's text (and its role, when one is given)
* regenerate  takes a message and all after it away and starts it anew
* delete      takes one message away

Logs are partitioned by conversation and sorted by sequence; a fold over the sorted rows holds one
conversation at a time. Its messages are rendered by a template whose control strings can't arise from
texts, with the spans that carry loss (the assistant's texts).

Template of a turn: "### ", role, ": ", text, "</turn>", newline. In roles and texts a backslash goes
before each backslash, "#" and "<"; in roles before ":" too. So "### " and "</turn>" with no backslash before
are always control strings, and unescaping is dropping the backslash.

Defined results: null or empty texts and roles are empty; a null kind is "message"; a null message id
names the message of that event's seq; events for unknown messages start one; ties of seq go by kind, message,
role and text; a conversation whose messages are all gone renders as "" with no turns; a null conv_id is a
conversation of its own; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import rows_to_batches

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
_TEXT, _ROLE, _BACK = re.compile(r"([\\#<])"), re.compile(r"([\\#<:])"), re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\#<:]|\\.)*): ((?:[^\\#<]|\\.)*)</turn>\n", re.DOTALL)

RENDERED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("loss_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    ]
)


def escape(text: str) -> str:
    return _TEXT.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


def render(messages: list[tuple[str, str]], loss_roles: frozenset[str]) -> tuple[str, list[dict[str, int]]]:
    """The formatted text and the code point spans under loss."""
    parts, spans, at = [], [], 0
    for role, text in messages:
        head, body = OPEN + _ROLE.sub(r"\\\1", role) + MIDDLE, escape(text)
        if role in loss_roles:
            spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation; an error if it isn't one."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def fold(events: Iterator[tuple]) -> list[tuple[str, str]]:
    """Final (role, text) messages of one conversation from its events in order."""
    messages: dict[object, list] = {}
    for seq, kind, message, role, text in events:
        key = ("seq", seq) if message is None else ("id", message)
        if kind == "delta" and key in messages:
            messages[key][1].append(text)
        elif kind == "edit" and key in messages:
            messages[key] = [role or messages[key][0], [text]]
        elif kind == "delete":
            messages.pop(key, None)
        elif kind == "regenerate":
            names = list(messages)
            old = messages.get(key)
            for name in names[names.index(key) :] if key in messages else ():
                del messages[name]
            messages[key] = [role or (old[0] if old else ""), [text]]
        else:
            while key in messages:  # a second message of the same seq is a message of its own
                key = (*key, "again")
            messages[key] = [role, [text]]
    return [(role, "".join(texts)) for role, texts in messages.values()]


def format_conversations(log: DataFrame, loss_roles: tuple[str, ...] = ("assistant",), partitions: int | None = None) -> DataFrame:
    """Final formatted text of each conversation of an event log, with its loss spans."""
    cols = {c: F.col(c) if c in log.columns else F.lit(None) for c in ("conv_id", "seq", "kind", "message", "role", "text")}
    events = log.select(
        cols["conv_id"].cast("long").alias("conv_id"),
        cols["seq"].cast("long").alias("seq"),
        F.coalesce(cols["kind"].cast("string"), F.lit("message")).alias("kind"),
        cols["message"].cast("string").alias("message"),
        F.coalesce(cols["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(cols["text"].cast("string"), F.lit("")).alias("text"),
    )
    by = events.repartition(partitions, "conv_id") if partitions else events.repartition("conv_id")
    ordered = by.sortWithinPartitions("conv_id", "seq", "kind", "message", "role", "text")
    roles = frozenset(loss_roles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held, current = [], None
            for batch in batches:
                for conv, *event in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if held and conv != current:
                        yield done(current, held)
                        held = []
                    current = conv
                    held.append(event)
            if held:
                yield done(current, held)

        def done(conv, held):
            messages = fold(iter(held))
            formatted, spans = render(messages, roles)
            return conv, len(messages), formatted, spans

        yield from rows_to_batches(rows(), RENDERED, 64)

    return ordered.mapInArrow(run, RENDERED)


def read_back(rendered: DataFrame) -> DataFrame:
    """Digests made only from the formatted texts and their spans: turns, loss and length."""
    import hashlib

    schema = T.StructType(
        [
            T.StructField("conv_id", T.LongType()),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for conv, formatted, spans in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                    turns = parse(formatted)
                    said = "".join(f"{role}\n{text}\n" for role, text in turns)
                    loss = "".join(unescape(formatted[s["start"] : s["end"]]) for s in spans)
                    yield conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)

        yield from rows_to_batches(rows(), schema)

    return rendered.select("conv_id", "formatted", "loss_spans").mapInArrow(run, schema)
