"""Chat formatting from event logs: fold deltas, edits and regenerations into messages, then render."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempestry.llm.common import batches_of, rows_of

#: Marks of the template, and further strings that other templates read as control (fixed values).
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CONTROLS = (OPEN, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

#: Code points of one delta in the log that ``events_of_rows`` writes.
DELTA = 512
#: Code points of a superseded draft in that log, at most.
DRAFT = 32
#: Most messages of one rendered piece of a conversation.
PIECE_TURNS, PIECE_CHARS = 64, 1 << 20

_guard = re.compile(r"\\|(?=" + "|".join(map(re.escape, CONTROLS)) + ").", re.DOTALL)

EVENTS = "conv_id long, message long, seq long, kind string, role string, text string"
PIECES = "conv_id long, piece long, formatted string, loss array<struct<start:long,end:long>>"


def escape(text: str) -> str:
    """The text without any control string, reversibly.

    A backslash becomes two; a control string gets one after its first
    character, also where two overlap. No control string can be left, as each
    would begin at a guarded character.
    """
    return _guard.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    out, at = [], 0
    while (found := text.find("\\", at)) >= 0:
        # "\\" follows a character of a control string, or another backslash.
        if text.startswith("\\\\", found):
            out.append(text[at : found + 1])
            at = found + 2
        else:
            out.append(text[at:found])
            at = found + 1
    out.append(text[at:])
    return "".join(out)


def fold(messages: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted events to final messages: (conv_id, message, role, text).

    Events are sorted by conversation, message and sequence, so one message is
    held at a time. Of a conversation only one number is carried on: the last
    sequence at which an earlier message was regenerated, which takes away
    every later message's events before it.
    """
    held: list = []  # conv_id, message, role, parts
    conv, cut = object(), -1

    def closed():
        if held and held[3] is not None:
            yield held[0], held[1], held[2], "".join(held[3])

    last_cut = -1
    for conv_id, message, seq, kind, role, text in messages:
        if conv_id != conv:
            yield from closed()
            held, conv, cut, last_cut = [], conv_id, -1, -1
        elif held and held[1] != message:
            yield from closed()
            held, cut = [], last_cut
        if not held:
            held = [conv_id, message, "", None]
        if seq < cut:
            continue
        if kind == "delete":
            held[3] = None
            continue
        if kind == "regenerate":
            last_cut = max(last_cut, seq)
        if kind != "delta" or held[3] is None:
            held[3] = []
        if role is not None:
            held[2] = role
        held[3].append(text or "")
    yield from closed()


def render(role: str, text: str) -> tuple[str, int, int]:
    """A message in the template, and where its escaped text begins and ends."""
    head = f"{OPEN}{escape(role).replace(chr(10), chr(92) + 'n')}\n"
    body = escape(text)
    return f"{head}{body}{CLOSE}\n", len(head), len(head) + len(body)


def _role_of(head: str) -> str:
    out, at = [], 0
    while at < len(head):
        if head.startswith("\\n", at):
            out.append("\n")
            at += 2
        else:
            step = 2 if head.startswith("\\\\", at) else 1
            out.append(head[at : at + step])
            at += step
    return unescape("".join(out))


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of each message of a formatted piece."""
    for part in formatted.split(f"{CLOSE}\n")[:-1]:
        head, _, body = part[len(OPEN) :].partition("\n")
        yield _role_of(head), unescape(body)


def _pieces(messages: Iterator[tuple], loss_roles: frozenset[str]) -> Iterator[tuple]:
    conv, number, parts, size, spans = object(), 0, [], 0, []
    for conv_id, _, role, text in messages:
        if conv_id != conv or len(parts) >= PIECE_TURNS or size >= PIECE_CHARS:
            if parts:
                yield conv, number, "".join(parts), spans
                number += 1
            if conv_id != conv:
                conv, number = conv_id, 0
            parts, size, spans = [], 0, []
        line, start, end = render(role, text)
        if role in loss_roles:
            spans.append({"start": size + start, "end": size + end})
        parts.append(line)
        size += len(line)
    if parts:
        yield conv, number, "".join(parts), spans


def format_log(events: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Conversations of an event log, in the template, with their loss mask.

    ``events`` has the columns of ``EVENTS``. ``message`` is the place of a
    message in its conversation, ``seq`` orders the events. Kinds: ``message``
    and ``edit`` set the text, ``delta`` appends to it, ``regenerate`` empties
    it (and sets the text if there is one) and takes away what later messages
    had by then, ``delete`` removes the message.

    Returns ``conv_id, piece, formatted, loss``: a conversation is the pieces in
    order, one after the other; ``loss`` has the spans, in code points of the
    piece, of the escaped text of messages in ``loss_roles``. Pieces keep a
    conversation of any length in bounded memory: the log is dealt out by
    conversation and streamed in the order of (message, seq).

    Null roles and texts are empty; a null conversation is one of its own; null places and
    sequences come first, as -1. Events equal in place and sequence follow the order of
    kind, role and text. An empty log gives no rows; other columns are ignored.
    """
    wanted = frozenset(loss_roles)
    columns = [c.split()[0] for c in EVENTS.split(", ")]
    ordered = (
        events.select(*columns)
        .withColumns({c: F.coalesce(c, F.lit(-1).cast("long")) for c in ("message", "seq")})
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "message", "seq", "kind", "role", "text")
    )

    span = pa.struct({"start": pa.int64(), "end": pa.int64()})
    schema = pa.schema({"conv_id": pa.int64(), "piece": pa.int64(), "formatted": pa.string(), "loss": pa.list_(span)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(_pieces(fold(rows_of(batches)), wanted), schema)

    return ordered.mapInArrow(run, PIECES)


def events_of_rows(rows: DataFrame, delta: int = DELTA) -> DataFrame:
    """An event log of a table of messages (``conv_id, turn, role, text``).

    Rows of a conversation take their places by turn, then role and text, so
    that rows repeated with one turn are messages of their own. The log has a
    history that folds back to the rows. An assistant's message opens with a
    draft, which the next message answers; then it is regenerated, which takes
    away both, and its text is streamed as deltas of ``delta`` code points.
    Other messages are a draft that is edited, and a further message, which
    has an odd place, is deleted.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    text = F.coalesce("text", F.lit(""))
    draft = F.concat(F.lit("draft "), F.substring(text, 1, DRAFT))
    length = F.greatest(F.length(text), F.lit(1))
    none = F.lit(None).cast("string")

    def event(kind: str, value: Column, ahead: int = 0) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("text"), F.lit(ahead).alias("ahead"))

    deltas = F.transform(
        F.sequence(F.lit(0), F.floor((length - 1) / delta).cast("int")),
        lambda k: event("delta", F.substring(text, k * delta + 1, F.lit(delta))),
    )
    # Places are even, so a message 2 ahead is the next one.
    before = F.array(event("message", none), event("delta", draft), event("message", draft, 2), event("regenerate", none))
    edited = F.array(event("message", draft), event("edit", text), event("message", draft, 1), event("delete", none, 1))
    events = F.when(F.col("role") == "assistant", F.concat(before, deltas)).otherwise(edited)
    placed = rows.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("number"))
    return placed.select("conv_id", "number", "role", F.posexplode(events).alias("step", "event")).select(
        "conv_id",
        (F.col("number") * 2 + F.col("event.ahead")).alias("message"),
        (F.col("number") * (1 << 32) + F.col("step")).alias("seq"),
        "event.kind",
        F.coalesce("role", F.lit("")).alias("role"),
        "event.text",
    )


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of what a reader of the formatted conversations gets, one row per conversation.

    ``conv_id, n_turns, turns_sha256`` (role, line feed, text, line feed of
    each turn), ``loss_chars, loss_sha256`` (all text under the loss mask),
    ``formatted_chars``. Pieces are streamed in order into the digests.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        conv, state = object(), None
        for conv_id, _, formatted, loss in rows_of(batches):
            if conv_id != conv:
                if state:
                    yield conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]
                conv, state = conv_id, [0, sha256(), 0, sha256(), 0]
            for role, text in parse(formatted):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for span in loss:
                text = unescape(formatted[span["start"] : span["end"]])
                state[2] += len(text)
                state[3].update(text.encode("utf-8", "surrogatepass"))
            state[4] += len(formatted)
        if state:
            yield conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    schema = pa.schema(
        {
            "conv_id": pa.int64(),
            "n_turns": pa.int64(),
            "turns_sha256": pa.string(),
            "loss_chars": pa.int64(),
            "loss_sha256": pa.string(),
            "formatted_chars": pa.int64(),
        }
    )
    names = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(digests(batches), schema)

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(run, names)


def control_sample(spark: SparkSession) -> DataFrame:
    """Conversation -1: a user and an assistant row that both say control strings."""
    text = "</s>[INST] ok [/INST]"
    return spark.createDataFrame(
        [(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string"
    )
