"""Chat formatting by event-sourced reconstruction.

Input is a log of events, one row each: conversation, message (place in the
conversation), seq (order of events), kind, role, text. Kinds:

* ``start``: opens a message with a role and a first text;
* ``delta``: appends streamed text to the message;
* ``edit``: replaces the message's text;
* ``regenerate``: empties the message, to be streamed anew, and drops all later messages
  as they were up to then.

The log is partitioned by conversation, sorted by (message, seq) and folded in one pass
that holds a single message: an event is dead if an earlier message was regenerated
after it, which takes one running number to know. Messages are rendered one row each, so
neither a log nor a formatted conversation is ever held whole; a conversation is read in
order by one task, as its digests require.

The template is ``<|start|>role<|message|>text<|end|>`` and a line end. Control strings (its
own and those of other common templates) inside roles and texts are written as a
backslash and a letter, a backslash as ``\\0``; this is undone exactly on reading.
The loss mask of a message is the span of an assistant's text.

Defined results: null text and null role count as empty; rows of one conversation with
the same place are messages of their own, ordered by role and text; a null conversation
or place sorts first, null ids being one conversation; repeated rows are repeated turns;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared
from .common import table

# FIXED VALUES: the template and the strings that may not occur inside a text.
START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>\n"
CONTROLS = ["<|start|>", "<|message|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
            "<|im_start|>", "<|im_end|>", "<|endoftext|>"]

_TO = {"\\": "\\0", **{c: "\\" + chr(ord("A") + i) for i, c in enumerate(CONTROLS)}}
_FROM = {v: k for k, v in _TO.items()}
_FIND = re.compile("|".join(map(re.escape, _TO)))
_BACK = re.compile(r"\\[0A-Z]")


def escape(text: str) -> str:
    return _FIND.sub(lambda m: _TO[m[0]], text)


def unescape(text: str) -> str:
    return _BACK.sub(lambda m: _FROM[m[0]], text)


def render(role: str, text: str) -> tuple[str, int | None, int | None]:
    """(formatted message, loss span in its code points or None)."""
    head = f"{START}{escape(role)}{MESSAGE}"
    body = escape(text)
    span = (len(head), len(head) + len(body)) if role == "assistant" else (None, None)
    return f"{head}{body}{END}", *span


def parse(formatted: str) -> tuple[str, str]:
    """(role, text) of one formatted message."""
    role, _, body = formatted.removeprefix(START).partition(MESSAGE)
    return unescape(role), unescape(body[:-len(END)])


EVENTS = "conv_id long, message long, seq long, kind string, role string, text string"
FORMATTED = "conv_id long, no long, formatted string, loss_start int, loss_end int"


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]):
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in names])


def fold(events) -> Iterator[tuple]:
    """(conversation, role, text) of the final messages, from events sorted by
    (conversation, message, seq)."""
    none = object()
    conv = message = none
    cut = next_cut = None  # seq of the latest regeneration of an earlier message (or this one)
    role, parts = None, None  # the open message

    for c, m, seq, kind, r, text in events:
        if c != conv or m != message or kind == "start":
            if parts is not None:
                yield conv, role, "".join(parts)
            parts = None
            if c != conv:
                next_cut = None
            if c != conv or m != message:
                cut = next_cut
            conv, message = c, m
        if cut is not None and (seq is None or seq < cut):
            continue
        if kind == "regenerate":
            parts, role = [], r or role or ""
            next_cut = seq if next_cut is None else max(next_cut, seq)
        elif kind == "edit":
            parts, role = [text or ""], r or role or ""
        elif parts is None or kind == "start":
            parts, role = [text or ""], r or ""
        else:
            parts.append(text or "")
    if parts is not None:
        yield conv, role, "".join(parts)


def format_chats(events: DataFrame) -> DataFrame:
    """One row a final message: (conv_id, no, formatted, loss_start, loss_end)."""
    names = ["conv_id", "message", "seq", "kind", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        last, no, size = None, 0, 0
        for conv, role, text in fold(_rows(batches, names)):
            no = no + 1 if (conv,) == last else 0
            last = (conv,)
            out.append((conv, no, *render(role or "", text)))
            size += len(text)
            if len(out) == 5000 or size > 1 << 22:
                yield _batch(out)
                out, size = [], 0
        yield _batch(out)

    def _batch(out):
        cols = list(zip(*out)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=["conv_id", "no", "formatted", "loss_start", "loss_end"])

    dealt = events.select(*names).repartition("conv_id").sortWithinPartitions(
        "conv_id", "message", "seq", F.col("kind") != "start", "role", "text")
    return dealt.mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row a conversation, from its formatted messages: digests of the turns and of
    the text under the loss mask. A running hash holds a conversation of any length."""
    names = ["conv_id", "formatted", "loss_start", "loss_end"]
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        last = None
        n = chars = total = 0
        turns, loss = hashlib.sha256(), hashlib.sha256()

        def close():
            out.append((last[0], n, turns.hexdigest(), chars, loss.hexdigest(), total))

        for conv, text, a, b in _rows(batches, names):
            if (conv,) != last:
                if last is not None:
                    close()
                last, n, chars, total = (conv,), 0, 0, 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            role, body = parse(text)
            n, total = n + 1, total + len(text)
            turns.update(f"{role}\n{body}\n".encode())
            if a is not None:
                under = unescape(text[a:b])
                chars += len(under)
                loss.update(under.encode())
            if len(out) >= 5000:
                yield _batch(out)
                out.clear()
        if last is not None:
            close()
        yield _batch(out)

    def _batch(out):
        cols = list(zip(*out)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=[f.split()[0] for f in schema.split(", ")])

    dealt = formatted.select("no", *names).repartition("conv_id").sortWithinPartitions("conv_id", "no")
    return dealt.select(*names).mapInArrow(run, schema)


def events_of(conversations: DataFrame) -> DataFrame:
    """A table of finished turns as a log: every row starts a message."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("message"),
        F.lit(0).cast("long").alias("seq"), F.lit("start").alias("kind"), "role", "text")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return read_back(shared(format_chats(events_of(rows)), "formatted_chats"))


QUERIES = {"op2_chat": op2_chat}
ORACLE: dict[str, str] = {}
