"""Chat formatting by event-sourced reconstruction.

The log has one row per event:

    conv_id, message   conversation and place of the message in it
    seq                order of events in the conversation
    kind               open (role), delta (text goes on), edit (text replaces
                       what there is), regenerate (the message starts anew;
                       what the conversation said after it until then is void)
                       or whole (a finished message, one for each such event)
    role, text

Events are sorted by conversation, message and sequence and folded into final
messages in one streaming pass that holds one message.  A conversation is
split into blocks of ``BLOCK`` messages, which are folded in different tasks;
the only thing a block needs from earlier ones is the last regeneration, a
number.

Each final message is rendered as ``<turn:ROLE>TEXT</turn>\\n``.  Inside role
and text ``\\``, ``<`` and ``>`` are written ``\\\\``, ``\\l`` and ``\\g``, so no
text can contain a mark, and reading back restores it exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadflow.session import scratch_path

BLOCK = 4096            # messages folded by one task at a time
LOSS_ROLE = "assistant"

_ESCAPES = {"\\": "\\\\", "<": "\\l", ">": "\\g"}
_PLAIN = {"\\": "\\", "l": "<", "g": ">"}
_TURN = re.compile(r"<turn:([^<>]*)>([^<>]*)</turn>\n")


def escape(s: str) -> str:
    return re.sub(r"[\\<>]", lambda m: _ESCAPES[m[0]], s)


def unescape(s: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], s, flags=re.S)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted message and its loss span (start = end: no loss)."""
    head = f"<turn:{escape(role)}>"
    body = escape(text)
    end = len(head) + len(body) if role == LOSS_ROLE else len(head)
    return f"{head}{body}</turn>\n", len(head), end


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each message in formatted text."""
    return [(unescape(a), unescape(b)) for a, b in _TURN.findall(formatted)]


# ---- fold -------------------------------------------------------------------

def _grouped(rows: Iterable[tuple], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    from itertools import groupby
    return groupby(rows, key=lambda r: r[:width])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []
    for (conv, _, carry), messages in _grouped(_rows(batches), 3):
        void_before = carry                     # last regeneration of an earlier message
        for (*_, message), events in _grouped(messages, 4):
            role, text, alive, regenerated, nth = None, [], False, None, 0
            for *_, seq, kind, by, said in events:
                if void_before is not None and seq is not None and seq < void_before:
                    continue
                if kind == "whole":
                    out.append((conv, message, nth, *render(by or "", said or "")))
                    nth += 1
                    continue
                alive = True
                role = by if role is None or kind == "open" else role
                if kind == "regenerate":
                    text, regenerated = [], seq
                elif kind == "edit":
                    text = [said or ""]
                elif kind != "open" or said:
                    text.append(said or "")
            if alive:
                out.append((conv, message, nth, *render(role or "", "".join(text))))
            if len(out) >= 2048:
                yield _batch(out)
                out = []
            if regenerated is not None:
                void_before = regenerated if void_before is None else max(void_before, regenerated)
    if out:
        yield _batch(out)


_SEGMENTS = pa.schema([("conv_id", pa.int64()), ("message", pa.int64()), ("nth", pa.int64()),
                       ("formatted", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SEGMENTS)], schema=_SEGMENTS)


def format_events(events: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, message, nth, formatted, loss_start, loss_end: one row per
    final message; offsets count code points of ``formatted``.  ``block``: span
    of message numbers that one task folds at a time.

    A conversation's formatted text is its rows' in order of message, then nth
    (whole messages that share a number follow seq, role and text; nth counts
    them).  Messages are numbered by any longs; a null number comes last.  Null
    text is empty, a null role is the empty role, a null kind is a delta;
    events with a null conv_id form one conversation; a null seq comes first
    and is never void; events that tie on seq follow kind, then role and
    text; repeated events count each time.  An empty log gives no rows; other
    columns of the log are not read."""
    e = events.select(F.expr(f"cast(message as long) div {block}").alias("block"),
                      F.col("conv_id").cast("long").alias("conv_id"), F.col("message").cast("long").alias("message"),
                      F.col("seq").cast("long").alias("seq"), F.col("kind").cast("string").alias("kind"),
                      F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    # last regeneration per block, then the last one of earlier blocks: one
    # row per block of messages, so the window over a conversation stays short
    blocks = e.groupBy("conv_id", "block").agg(F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("r"))
    earlier = Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("block")).rowsBetween(Window.unboundedPreceding, -1)
    carry = (blocks.withColumn("carry", F.max("r").over(earlier)).filter("carry is not null")
             .select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "carry"))
    keyed = e.join(carry, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b")), "left")
    ordered = (keyed.select("conv_id", "block", "carry", "message", "seq", "kind", "role", "text")
               .repartition("conv_id", "block")
               .sortWithinPartitions("conv_id", "block", "message", "seq", "kind", "role", "text"))
    return ordered.mapInArrow(_fold, "conv_id long, message long, nth long, formatted string, loss_start long, "
                                     "loss_end long")


def log_of_turns(turns: DataFrame) -> DataFrame:
    """The event log of rows (conv_id, turn, role, text): each row is a whole
    message, its number the turn, so any long and null keep their place.  Rows
    that share a turn follow each other by role and text; a null turn comes
    after all others."""
    turn = F.col("turn").cast("long")
    return turns.select("conv_id", turn.alias("message"), turn.alias("seq"), F.lit("whole").alias("kind"), "role", "text")


# ---- reading back -----------------------------------------------------------

_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                   ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and message, streamed: two running hashes."""
    out = []
    for (conv,), segments in _grouped(_rows(batches), 1):
        turns, loss, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        for _, _, _, formatted, a, z in segments:
            for role, text in parse(formatted):
                turns.update(f"{role}\n{text}\n".encode())
                n += 1
            learned = unescape(formatted[a:z])
            loss.update(learned.encode())
            loss_chars += len(learned)
            chars += len(formatted)
        out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _READ)], schema=_READ)


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation, from the formatted rows: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A hash over a whole conversation is sequential, so one task streams a
    conversation's rows in order; it holds one of them at a time."""
    return (segments.select("conv_id", "message", "nth", "formatted", "loss_start", "loss_end")
            .repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_last("message"), "nth")
            .mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                 "loss_sha256 string, formatted_chars long"))


def format_to_table(events: DataFrame, block: int = BLOCK) -> DataFrame:
    """``format_events`` written under the shared folder and read again."""
    spark = events.sparkSession
    path = scratch_path(spark, "chat", unique=True)
    format_events(events, block).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def format_turns(turns: DataFrame) -> DataFrame:
    """``read_back`` of the formatted table of rows (conv_id, turn, role, text)."""
    return read_back(format_to_table(log_of_turns(turns)))
