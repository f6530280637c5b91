"""Packing documents into fixed-length windows, bounded-space and online.

Each partition keeps a fixed number of open windows.  A document's full
windows are cut off and emitted at once; its remainder goes into the open
window that it fits best.  When none fits, the fullest window is emitted; a
gap of ``min_cut`` ids or more is first filled with the head of the
remainder.  The windows still open at a partition's end are written aside and
merged with those of other partitions, again in bounded groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.tokens import encoder, texts
from leadflow.session import scratch_path

LENGTH = 1024
OPEN_WINDOWS = 64
MIN_CUT = 8
MERGE_PARTITIONS = 64       # partitions whose open windows are merged in one group

PIECE_SCHEMA = ("doc_id long, start long, length long, doc_tokens long, part long, window long, offset long, "
                "leftover boolean, ids binary")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                    ("part", pa.int64()), ("window", pa.int64()), ("offset", pa.int64()), ("leftover", pa.bool_()),
                    ("ids", pa.binary())])
Piece = tuple      # (doc_id, start, doc_tokens, ids)


class OpenWindows:
    """The open windows of one partition; ``closed`` collects emitted ones."""

    def __init__(self, length: int, most: int, min_cut: int):
        self.length, self.most, self.min_cut = length, most, min_cut
        self.windows: list[tuple[int, list[Piece]]] = []       # (ids held, pieces)
        self.closed: list[list[Piece]] = []

    def add(self, piece: Piece) -> None:
        doc, start, total, ids = piece
        n = len(ids)
        whole = n // self.length * self.length
        for a in range(0, whole, self.length):
            self.closed.append([(doc, start + a, total, ids[a:a + self.length])])
        if whole < n:
            self._place((doc, start + whole, total, ids[whole:]))

    def _place(self, piece: Piece) -> None:
        n = len(piece[3])
        best = -1
        for i, (held, _) in enumerate(self.windows):
            if held + n <= self.length and (best < 0 or held > self.windows[best][0]):
                best = i
        if best < 0 and len(self.windows) < self.most:
            self.windows.append((n, [piece]))
            return
        if best >= 0:
            held, pieces = self.windows[best]
            pieces.append(piece)
            if held + n == self.length:
                self.closed.append(pieces)
                del self.windows[best]
            else:
                self.windows[best] = (held + n, pieces)
            return
        full = max(range(len(self.windows)), key=lambda i: self.windows[i][0])
        held, pieces = self.windows.pop(full)
        gap = self.length - held
        doc, start, total, ids = piece
        if gap >= self.min_cut:
            pieces.append((doc, start, total, ids[:gap]))
            piece = (doc, start + gap, total, ids[gap:])
        self.closed.append(pieces)
        self._place(piece)


def _rows(part: int, windows: list[list[Piece]], first: int, leftover: bool) -> list[tuple]:
    out = []
    for window, pieces in enumerate(windows, first):
        offset = 0
        for doc, start, total, ids in pieces:
            out.append((doc, start, len(ids), total, part, window, offset, leftover, ids.tobytes()))
            offset += len(ids)
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _pack_partition(vocabulary: str, kind: str, end_id: int, length: int, most: int, min_cut: int, plain: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, end = TaskContext.get().partitionId(), np.array([end_id], np.uint32)
        open_, done = OpenWindows(length, most, min_cut), 0
        enc = encoder(vocabulary, kind, plain)
        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), enc.encode(texts(b.column(1)))):
                ids = np.concatenate([ids, end]).astype("<u4")
                open_.add((doc, 0, len(ids), ids))
                if len(open_.closed) >= 512:
                    yield _batch(_rows(part, open_.closed, done, False))
                    done += len(open_.closed)
                    open_.closed = []
        rest = [pieces for _, pieces in open_.windows]
        rows = _rows(part, open_.closed, done, False) + _rows(part, rest, done + len(open_.closed), True)
        if rows:
            yield _batch(rows)
    return run


def _merge(length: int, most: int):
    """Merge the open windows of a group of partitions: their pieces follow one
    another and are cut where a sequence is full; what is left at the end is
    cut into power-of-two lengths, which need no padding."""
    def run(table: pa.Table) -> pa.Table:
        held = sorted(table.to_pylist(), key=lambda r: (r["part"], r["window"], r["offset"]))
        group = held[0]["part"] // most
        sequences: list[list[Piece]] = [[]]
        room = length
        for r in held:
            ids, start = np.frombuffer(r["ids"], "<u4"), r["start"]
            while len(ids):
                take = ids[:room]
                sequences[-1].append((r["doc_id"], start, r["doc_tokens"], take))
                ids, start, room = ids[len(take):], start + len(take), room - len(take)
                if not room:
                    sequences.append([])
                    room = length
        last = sequences.pop()
        size = length - room
        for bit in reversed(range(length.bit_length())):
            if size >> bit & 1:
                want, seq = 1 << bit, []
                while want:
                    doc, start, total, ids = last.pop(0)
                    if len(ids) > want:
                        last.insert(0, (doc, start + want, total, ids[want:]))
                        ids = ids[:want]
                    seq.append((doc, start, total, ids))
                    want -= len(ids)
                sequences.append(seq)
        return pa.Table.from_batches([_batch(_rows(group, sequences, 0, True))])
    return run


def pack(docs: DataFrame, vocabulary: str, kind: str = "byte", end_id: int = 0, length: int = LENGTH,
         open_windows: int = OPEN_WINDOWS, min_cut: int = MIN_CUT, id_col: str = "doc_id",
         text_col: str = "text", plain: bool = False) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset: one row per piece.

    A document is its text's ids (null text: none) and ``end_id``; a special
    token's string in a text gives its id, or with ``plain`` the ids of
    ordinary text.  Each id lies in exactly one piece.  Sequences hold at most ``length`` ids.  Both
    phases are written to the shared folder, ids included, so the texts are
    encoded once.  Rows that share an id, or have none, are packed like any
    other; empty input gives an empty result; only the id and text columns
    are read.  A very long text is held whole by its task, nothing else is."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "packed", unique=True)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    (d.mapInArrow(_pack_partition(vocabulary, kind, end_id, length, open_windows, min_cut, plain), PIECE_SCHEMA)
     .write.option("compression", "zstd").partitionBy("leftover").parquet(f"{folder}/first"))
    first = spark.read.schema(PIECE_SCHEMA).parquet(f"{folder}/first")
    (first.filter("leftover").groupBy(F.floor(F.col("part") / MERGE_PARTITIONS).alias("group"))
     .applyInArrow(_merge(length, MERGE_PARTITIONS), PIECE_SCHEMA)
     .write.option("compression", "zstd").parquet(f"{folder}/merged"))
    merged = spark.read.schema(PIECE_SCHEMA).parquet(f"{folder}/merged")
    # sequence ids: place in the partition, then a parity bit for merged ones
    number = lambda odd: F.shiftleft(F.shiftleft(F.col("part"), 32) + F.col("window"), 1) + odd
    cols = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return (first.filter(~F.col("leftover")).withColumn("sequence_id", number(0)).select(*cols)
            .unionByName(merged.withColumn("sequence_id", number(1)).select(*cols)))


def pieces(docs: DataFrame, vocabulary: str, **kw) -> DataFrame:
    """``pack`` with the ids' checksum in place of the ids."""
    return pack(docs, vocabulary, **kw).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                                               "doc_tokens", "sequence_id", "offset")
