"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last ``WINDOW`` bytes decides where a text is cut: for
block size 2**k after every byte whose hash ends in k ones, on average every
2**k bytes, whatever stands before.  Each chunk gives one symbol of 12 bits.
A fingerprint holds the symbols at the smallest block size that cuts a text at
fewer than ``MOST_CUTS`` places and at twice that size::

    BLOCK_SIZE:SYMBOLS:SYMBOLS AT TWICE THE SIZE

(two characters a symbol).  All bytes count: the chunk after the last cut
reaches to the end.  Fingerprints are compared at block sizes that both hold,
by the edit distance of their symbols: 1 - distance / symbols of the longer
one, the better of two common sizes; 0 without a common size.

``compare_with_next`` needs each document's successor in order of id.  Ranges
of ids are sorted and streamed by one task each, which holds two documents;
only a range's first and last document are written with their texts and meet
their neighbours in a join of one row for each range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadflow.llm.blocks import fold
from leadflow.session import scratch_path

WINDOW = 7              # bytes of the rolling hash
MOST_CUTS = 64          # cuts that a fingerprint's smaller block size stays below
_FACTOR = np.uint32(0x9E3779B1)
_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_SYMBOLS = [_DIGITS[x >> 6] + _DIGITS[x & 63] for x in range(1 << 12)]


# ---- one text ---------------------------------------------------------------

def rolling(data: bytes) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes up to each byte (fewer at the start)."""
    x = np.frombuffer(data, np.uint8).astype(np.uint32) + np.uint32(1)
    h, factor = x.copy(), np.uint32(1)
    for back in range(1, min(WINDOW, len(x))):
        factor = np.multiply(factor, _FACTOR, dtype=np.uint32)
        h[back:] += x[:-back] * factor
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return h ^ (h >> np.uint32(13))


def _cuts(h: np.ndarray, k: int) -> np.ndarray:
    ones = np.uint32((1 << k) - 1)
    return (h & ones) == ones


def _signature(h: np.ndarray, k: int) -> str:
    ends = np.flatnonzero(_cuts(h, k)[:-1]) + 1
    sums = np.add.reduceat(h.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), np.concatenate([[0], ends]))
    return "".join([_SYMBOLS[x] for x in (fold(sums, sums) >> np.uint64(52)).tolist()])


def fingerprint(text: str | None) -> str:
    """Fingerprint of the whole text in UTF-8; null is the empty text."""
    data = (text or "").encode()
    if not data:
        return "1::"
    h = rolling(data)
    k = max(0, (len(data) // MOST_CUTS).bit_length() - 1)
    while np.count_nonzero(_cuts(h, k)) >= MOST_CUTS and k < 32:
        k += 1
    while k and np.count_nonzero(_cuts(h, k - 1)) < MOST_CUTS:
        k -= 1
    return f"{1 << k}:{_signature(h, k)}:{_signature(h, k + 1)}"


def edit_distance(a: Sequence, b: Sequence) -> int:
    """Insertions, deletions and replacements that make ``b`` of ``a``; one
    column of the table at a time as bits of two numbers."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    a, b = a[start:], b[start:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return len(a) + len(b)
    at: dict = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full, last, up, down, distance = (1 << len(a)) - 1, 1 << len(a) - 1, (1 << len(a)) - 1, 0, len(a)
    for x in b:
        equal = at.get(x, 0)
        level = (((equal & up) + up) ^ up) | equal
        rise, fall = down | ~(level | up) & full, up & level
        distance += bool(rise & last) - bool(fall & last)
        rise, fall = (rise << 1 | 1) & full, (fall << 1) & full
        up, down = fall | ~(equal | down | rise) & full, rise & (equal | down)
    return distance


def likeness(a: str, b: str) -> float:
    """0 to 1 for two fingerprints; 1 if they are equal."""
    if a == b:
        return 1.0
    held = []
    for f in (a, b):
        size, one, two = f.split(":")
        held.append({int(size): one, 2 * int(size): two})
    best = 0.0
    for size in held[0].keys() & held[1].keys():
        x, y = ([s[i:i + 2] for i in range(0, len(s), 2)] for s in (held[0][size], held[1][size]))
        if x and y:
            best = max(best, 1.0 - edit_distance(x, y) / max(len(x), len(y)))
    return best


# ---- documents --------------------------------------------------------------

def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars (code points), fingerprint of every row's whole text.

    A null text counts as empty; rows are independent of each other, so ids
    may be null, shared or repeated; empty input gives an empty result; only
    the id and text columns are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = [t or "" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(t) for t in said], pa.int64()),
                pa.array([fingerprint(t) for t in said], pa.string())], names=["doc_id", "n_chars", "fingerprint"])
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def graft(text: str, following: str) -> str:
    """``text`` whose last quarter (floor of its code points / 4) is replaced
    by the first as many code points, or all, of ``following``."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


_RESULT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha", pa.binary()), ("fingerprint", pa.string()),
           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_ROLES = [("part", pa.int64()), ("role", pa.string()), ("text", pa.string())]
_PLAIN = "doc_id long, n_chars long, edited_sha binary, fingerprint string, edited_fingerprint string, " \
         "near_edited double, near_next double"
_STAGED = _PLAIN + ", part long, role string, text string"
Edit = Callable[[str, str], str]


def _result(doc: int | None, text: str, mark: str, following: str, next_mark: str, edit: Edit) -> tuple:
    new = edit(text, following)
    new_mark = mark if new == text else fingerprint(new)
    return (doc, len(text), hashlib.sha256(new.encode()).digest(), mark, new_mark, likeness(mark, new_mark),
            likeness(mark, next_mark))


def _batch(rows: list[tuple], fields: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)],
                                      names=[n for n, _ in fields])


def _stream(edit: Edit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, held = TaskContext.get().partitionId(), [], None
        for doc, text in _columns(batches):
            mark = fingerprint(text)
            if held is None:
                rows.append((doc, len(text), None, mark, None, None, None, part, "first", text))
            else:
                rows.append((*_result(*held, text, mark, edit), part, "inner", None))
            held = (doc, text, mark)
            if len(rows) >= 1024:
                yield _batch(rows, _RESULT + _ROLES)
                rows = []
        if held is not None:
            doc, text, mark = held
            rows.append((doc, len(text), None, mark, None, None, None, part, "last", text))
            yield _batch(rows, _RESULT + _ROLES)
    return run


def _join_ends(edit: Edit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _columns(batches):
            yield _batch([_result(*row, edit)], _RESULT)
    return run


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit: Edit = graft) -> DataFrame:
    """doc_id, n_chars, edited_sha (binary), fingerprint, edited_fingerprint,
    near_edited, near_next for every row of ``docs``.

    The edited text is ``edit(text, text of the next document)``; documents
    follow one another by ascending id, null ids last, rows that share an id
    by a hash of their text, and the first follows the last (a single document
    follows itself).  near_edited and near_next are the likeness of the text's
    fingerprint to those of the edited and of the next text.  A null text is
    empty; repeated rows are documents of their own; empty input gives an
    empty result; only the id and text columns are read.  Texts are shuffled
    once, by id; a task holds two of them."""
    spark = docs.sparkSession
    order = [F.col("id").asc_nulls_last(), F.col("h")]
    d = (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
         .withColumn("h", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text"))
    path = scratch_path(spark, "piecewise", unique=True)
    d.mapInArrow(_stream(edit), _STAGED).write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(_STAGED).parquet(path)
    # one row for each range of ids: the window sees as many rows as tasks ran
    first = rows.filter("role = 'first'")
    by_part = Window.orderBy("part")
    after = first.select("part").withColumn("next", F.coalesce(
        F.lead("part").over(by_part), F.first("part").over(by_part.rowsBetween(Window.unboundedPreceding, 0))))
    last = rows.filter("role = 'last'").select("part", "doc_id", "text", "fingerprint").join(after, "part")
    ends = last.join(first.select(F.col("part").alias("next"), F.col("text").alias("next_text"),
                                  F.col("fingerprint").alias("next_mark")), "next")
    ends = ends.select("doc_id", "text", "fingerprint", "next_text", "next_mark").mapInArrow(_join_ends(edit), _PLAIN)
    return rows.filter("role = 'inner'").select(*[n for n, _ in _RESULT]).union(ends)
