"""Documents as blocks of word codes, and what blocks learn about each other.

A block is one row that holds the words of some consecutive documents: a
vocabulary and a code per word, both compressed.  It is written once; later
passes read codes instead of parsing texts.

``shared`` tells every block, for each of its distinct keys (hashes), what
the rest of the corpus knows about it.  Blocks send their sorted keys as
differences, one payload per key range; the reducer of a range merges the
payloads and answers each block with one byte per key.  A key is sent once
per block, so a key that a third of all documents hold is no larger a group
than the number of blocks, and ranges are sized by the number of words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import stage_by_key
from leadflow.operators.stage import stage

BLOCK_WORDS = 1 << 20       # words after which a block is closed (a longer text is a block of its own)
DOC_BITS = 18               # a block is closed after 2**18 documents too
RANGE_KEYS = 1 << 21        # keys, about, that one reducer merges
_SEQ_BITS = 16              # blocks of one partition

BLOCK_SCHEMA = "block long, n_words long, doc_ids array<long>, sizes binary, vocabulary binary, codes binary"
_ARROW = pa.schema([("block", pa.int64()), ("n_words", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("sizes", pa.binary()), ("vocabulary", pa.binary()), ("codes", pa.binary())])


# ---- packing numbers --------------------------------------------------------

def planes(x: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed: the empty high bytes cost nothing."""
    return zstandard.ZstdCompressor(level=1).compress(
        np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()) if len(x) else b""


def from_planes(b: bytes, dtype) -> np.ndarray:
    if not b:
        return np.zeros(0, dtype)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).reshape(-1)


def ascending(keys: np.ndarray) -> bytes:
    return planes(np.diff(keys, prepend=np.uint64(0)))


def from_ascending(b: bytes) -> np.ndarray:
    return np.cumsum(from_planes(b, np.uint64), dtype=np.uint64)


# ---- blocks -----------------------------------------------------------------

class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def _encode(lower: bool, block_words: int, digests: bool):
    schema = _ARROW.append(pa.field("digests", pa.binary())) if digests else _ARROW

    def row(block: int, ids: list, sizes: list[int], codes: list[np.ndarray], vocabulary: _Codes,
            said: list[bytes]) -> pa.RecordBatch:
        all_codes = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
        extra = [pa.array([b"".join(said)], pa.binary())] if digests else []
        return pa.RecordBatch.from_arrays([
            pa.array([block], pa.int64()), pa.array([len(all_codes)], pa.int64()),
            pa.array([ids], pa.list_(pa.int64())), pa.array([planes(np.array(sizes, np.uint32))], pa.binary()),
            pa.array([zstandard.ZstdCompressor(level=1).compress(b" ".join(vocabulary))], pa.binary()),
            pa.array([planes(all_codes)], pa.binary()), *extra], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids, sizes, codes, vocabulary, said, held = [], [], [], _Codes(), [], 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                text = text or b""
                ws = (text.lower() if lower else text).split()  # bytes: ASCII letters and ASCII space only
                if ids and (held + len(ws) > block_words or len(ids) == 1 << DOC_BITS):
                    yield row(part << _SEQ_BITS | seq, ids, sizes, codes, vocabulary, said)
                    ids, sizes, codes, vocabulary, said, held, seq = [], [], [], _Codes(), [], 0, seq + 1
                    if seq >> _SEQ_BITS:
                        raise ValueError("more blocks in a partition than their numbers can tell apart")
                ids.append(doc)
                sizes.append(len(ws))
                codes.append(np.fromiter(map(vocabulary.__getitem__, ws), np.uint32, len(ws)))
                held += len(ws)
                if digests:
                    said.append(hashlib.sha256(text).digest())
        if ids:
            yield row(part << _SEQ_BITS | seq, ids, sizes, codes, vocabulary, said)
    return run


def word_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lower: bool = False,
                block_words: int = BLOCK_WORDS, digests: bool = False) -> DataFrame:
    """Block table of the documents, written to the shared folder in buckets
    of the block number, so that answers come to the blocks.  ``lower``
    maps A-Z to a-z.  Words are maximal runs outside ``[\\x20\\x09-\\x0D]``;
    a null text has none.  ``digests`` adds a column with the SHA-256 of each
    text as it stands (a null text as the empty one), one after the other."""
    d = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    schema = BLOCK_SCHEMA + (", digests binary" if digests else "")
    return stage_by_key(d.mapInArrow(_encode(lower, block_words, digests), schema), "word_blocks", "block")


@dataclass
class Block:
    """One decoded block row."""

    block: int
    doc_ids: list
    sizes: np.ndarray            # words per document
    vocabulary: list[bytes]
    codes: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Block:
        vocabulary = zstandard.ZstdDecompressor().decompress(row["vocabulary"]).split()
        return cls(row["block"], row["doc_ids"], from_planes(row["sizes"], np.uint32).astype(np.int64), vocabulary,
                   from_planes(row["codes"], np.uint32))

    def word_hashes(self) -> np.ndarray:
        """128-bit hash of each word, as two columns of 64 bits."""
        h = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.vocabulary)), "<u8").reshape(-1, 2)
        return h[self.codes]

    def room(self) -> np.ndarray:
        """Per word: words from it to its document's end, itself included."""
        ends = np.cumsum(self.sizes)
        return np.repeat(ends, self.sizes) - np.arange(len(self.codes))

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)


_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two runs, one after the other, from the hash of each."""
    x = a * _K[0] + ((b ^ (b >> np.uint64(32))) * _K[1])
    x = (x ^ (x >> np.uint64(29))) * _K[2]
    return x ^ (x >> np.uint64(32))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on, by doubling; the array is
    shorter by n - 1.  ``h``: a hash per word."""
    if n <= 1 or len(h) < n:
        return h[:max(0, len(h) - n + 1)]
    whole, size, out, done = h, 1, None, 0
    while True:                                  # the binary digits of n, lowest first
        if n & size:
            out = whole if out is None else fold(out[:len(h) - done - size + 1], whole[done:])
            done += size
        if done == n:
            return out
        whole = fold(whole[:len(whole) - size], whole[size:])
        size *= 2


# ---- what others know -------------------------------------------------------

def ranges_for(n_keys: int) -> int:
    return max(1, -(-n_keys // RANGE_KEYS))


def payloads(block: int, keys: np.ndarray, bits: int, ranges: int, **columns: np.ndarray) -> pa.RecordBatch:
    """Rows (range, block, keys, columns...) of ascending distinct ``keys``
    below 2**bits; ``columns`` hold a number per key."""
    cuts = [(r << bits) // ranges for r in range(1, ranges)]
    at = np.concatenate([[0], np.searchsorted(keys, np.array(cuts, np.uint64)), [len(keys)]])
    rows = [r for r in range(ranges) if at[r] < at[r + 1]]
    arrays = {"range": pa.array(rows, pa.int64()), "block": pa.array([block] * len(rows), pa.int64()),
              "keys": pa.array([ascending(keys[at[r]:at[r + 1]]) for r in rows], pa.binary())}
    for name, x in columns.items():
        arrays[name] = pa.array([planes(x[at[r]:at[r + 1]]) for r in rows], pa.binary())
    return pa.RecordBatch.from_pydict(arrays)


def shared(sent: DataFrame, columns: dict[str, type], answer: Callable[..., np.ndarray], name: str) -> DataFrame:
    """block, answers array<struct<range, bytes>>: what the reducers say.

    ``answer(keys, source, **columns)`` gets all keys of a range, sorted, with
    the number of the payload each came from, and returns a byte per key.
    One group holds a range's keys of every block, RANGE_KEYS about."""
    def reduce(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        keys = [from_ascending(r["keys"]) for r in rows]
        source = np.repeat(np.arange(len(rows)), [len(k) for k in keys])
        extra = {c: np.concatenate([from_planes(r[c], t) for r in rows]) for c, t in columns.items()}
        k = np.concatenate(keys)
        order = np.lexsort((source, k)) if not extra else np.lexsort((source, *reversed(extra.values()), k))
        said = np.empty(len(k), np.uint8)
        said[order] = answer(k[order], source[order], **{c: x[order] for c, x in extra.items()})
        ends = np.cumsum([len(x) for x in keys])
        return pa.table({"block": pa.array([r["block"] for r in rows], pa.int64()),
                         "range": pa.array([r["range"] for r in rows], pa.int64()),
                         "said": pa.array([zstandard.ZstdCompressor(level=1).compress(said[a:z].tobytes())
                                           for a, z in zip(np.concatenate([[0], ends[:-1]]), ends)], pa.binary())})

    answers = stage(sent.groupBy("range").applyInArrow(reduce, "block long, range long, said binary"), name)
    return answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("range", "said"))).alias(name))


def heard(answers: list[dict] | None) -> np.ndarray:
    """The bytes for a block's ascending keys, ranges put together."""
    if not answers:
        return np.zeros(0, np.uint8)
    return np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(a["said"]), np.uint8) for a in answers])


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index, length) of each run of equal sorted keys."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return first, np.diff(np.concatenate([first, [len(keys)]]))


def key_bits(n_keys: int) -> int:
    """Bits that make a chance meeting of two of ``n_keys`` filter keys rare
    for each key (1 in 256); the filter then only lets through too much."""
    return min(62, max(16, int(n_keys).bit_length() + 8))
