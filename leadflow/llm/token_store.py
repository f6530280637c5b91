"""Token-id store: concatenated id arrays with Elias-Fano document boundaries.

A store is a folder of two Parquet tables.  ``segments`` has one row per
segment, a run of documents in ascending id order of at most about
``SEGMENT_IDS`` ids (one document more if a single one is longer):

    shard, seq        place in the store; (shard, seq) ascends with doc_id
    n_docs, n_ids     sizes
    first_doc, last_doc  smallest and largest doc_id (null if all are null)
    ids               the ids one after the other, little-endian, ``width``
                      bytes each (2 if every id of the vocabulary fits)
    bounds            Elias-Fano code of the n_docs + 1 boundaries
    docs              Elias-Fano code of doc_id - first_doc (null ids last)
    n_null            documents with a null id, at the segment's end

``shards`` has one row per shard with the number of ids before it.  Offsets
inside a segment need no 64-bit table: the boundaries take about
2 + log2(ids per document) bits each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadflow.llm.tokens import encoder, texts
from leadflow.session import scratch_path

SEGMENT_IDS = 2_000_000
_SAMPLE = 64            # every 64th set bit's place is stored


# ---- Elias-Fano -------------------------------------------------------------

@dataclass
class EliasFano:
    """A non-decreasing sequence of n numbers below 2**62.

    The low ``low_bits`` of each number are stored as they are; the high
    parts as a bit vector with a one at place high + index.  ``select`` finds
    the i-th one from the nearest sampled place, so one number is read
    without decoding those before it."""

    n: int
    low_bits: int
    low: np.ndarray          # packed bits
    high: np.ndarray         # packed bits
    samples: np.ndarray      # uint32 places of every _SAMPLE-th one

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        k = max(0, (top // n).bit_length() - 1) if n else 0
        low = ((v[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        places = (v >> np.uint64(k)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        bits[places] = 1
        return cls(n, k, np.packbits(low.reshape(-1), bitorder="little"), np.packbits(bits, bitorder="little"),
                   places[::_SAMPLE].astype(np.uint32))

    def _lows(self, i: np.ndarray) -> np.ndarray:
        at = i[:, None] * self.low_bits + np.arange(self.low_bits)
        bits = (self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def select(self, i: int) -> int:
        """The i-th number (0-based)."""
        start = int(self.samples[i // _SAMPLE])
        need = i % _SAMPLE                          # ones to pass after the sampled one
        byte = start >> 3
        place, bits = start, np.zeros(0, np.uint8)
        if need:
            width = 32
            while True:
                bits = np.unpackbits(self.high[byte:byte + width], bitorder="little")
                ones = np.flatnonzero(bits[(start & 7) + 1:])
                if len(ones) >= need:
                    place = start + 1 + int(ones[need - 1])
                    break
                width *= 2
        return ((place - i) << self.low_bits) | int(self._lows(np.array([i]))[0])

    def values(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        i = np.arange(self.n)
        return ((places - i) << self.low_bits) | self._lows(i)

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high)], "<u4").tobytes()
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, b: bytes) -> EliasFano:
        n, k, nl, nh = (int(x) for x in np.frombuffer(b, "<u4", 4))
        return cls(n, k, np.frombuffer(b, np.uint8, nl, 16), np.frombuffer(b, np.uint8, nh, 16 + nl),
                   np.frombuffer(b, "<u4", offset=16 + nl + nh))


# ---- writing ----------------------------------------------------------------

SEGMENT_SCHEMA = ("shard int, seq int, n_docs int, n_null int, n_ids long, first_doc long, last_doc long, "
                  "width int, ids binary, bounds binary, docs binary")
_ARROW = pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int32()), ("n_null", pa.int32()),
                    ("n_ids", pa.int64()), ("first_doc", pa.int64()), ("last_doc", pa.int64()),
                    ("width", pa.int32()), ("ids", pa.binary()), ("bounds", pa.binary()), ("docs", pa.binary())])


def _segment(shard: int, seq: int, ids: list[np.ndarray], docs: list[int | None], width: int) -> pa.RecordBatch:
    known = [x for x in docs if x is not None]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    first = known[0] if known else None
    return pa.RecordBatch.from_pylist([{
        "shard": shard, "seq": seq, "n_docs": len(docs), "n_null": len(docs) - len(known), "n_ids": int(bounds[-1]),
        "first_doc": first, "last_doc": known[-1] if known else None, "width": width,
        "ids": np.concatenate(ids).astype(f"<u{width}").tobytes(),
        "bounds": EliasFano.encode(bounds).to_bytes(),
        "docs": EliasFano.encode(np.array([x - first for x in known], np.int64)).to_bytes()}], schema=_ARROW)


def _write_partition(vocabulary: str, kind: str, end_id: int, width: int, segment_ids: int, plain: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seq = TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32)
        ids, docs, held = [], [], 0
        enc = encoder(vocabulary, kind, plain)
        for b in batches:
            for doc, ids_ in zip(b.column(0).to_pylist(), enc.encode(texts(b.column(1)))):
                one = np.concatenate([ids_, end])
                if ids and held + len(one) > segment_ids:
                    yield _segment(shard, seq, ids, docs, width)
                    ids, docs, held, seq = [], [], 0, seq + 1
                ids.append(one)
                docs.append(doc)
                held += len(one)
        if ids:
            yield _segment(shard, seq, ids, docs, width)
    return run


def write_store(docs: DataFrame, folder: str, vocabulary: str, kind: str = "word", end_id: int = 2,
                width: int = 2, id_col: str = "doc_id", text_col: str = "text",
                segment_ids: int = SEGMENT_IDS, plain: bool = False) -> str:
    """Encode every whole text (null: empty), add ``end_id``, write the store.
    A special token's string in a text gives its id, or with ``plain`` the ids
    of ordinary text.

    Documents are range-partitioned by id (a hash of the text orders rows
    that share an id, so a hot id is split too; null ids come last) and each
    task writes its range as one shard.  ``width``: bytes per id; 2 needs ids
    below 65,536."""
    order = [F.col("id").asc_nulls_last(), F.col("h")]
    d = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
         .withColumn("h", F.xxhash64("text"))
         .repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text"))
    segments = d.mapInArrow(_write_partition(vocabulary, kind, end_id, width, segment_ids, plain), SEGMENT_SCHEMA)
    segments.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/segments")
    spark = docs.sparkSession
    # one row per shard: the window sees as many rows as there were tasks
    per_shard = spark.read.schema(SEGMENT_SCHEMA).parquet(f"{folder}/segments").groupBy("shard").agg(
        F.sum("n_ids").alias("n_ids"), F.sum("n_docs").alias("n_docs"))
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    (per_shard.withColumn("ids_before", F.coalesce(before, F.lit(0)))
     .write.mode("overwrite").parquet(f"{folder}/shards"))
    return folder


# ---- reading ----------------------------------------------------------------

def _read_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            bounds = EliasFano.from_bytes(row["bounds"]).values()
            known = EliasFano.from_bytes(row["docs"]).values() + (row["first_doc"] or 0)
            w = row["width"]
            raw = row["ids"]
            n = np.diff(bounds)
            wide = np.frombuffer(raw, f"<u{w}").astype("<u4").tobytes() if w != 4 else raw
            view = memoryview(wide)
            crc = [zlib.crc32(view[4 * a:4 * z]) for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array(known.tolist() + [None] * row["n_null"], pa.int64()),
                pa.array(bounds[:-1] + row["base"], pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _with_base(spark: SparkSession, folder: str) -> DataFrame:
    """Segments with ``base``: ids of the whole store before the segment."""
    seg = spark.read.schema(SEGMENT_SCHEMA).parquet(f"{folder}/segments")
    shards = spark.read.parquet(f"{folder}/shards").select("shard", "ids_before")
    inside = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    base = (seg.select("shard", "seq", "n_ids")
            .withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
            .join(shards, "shard").select("shard", "seq", (F.col("ids_before") + F.col("inside")).alias("base")))
    # broadcast: one row of 16 bytes for each segment of about SEGMENT_IDS ids;
    # beyond 10 million segments an ordinary join takes its place
    small = spark.read.parquet(f"{folder}/shards").agg(F.sum("n_ids")).first()[0] or 0
    return seg.join(F.broadcast(base) if small < 10_000_000 * SEGMENT_IDS // 8 else base, ["shard", "seq"])


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    return (_with_base(spark, folder).select("ids", "bounds", "docs", "n_null", "first_doc", "width", "base")
            .mapInArrow(_read_docs, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def read_slice(spark: SparkSession, folder: str, doc_id: int) -> np.ndarray | None:
    """The ids of one document: only segments whose range holds the id are
    read, and two selects give its boundaries.  None if it is not there."""
    rows = (spark.read.schema(SEGMENT_SCHEMA).parquet(f"{folder}/segments")
            .filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)))
    for row in rows.toLocalIterator():
        docs = EliasFano.from_bytes(row["docs"])
        lo, hi, want = 0, docs.n, doc_id - row["first_doc"]
        while lo < hi:                              # binary search by select
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if docs.select(mid) < want else (lo, mid)
        if lo < docs.n and docs.select(lo) == want:
            bounds = EliasFano.from_bytes(row["bounds"])
            a, z = bounds.select(lo), bounds.select(lo + 1)
            w = row["width"]
            return np.frombuffer(row["ids"], f"<u{w}")[a:z].astype(np.uint32)
    return None


def token_output(docs: DataFrame, vocabulary: str, **kw) -> DataFrame:
    """Write a store under the shared folder and read it back.  Null texts
    hold the end id only; null ids come last; rows that share an id are each
    a document; a very long text is encoded whole by its task; empty input
    gives an empty result; only the id and text columns are read."""
    folder = scratch_path(docs.sparkSession, "token_store", unique=True)
    return read_store(docs.sparkSession, write_store(docs, folder, vocabulary, **kw))
