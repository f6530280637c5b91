"""Cross-tokenizer alignment by merge-path partitioning.

Two tokenizers cut the bytes of one text in two ways.  Where tokens of both
end, a group ends; every stretch between neighbouring ends lies in one token
of either, so the overlapping pairs (links) are the steps of the merge of the
two ascending lists of ends.

A block is some consecutive documents, about ``BLOCK_TOKENS`` tokens.  The
merge of its ends is cut along diagonals of the merge matrix: on each, a binary
search finds how many ends of either list come before, so every piece has the
same number of steps and needs nothing of the others but its first
coordinates and the end before it.  A piece emits its links and the groups it
closes; group numbers run on from piece to piece, which puts the two parts of
a group cut by a diagonal together.

Counts of id pairs over all documents: blocks hold each distinct pair once
with its links, pairs are summed and the best of each B id found by partial
aggregates, and each block gets the counts of its pairs by a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.blocks import from_planes, planes
from leadflow.llm.common import stage_by_key
from leadflow.llm.tokens import ByteEncoder, encoder
from leadflow.operators.stage import stage

BLOCK_TOKENS = 1 << 20      # tokens of both kinds in a block, about (a longer text is a block of its own)
PIECE_STEPS = 1024          # steps of the merge in one piece
_A_BITS = 20                # a pair is the B id, then the A id in so many bits
_SEQ_BITS = 20              # blocks of one partition


# ---- merge path -------------------------------------------------------------

def diagonals(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the first ``at[k]`` steps of the merge come from ``a``
    (equal ends: the one of ``a`` first); one binary search per diagonal."""
    lo, hi = np.maximum(0, at - len(b)), np.minimum(at, len(a))
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) // 2
        first = a[mid] <= b[at[open_] - 1 - mid]
        lo[open_[first]] = mid[first] + 1
        hi[open_[~first]] = mid[~first]


def merge_pieces(a: np.ndarray, b: np.ndarray, steps: int = PIECE_STEPS) -> tuple[np.ndarray, ...]:
    """(A token, B token) of every link in order, and the group of each A and
    each B token.  ``a``, ``b``: ascending ends, the last ones equal."""
    n = len(a) + len(b)
    if not n:
        return (np.zeros(0, np.int64),) * 4
    cut = np.append(np.arange(0, n, steps), n)
    i = diagonals(a, b, cut)
    j = cut - i
    number = np.int32 if int(a[-1]) < 1 << 29 else np.int64
    a, b, i, j, none = a.astype(number), b.astype(number), i.astype(number), j.astype(number), np.iinfo(number).max
    # a row per piece: its ends of a, then its ends of b (as 2 * end + whose)
    own_a, own_b = np.diff(i), np.diff(j)
    piece_a, piece_b = np.repeat(np.arange(len(own_a)), own_a), np.repeat(np.arange(len(own_b)), own_b)
    rows = np.full(len(own_a) * steps, none)
    rows[piece_a * steps + np.arange(len(a)) - i[piece_a]] = a << 1
    rows[piece_b * steps + own_a[piece_b] + np.arange(len(b)) - j[piece_b]] = b << 1 | 1
    rows = np.sort(rows.reshape(-1, steps), axis=1)
    # each piece for itself: ends, whose they are, coordinates, the end before
    end, is_b = rows >> 1, (rows & 1).astype(bool)
    before_b = np.cumsum(is_b, axis=1, dtype=np.int32) - is_b
    at_b = j[:-1, None] + before_b
    at_a = i[:-1, None] + np.arange(steps, dtype=np.int32) - before_b
    earlier = np.maximum(np.where(i[:-1] > 0, a[i[:-1] - 1], 0), np.where(j[:-1] > 0, b[j[:-1] - 1], 0))
    previous = np.concatenate([earlier[:, None], end[:, :-1]], axis=1)
    real = rows != none
    link = real & (end > previous)
    closes = real & is_b & (end == previous)
    # put together: groups closed before each step, in its piece and in earlier ones
    inside = np.cumsum(closes, axis=1, dtype=np.int32)
    group = inside - closes + (np.cumsum(inside[:, -1], dtype=np.int64) - inside[:, -1])[:, None]
    return at_a[link], at_b[link], group[real & ~is_b], group[real & is_b]


# ---- the two tokenizers -----------------------------------------------------

@lru_cache(maxsize=2)
def _piece_model(path: str):
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def _piece_bytes(path: str) -> tuple[list[bytes], np.ndarray]:
    model = _piece_model(path)
    said = [bytes([int(model.id_to_piece(k)[3:5], 16)]) if model.is_byte(k)
            else model.id_to_piece(k).replace("▁", " ").encode() for k in range(model.get_piece_size())]
    return said, np.array([len(x) for x in said], np.int64)


def _entry_lengths(enc: ByteEncoder) -> np.ndarray:
    return np.array([len(enc.entries.get(k, b"")) for k in range(max(enc.entries) + 1)], np.int64)


@lru_cache(maxsize=2)
def _numbers(n_a: int, n_b: int) -> list[str]:
    """Text of an id in a group listing: next A id, A id that begins a group,
    next B id, B id that follows the A ids."""
    return [f"{mark}{k}" for mark, n in ((",", n_a), (";", n_a), (",", n_b), ("|", n_b)) for k in range(n)]


# ---- blocks -----------------------------------------------------------------

_FIELDS = [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.binary()), ("sha", pa.binary()),
           ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32())), ("links", pa.binary())]
_BLOCK = ("block long, doc_ids array<long>, counts binary, sha binary, pairs array<long>, times array<int>, "
          "links binary")


def _block(number: int, ids: list, tokens: list[tuple | None], a_len: np.ndarray, b_len: np.ndarray,
           names: list[str], listings: bool) -> pa.RecordBatch:
    """One row: per document five counts and a digest (or, with ``listings``,
    the group listing itself), the block's distinct pairs, and the pair of
    every link."""
    whole = [t for t in tokens if t is not None]
    none = [np.zeros(0, np.int64)]
    a, b = (np.concatenate([t[k] for t in whole] or none).astype(np.int64) for k in (0, 1))
    link_a, link_b, group_a, group_b = merge_pieces(np.cumsum(a_len[a]), np.cumsum(b_len[b]))
    # listing: each id's place in its document's sequence of groups, A ids first
    size_a, size_b = (np.array([len(t[k]) for t in whole], np.int64) for k in (0, 1))
    place = np.empty(len(a) + len(b), np.int64)
    new_a, new_b = (np.append(True, g[1:] != g[:-1])[:len(g)] for g in (group_a, group_b))
    place[np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")] = a + len(a_len) * new_a
    place[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = b + 2 * len(a_len) + len(b_len) * new_b
    n, counts, said, at, group = len(whole), np.zeros((4, len(ids)), np.int64), [], 0, 0
    doc_of_a = np.repeat(np.arange(n), size_a)
    known = np.flatnonzero([t is not None for t in tokens])
    counts[0, known], counts[1, known] = size_a, size_b
    last = group_a[np.cumsum(size_a) - 1] + 1 if n else np.zeros(0, np.int64)
    counts[2, known] = np.diff(last, prepend=0)
    counts[3, known] = np.bincount(doc_of_a[link_a], minlength=n)
    ends = np.cumsum(size_a + size_b).tolist()
    for z in ends:
        text = "".join(map(names.__getitem__, place[at:z].tolist()))[1:].encode()
        said.append(text if listings else hashlib.sha256(text).digest())
        at = z
    texts = [b""] * len(ids)
    for k, s in zip(known.tolist(), said):
        texts[k] = s
    pairs, which, times = np.unique(b[link_b] << _A_BITS | a[link_a], return_inverse=True, return_counts=True)
    sha = b"\0".join(texts) if listings else b"".join(t or bytes(32) for t in texts)
    return pa.RecordBatch.from_arrays([
        pa.array([x], t) for x, (_, t) in zip((number, ids, planes(counts.reshape(-1)), sha, pairs, times,
                                               planes(which.astype(np.uint32))), _FIELDS)], names=[f for f, _ in _FIELDS])


def _encode(a_vocabulary: str, b_model: str, block_tokens: int, listings: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, seq = TaskContext.get().partitionId() << _SEQ_BITS, 0
        model, (b_bytes, b_len) = _piece_model(b_model), _piece_bytes(b_model)
        enc = encoder(a_vocabulary, "byte", plain=True)
        a_len = _entry_lengths(enc)
        names = _numbers(len(a_len), len(b_len))
        ids, tokens, held = [], [], 0
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                some = batch.slice(k, 64)
                said = [t or "" for t in some.column(1).to_pylist()]
                spaced = [" " + t for t in said]
                coded = zip(some.column(0).to_pylist(), said, spaced, enc.encode(spaced),
                            model.encode(said, num_threads=1))
                for doc, text, full, a, b in coded:
                    # A's entries hold every byte as it stands, so their lengths tell; B may have changed some
                    raw = full.encode()
                    same = text and int(a_len[a].sum()) == len(raw) and b"".join(map(b_bytes.__getitem__, b)) == raw
                    size = len(a) + len(b) if same else 0
                    if ids and (held + size > block_tokens or len(ids) >= block_tokens):
                        yield _block(first | seq, ids, tokens, a_len, b_len, names, listings)
                        ids, tokens, held, seq = [], [], 0, seq + 1
                        if seq >> _SEQ_BITS:
                            raise ValueError("more blocks in a partition than their numbers can tell apart")
                    ids.append(doc)
                    tokens.append((a, np.array(b, np.int64)) if same else None)
                    held += size
        if ids:
            yield _block(first | seq, ids, tokens, a_len, b_len, names, listings)
    return run


# ---- documents --------------------------------------------------------------

_OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups string")


def _score(listings: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["doc_ids"])
                n_a, n_b, n_groups, n_links = from_planes(row["counts"], np.int64).reshape(4, n)
                known = row["answers"] or []
                count = np.array([x["n"] for x in known], np.int64)
                best = np.array([x["best"] for x in known], bool)
                link = from_planes(row["links"], np.uint32)
                upto = np.concatenate([[0], np.cumsum(n_links)])
                sums = [np.concatenate([[0], np.cumsum(x[link])])[upto] if len(link) else np.zeros(n + 1, np.int64)
                        for x in (best.astype(np.int64), count)]
                sha = row["sha"]
                if listings:
                    said = [s.decode() for s in sha.split(b"\0")]
                else:
                    said = [sha[32 * k:32 * k + 32].hex() if a else "" for k, a in enumerate(n_a.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), *(pa.array(x) for x in (n_a, n_b, n_groups, n_links)),
                     *(pa.array(np.diff(s)) for s in sums), pa.array(said, pa.string())],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])
    return run


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, n (links of the pair in all documents), best (no other pair of
    its B id has more): partial sums, then one row per distinct pair."""
    counts = (blocks.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
              .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n")))
    counts = stage(counts, "align_counts")
    most = counts.groupBy(F.shiftright("pair", _A_BITS).alias("b")).agg(F.max("n").alias("most"))
    return stage(counts.withColumn("b", F.shiftright("pair", _A_BITS)).join(most, "b")
                 .select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "align_pairs")


def align(docs: DataFrame, a_vocabulary: str, b_model: str, id_col: str = "doc_id", text_col: str = "text",
          block_tokens: int = BLOCK_TOKENS, listings: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups for every
    row of ``docs``.

    A is the byte-level vocabulary ``a_vocabulary`` on a space and the text, B
    the piece model ``b_model`` on the text, which adds the space; both without
    special tokens, whose strings are plain text.  Links are pairs of A and B
    token occurrences whose bytes overlap; a link's count is the number of
    links of its id pair over all documents.  n_best: links whose count is the
    highest of their B id; count_sum: the counts of all links.  ``groups`` is
    the SHA-256 of the listing ``a1,a2|b1;a3|b2,b3`` of ids, or with
    ``listings`` the listing.

    A null or empty text, and one that either tokenizer does not give back
    byte by byte, has no tokens: zeros and ''.  Rows that share an id, have
    none or are repeated are each a document and all count; a long text is a
    block of its own in one task; empty input gives an empty result; only the
    id and text columns are read."""
    d = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    blocks = stage_by_key(d.mapInArrow(_encode(a_vocabulary, b_model, block_tokens, listings), _BLOCK),
                          "align_blocks", "block")
    known = pair_counts(blocks)
    # a frequent pair has a row for each block: plain exchanges on both sides, which skew handling splits
    asked = blocks.select("block", F.posexplode("pairs").alias("pos", "pair"))
    answers = (asked.join(known, "pair").groupBy("block")
               .agg(F.sort_array(F.collect_list(F.struct("pos", "n", "best"))).alias("answers")))
    return (blocks.join(answers, "block", "left").select("doc_ids", "counts", "sha", "links", "answers")
            .mapInArrow(_score(listings), _OUT))
