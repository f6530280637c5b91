"""N-gram Jaccard join with signature trees.

1. Documents become sets of hashed word shingles; equal sets are one class,
   represented by one document.
2. Shingles are ordered by document frequency, rarest first.  Two sets with
   Jaccard similarity t or more share a shingle among the first
   n - ceil(t n) + 1 of either, so a representative none of whose first
   shingles occurs elsewhere has no partner and is settled.
3. The others are put into clusters: representatives that share a first
   shingle are in one cluster (connected components), so every link lies
   inside a cluster.
4. A cluster is cut into chunks of at most about ``CHUNK`` sets.  In each
   chunk, and between chunks that may still hold an unknown link, signature
   trees are traversed in pairs: a node holds the OR of its sets' token
   bitmaps and the range of their sizes, and a pair of nodes is left when its
   greatest possible overlap is too small, or when all its sets are already
   in one class.  What remains is verified on the sets themselves.

Only a spanning set of links is kept, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadflow.llm.blocks import (DOC_BITS, Block, heard, key_bits, payloads, ranges_for, runs, shared,
                                 windows, word_blocks)
from leadflow.llm.common import WORD, connected_components, internal
from leadflow.operators.stage import stage

SHINGLE = 4
PERCENT = 85
CHUNK = 2048            # sets per chunk, about
CHUNK_BYTES = 1 << 24   # bytes of sets per chunk, about
PIVOTS = 8              # sets of a large cluster that every chunk is compared with
BITMAP = 1024           # bits of a token bitmap
FANOUT = 8


# ---- sets -------------------------------------------------------------------

def block_sets(b: Block, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle) of a block, sorted, each once.  A document with
    fewer than ``n`` words has its whole sequence as one shingle."""
    h = np.ascontiguousarray(b.word_hashes()[:, 0])
    room, doc = b.room(), b.doc_of_word()
    at = np.flatnonzero(room >= n)
    docs, keys = [doc[at]], [windows(h, n)[at]]
    starts = np.cumsum(b.sizes) - b.sizes
    for size in range(1, n):
        short = np.flatnonzero(b.sizes == size)
        if len(short):
            docs.append(short)
            # a short sequence never equals a full shingle: its length goes into the hash
            keys.append((windows(h, size)[starts[short]] + np.uint64(size)) * np.uint64(0xD6E8FEB86659FD93))
    d, k = np.concatenate(docs), np.concatenate(keys)
    order = np.lexsort((k, d))
    d, k = d[order], k[order]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])]) if len(d) else np.zeros(0, bool)
    return d[new], k[new]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        yield from b.to_pylist()


_SET_INFO = "uid long, doc_id long, n_shingles long, digest binary"


def _describe(n: int, texts: bool = False):
    """Per document: its number, id, set size, a digest of the set and, with
    ``texts``, the one of its text."""
    import xxhash

    def run(batches):
        for row in _rows(batches):
            b = Block.of(row)
            d, k = block_sets(b, n)
            ends = np.cumsum(np.bincount(d, minlength=len(b.sizes)))
            raw, at = memoryview(k.tobytes()), np.concatenate([[0], ends])
            digests = [xxhash.xxh3_128_digest(raw[8 * a:8 * z]) for a, z in zip(at[:-1].tolist(), at[1:].tolist())]
            said = row["digests"] if texts else b""
            extra = {"text_digest": pa.array([said[i:i + 32] for i in range(0, len(said), 32)], pa.binary())} if texts else {}
            yield pa.RecordBatch.from_pydict({
                "uid": pa.array((b.block << DOC_BITS) + np.arange(len(b.sizes)), pa.int64()),
                "doc_id": pa.array(b.doc_ids, pa.int64()), "n_shingles": pa.array(np.diff(at), pa.int64()),
                "digest": pa.array(digests, pa.binary()), **extra})
    return run


# ---- frequencies and first shingles -----------------------------------------

def _representative(row: dict, b: Block) -> np.ndarray:
    """Which documents of the block stand for their class."""
    mask = np.zeros(len(b.sizes), bool)
    mask[np.array(row["reps"] or [], np.int64)] = True
    return mask


def _send_keys(n: int, bits: int, ranges: int):
    mask = np.uint64((1 << bits) - 1)

    def run(batches):
        for row in _rows(batches):
            b = Block.of(row)
            d, k = block_sets(b, n)
            keys, count = np.unique(k[_representative(row, b)[d]] & mask, return_counts=True)
            yield payloads(row["block"], keys, bits, ranges, count=count.astype(np.uint32))
    return run


def _frequency(keys: np.ndarray, source: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Documents that hold the key: exact up to 16, then by powers of 1.25."""
    first, size = runs(keys)
    df = np.add.reduceat(count.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    level = np.where(df <= 16, df, 17 + np.floor(np.log(np.maximum(df, 17) / 17) / np.log(1.25)))
    return np.repeat(np.minimum(level, 255).astype(np.uint8), size)


_CANDIDATES = "uid long, n_shingles long, first array<long>, shared binary"


def _candidates(n: int, percent: int, bits: int):
    """Representatives some of whose first shingles occur elsewhere: those
    shingles, and all shingles of the set that do."""
    mask = np.uint64((1 << bits) - 1)

    def run(batches):
        for row in _rows(batches):
            b = Block.of(row)
            d, k = block_sets(b, n)
            keep = _representative(row, b)[d]
            d, k = d[keep], k[keep]
            keys, which = np.unique(k & mask, return_inverse=True)
            df = heard(row["df"])[which]
            order = np.lexsort((k, k & mask, df, d))
            d, k, df = d[order], k[order], df[order]
            out = {"uid": [], "n_shingles": [], "first": [], "shared": []}
            starts, sizes = runs(d)
            for a, m in zip(starts.tolist(), sizes.tolist()):
                reach = m - -(-percent * m // 100) + 1
                first = slice(a, a + reach)
                common = df[first] > 1
                if common.any():
                    out["uid"].append((b.block << DOC_BITS) + int(d[a]))
                    out["n_shingles"].append(m)
                    out["first"].append(k[first][common].view(np.int64).tolist())
                    part = k[a:a + m]
                    out["shared"].append(np.sort(part[df[a:a + m] > 1]).tobytes())
            if out["uid"]:
                yield pa.RecordBatch.from_pydict({
                    "uid": pa.array(out["uid"], pa.int64()), "n_shingles": pa.array(out["n_shingles"], pa.int64()),
                    "first": pa.array(out["first"], pa.list_(pa.int64())), "shared": pa.array(out["shared"], pa.binary())})
    return run


# ---- signature trees ---------------------------------------------------------

class Classes:
    """Union-find over small numbers."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        self.parent[max(a, b)] = min(a, b)

    def all(self) -> np.ndarray:
        p = self.parent
        while True:
            q = p[p]
            if (q == p).all():
                self.parent = p
                return p
            p = q


class SignatureTree:
    """Levels of nodes over the given sets, leaves (single sets) first.

    bitmap: OR of the token bitmaps below; low, high: range of the set
    sizes; excess: most tokens of a set that its bitmap does not show."""

    def __init__(self, members: np.ndarray, sets: list[np.ndarray], sizes: np.ndarray):
        sketch = np.array([int(sets[i].min()) if len(sets[i]) else 0 for i in members], np.uint64)
        self.members = members[np.lexsort((sketch, sizes[members]))]      # alike sets side by side
        words = BITMAP // 64
        bits = np.zeros((len(members), words), np.uint64)
        for row, i in enumerate(self.members):
            place = (sets[i] % np.uint64(BITMAP)).astype(np.int64)
            np.bitwise_or.at(bits[row], place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
        held = np.array([len(sets[i]) for i in self.members])
        excess = held - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        size = sizes[self.members]
        self.levels = [(bits, size, size, excess)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, excess = self.levels[-1]
            at = np.arange(0, len(bits), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(excess, at)))

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``nodes``, child) for all children one level down."""
        n = len(self.levels[level - 1][0])
        kids = nodes[:, None] * FANOUT + np.arange(FANOUT)
        which, _ = np.nonzero(kids < n)
        return which, kids[kids < n]

    def classes(self, level: int, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest class below each node of a level."""
        own = classes[self.members]
        lo = hi = own
        for _ in range(level):
            at = np.arange(0, len(lo), FANOUT)
            lo, hi = np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)
        return lo, hi


def tree_links(a: SignatureTree, b: SignatureTree, sets: list[np.ndarray], sizes: np.ndarray, percent: int,
               classes: Classes, batch: int = 4096) -> list[tuple[int, int]]:
    """Dual traversal: links between the sets of ``a`` and of ``b`` (or inside
    one tree) that join two classes.  After it, any two linked sets of the two
    trees are in one class.  Pairs of nodes wait on a stack in batches, so
    memory stays bounded whatever the number of pairs."""
    same = a is b
    if not len(a.members) or not len(b.members):
        return []
    local = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    mark = np.zeros(int(local.max()) + 1, bool)
    links: list[tuple[int, int]] = []
    stack = [(len(a.levels) - 1, len(b.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]

    def may_link(la, lb, i, j):
        """Node pairs whose greatest possible overlap is large enough."""
        bits_a, low_a, high_a, ex_a = (x[i] for x in a.levels[la])
        bits_b, low_b, high_b, ex_b = (x[j] for x in b.levels[lb])
        least = (percent * (low_a + low_b) + 99 + percent) // (100 + percent)
        overlap = np.bitwise_count(bits_a & bits_b).sum(axis=1).astype(np.int64) + np.minimum(ex_a, ex_b)
        overlap = np.minimum(overlap, np.minimum(high_a, high_b))
        return (100 * high_b >= percent * low_a) & (100 * high_a >= percent * low_b) & (overlap >= least)

    def verify(i, j):
        """Leaf pairs, by first set: overlap counted against a marked set."""
        order = np.argsort(i, kind="stable")
        i, j = a.members[i[order]], b.members[j[order]]
        first, count = runs(i)
        for s, n in zip(first.tolist(), count.tolist()):
            x, ys = int(i[s]), j[s:s + n]
            now = classes.all()
            ys = ys[now[ys] != now[x]]
            if not len(ys):
                continue
            mine = local[starts[x]:starts[x + 1]]
            mark[mine] = True
            for y in ys.tolist():
                both = int(np.count_nonzero(mark[local[starts[y]:starts[y + 1]]]))
                if (100 + percent) * both >= percent * int(sizes[x] + sizes[y]) and classes.find(x) != classes.find(y):
                    classes.join(x, y)
                    links.append((x, y))
            mark[mine] = False

    while stack:
        la, lb, i, j = stack.pop()
        if len(i) > batch:
            stack.append((la, lb, i[batch:], j[batch:]))
            i, j = i[:batch], j[:batch]
        now = classes.all()
        lo_a, hi_a = a.classes(la, now)
        lo_b, hi_b = b.classes(lb, now)
        settled = (lo_a[i] == hi_a[i]) & (lo_b[j] == hi_b[j]) & (lo_a[i] == lo_b[j])
        i, j = i[~settled], j[~settled]
        ok = may_link(la, lb, i, j)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if la == 0 and lb == 0:
            keep = i < j if same else np.ones(len(i), bool)
            verify(i[keep], j[keep])
            continue
        if la >= lb:
            which, kids = a.children(la, i)
            i, j, la = kids, j[which], la - 1
        if lb > la:
            which, kids = b.children(lb, j)
            i, j, lb = i[which], kids, lb - 1
        if same and la == lb:
            half = i <= j
            i, j = i[half], j[half]
        stack.append((la, lb, i, j))
    return links


# ---- clusters ---------------------------------------------------------------

_LINKS = "src long, dst long"


def _in_chunk(percent: int):
    """Links inside one chunk, its cluster's pivots included."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("uid")
        sets, sizes, uid = _sets(pdf)
        tree = SignatureTree(np.arange(len(uid)), sets, sizes)
        return _as_links(tree_links(tree, tree, sets, sizes, percent, Classes(len(uid))), uid)
    return run


def _between(percent: int):
    """Links between two chunks of a cluster, given the classes known so far."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sets, sizes, uid = _sets(pdf)
        classes = Classes(len(uid))
        first: dict[int, int] = {}
        for i, c in enumerate(pdf["comp"].tolist()):
            classes.join(i, first.setdefault(c, i))
        right = pdf["right"].to_numpy(bool)
        a = SignatureTree(np.flatnonzero(~right), sets, sizes)
        b = SignatureTree(np.flatnonzero(right), sets, sizes)
        return _as_links(tree_links(a, b, sets, sizes, percent, classes), uid)
    return run


def _sets(pdf: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    return ([np.frombuffer(x, "<u8") for x in pdf["shared"]], pdf["n_shingles"].to_numpy(np.int64),
            pdf["uid"].to_numpy(np.int64))


def _as_links(links: list[tuple[int, int]], uid: np.ndarray) -> pd.DataFrame:
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return pd.DataFrame({"src": uid[pairs[:, 0]], "dst": uid[pairs[:, 1]]})


def cluster_links(cand: DataFrame, percent: int, chunk: int = CHUNK) -> DataFrame:
    """Links (src, dst) that span every class of linked candidates.

    ``cand``: uid, n_shingles, shared, cluster.  Clusters of one set are
    done; larger ones, by number or bytes, are cut into chunks by a hash of
    the uid."""
    sizes = cand.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("shared")).alias("bytes"))
    sizes = sizes.filter("n > 1").withColumn(
        "chunks", F.greatest(F.ceil(F.col("n") / chunk), F.ceil(F.col("bytes") / CHUNK_BYTES)).cast("int"))
    placed = stage(cand.join(sizes, "cluster")
                   .withColumn("chunk", F.pmod(F.xxhash64("uid"), F.col("chunks")).cast("int")), "nj_chunks")
    cols = ["cluster", "chunk", "uid", "n_shingles", "shared"]
    # the pivots of a cluster in several chunks: its least PIVOTS uids of one chunk
    large = placed.filter("chunks > 1")
    pivots = (large.filter("chunk = 0").groupBy("cluster")
              .agg(F.slice(F.sort_array(F.collect_list("uid")), 1, PIVOTS).alias("p"))
              .select("cluster", F.explode("p").alias("uid")))
    spread = (large.join(pivots, ["cluster", "uid"], "left_semi").filter("chunk = 0")
              .withColumn("chunk", F.explode(F.sequence(F.lit(1), F.col("chunks") - 1))).select(*cols))
    inside = stage(placed.select(*cols).unionByName(spread).groupBy("cluster", "chunk")
                   .applyInPandas(_in_chunk(percent), _LINKS), "nj_links")
    if large.isEmpty():
        return inside
    # chunk pairs of a cluster that are not known to be all one class
    comp = connected_components(inside)
    known = stage(large.join(comp, large["uid"] == comp["node"], "left")
                  .select(*cols, F.coalesce("comp", "uid").alias("comp")), "nj_known")
    per = known.groupBy("cluster", "chunk").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    other = per.withColumnsRenamed({"chunk": "chunk2", "lo": "lo2", "hi": "hi2"})
    open_ = (per.join(other, "cluster").filter("chunk < chunk2")
             .filter("not (lo = hi and lo2 = hi2 and lo = lo2)").select("cluster", "chunk", "chunk2"))
    open_ = stage(open_, "nj_open")
    left = known.join(open_, ["cluster", "chunk"]).withColumn("right", F.lit(False))
    right = (known.withColumnRenamed("chunk", "chunk2").join(open_, ["cluster", "chunk2"])
             .withColumn("right", F.lit(True)))
    across = (left.unionByName(right).groupBy("cluster", "chunk", "chunk2")
              .applyInPandas(_between(percent), _LINKS))
    return inside.unionByName(stage(across, "nj_across"))


# ---- the join ---------------------------------------------------------------

def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int,
             texts: bool = False) -> DataFrame:
    """uid, doc_id, n_shingles, root (uid of the class) for every document;
    with ``texts`` also text_digest, the SHA-256 of its text."""
    blocks = word_blocks(docs, id_col, text_col, lower=True, digests=texts)
    extra = ["text_digest"] if texts else []
    info = stage(blocks.select("block", "n_words", "doc_ids", "sizes", "vocabulary", "codes",
                               *(["digests"] if texts else []))
                 .mapInArrow(_describe(shingle, texts), _SET_INFO + (", text_digest binary" if texts else "")), "nj_sets")
    blocks = blocks.drop("digests")
    # documents with equal sets: one row per digest; empty sets link with nothing
    reps = (info.filter("n_shingles > 0").groupBy("digest", "n_shingles")
            .agg(F.min("uid").alias("rep")))
    reps = stage(reps, "nj_reps")
    of_block = (reps.groupBy(F.shiftright("rep", DOC_BITS).alias("block"))
                .agg(F.collect_list((F.col("rep").bitwiseAND((1 << DOC_BITS) - 1))).alias("reps")))
    total = info.agg(F.sum("n_shingles")).first()[0] or 0
    bits, ranges = key_bits(total), ranges_for(total)
    blocks = blocks.join(of_block, "block", "left")
    sent = blocks.mapInArrow(_send_keys(shingle, bits, ranges), "range long, block long, keys binary, count binary")
    df = shared(sent, {"count": np.uint32}, _frequency, "df")
    cand = stage(blocks.join(df, "block", "left").mapInArrow(_candidates(shingle, percent, bits), _CANDIDATES),
                 "nj_candidates")
    # representatives that share a first shingle: each with the least of them
    at = cand.select("uid", F.explode("first").alias("t"))
    # (written first, so the rows of a frequent shingle can be split in the join)
    least = stage(at.groupBy("t").agg(F.min("uid").alias("m"), F.count(F.lit(1)).alias("n")).filter("n > 1"),
                  "nj_least")
    near = at.join(least, "t").filter("uid <> m").select(F.col("uid").alias("src"), F.col("m").alias("dst")).distinct()
    cluster = connected_components(near)
    members = cand.join(cluster, cand["uid"] == cluster["node"]).select(
        "uid", "n_shingles", "shared", F.col("comp").alias("cluster"))
    comp = connected_components(cluster_links(members, percent))
    rooted = reps.join(comp, reps["rep"] == comp["node"], "left").select(
        "digest", "n_shingles", F.coalesce("comp", "rep").alias("root"))
    # a class of equal sets may hold a third of all documents; that side of
    # the join is split by the skew handling, as each row needs one match
    return info.join(rooted, ["digest", "n_shingles"], "left").select(
        "uid", "doc_id", "n_shingles", F.coalesce("root", "uid").alias("root"), *extra)


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    Words are lower-cased (A-Z); a set holds the distinct ``shingle``-word
    runs, or the whole sequence of a shorter text; a null or wordless text
    has the empty set and links with nothing.  Two documents link when
    100 * intersection >= percent * union.  component_id is the smallest
    doc_id of the class (null if it has none).  Rows that share an id are
    documents of their own.  Shingles are compared by 64 bits of hash.  A very
    long text is a block of its own, held whole by one task.  Empty input
    gives an empty result; only the id and text columns are read."""
    rows = stage(_classes(docs, id_col, text_col, shingle, percent), "nj_rows")
    # written, so that the join below has a plain exchange on either side and
    # the rows of a large class can be split over tasks
    least = stage(rows.groupBy("root").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
                  .filter("n > 1").drop("n"), "nj_least")
    return rows.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                     percent: int = 80) -> DataFrame:
    """``docs`` with one document of each class of near duplicates, the one
    with the smallest id (null ids last), then the least text digest; of
    wholly repeated rows exactly one (columns unchanged).  Documents without
    words all stay.  Ids may be null or shared: rows are told apart by id and
    text.  Texts are shuffled once at most."""
    cols = docs.columns
    key = [internal(f"_{n}", cols) for n in ("id", "null_id", "digest")]
    nth = internal("_nth", cols)
    rows = stage(_classes(docs, id_col, text_col, shingle, percent, texts=True), "nj_rows")
    # rows of one key have the same text, so the same class: a key wins once at most
    best = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                          F.col("text_digest").alias("digest"), F.col("uid").alias("uid")))
    winners = (rows.filter("n_shingles > 0").groupBy("root").agg(best.alias("w"))
               .select(*[F.col(f"w.{c}").alias(f"{k}_w") for c, k in zip(("id", "null_id", "digest"), key)]))
    number, t = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    has_words = F.coalesce(t.rlike(WORD), F.lit(False))
    marked = (docs.filter(has_words).withColumn(key[0], F.coalesce(number, F.lit(0))).withColumn(key[1], number.isNull())
              .withColumn(key[2], F.unhex(F.sha2(t.cast("binary"), 256)))
              .withColumn(nth, F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0))))
              .filter(F.col(nth) == 1))
    same = F.lit(True)
    for k in key:                                # no key is null: the join keeps the window's partitions
        same = same & (F.col(k) == F.col(f"{k}_w"))
    out = [F.col(f"`{c}`") for c in cols]
    return marked.join(winners, same, "left_semi").select(*out).union(docs.filter(~has_words).select(*out))
