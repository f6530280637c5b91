"""Periodic runs of words, by maximal pairs on the LCP-interval tree.

A run is a stretch of consecutive words with smallest period q and at least
max(``min_words``, 2q) words that no neighbouring word extends.  Two suffixes
at distance d whose common prefix has l words, and whose words to the left
differ, are a maximal pair: the stretch from the first on of d + l words has
period d and cannot be extended.  So the runs are exactly the maximal pairs
with l >= d and d + l >= ``min_words``, the least d of each stretch.

Per task, documents are taken together up to ``BATCH_WORDS`` words:

1. Documents without any repeated run of ceil(min_words / 2) words hold no
   run, as l >= max(d, min_words - d).
2. The suffixes of the others are sorted by prefix doubling; words carry their
   document's number, so suffixes of two documents have nothing in common.
   The rank tables of the doublings give the common prefixes.
3. The LCP intervals are built bottom-up.  A node holds its positions by the
   word to their left, each list ascending; when a child is merged, each
   position of the smaller side meets the lists of other words in the larger
   one, within the distance that the constraint allows.  No pair with equal
   left words is looked at, so a word repeated n times costs n steps, not n².
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.llm.blocks import fold, runs, windows
from leadflow.llm.common import words

MIN_WORDS = 12
BATCH_WORDS = 1 << 18       # words taken together (a longer text is taken alone)


# ---- suffixes ---------------------------------------------------------------

def rank_tables(codes: np.ndarray) -> list[np.ndarray]:
    """Table k: for each place the rank of the 2**k codes from it on, equal
    iff these are; the last table has no equal ranks.  The last code occurs
    once."""
    order = np.argsort(codes, kind="stable")
    first, size = runs(codes[order])
    rank = np.empty(len(codes), np.int32)
    rank[order] = np.repeat(first, size)
    tables, step, live = [rank], 1, order[np.repeat(size, size) > 1]
    while len(live):                    # the places whose rank others share; groups are whole
        a, b = rank[live], rank[live + step]
        o = np.lexsort((b, a))
        live, a, b = live[o], a[o], b[o]
        group = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        size = np.diff(np.concatenate([group, [len(live)]]))
        old, n = runs(a)
        rank = rank.copy()
        rank[live] = a + (np.repeat(group, size) - np.repeat(old, n))
        tables.append(rank)
        live, step = live[np.repeat(size, size) > 1], step * 2
    return tables


def common_prefix(tables: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Codes that the suffixes from ``x`` and from ``y`` (x != y) have in common."""
    n = np.zeros(len(x), np.int64)
    for k in range(len(tables) - 1, -1, -1):
        n += (tables[k][x + n] == tables[k][y + n]).astype(np.int64) << k
    return n


# ---- the LCP-interval tree --------------------------------------------------

class Node:
    """Positions below an LCP interval: ascending, and by the code to their left."""

    __slots__ = ("all", "by_left")

    def __init__(self, place: int, left: int):
        self.all, self.by_left = [place], {left: [place]}

    def pairs(self, other: Node, left: list[int], reach: int, least: int) -> Iterator[tuple[int, int]]:
        """(p, q), p < q: one of each node, different left codes, distance
        from ``least`` to ``reach``."""
        for code, places in self.by_left.items():
            strange = len(other.by_left) - (code in other.by_left)
            if not strange:
                continue
            for p in places:
                a, z = bisect_left(other.all, p - reach), bisect_right(other.all, p + reach)
                if z - a <= strange:                # fewer places in reach than lists
                    near = [q for q in other.all[a:z] if left[q] != code]
                else:
                    near = [q for c, those in other.by_left.items() if c != code
                            for q in those[bisect_left(those, p - reach):bisect_right(those, p + reach)]]
                for q in near:
                    if abs(p - q) >= least:
                        yield (p, q) if p < q else (q, p)

    def take(self, other: Node) -> None:
        for mine, more in [(self.all, other.all),
                           *((self.by_left.setdefault(c, []), m) for c, m in other.by_left.items())]:
            if len(more) < 8:
                for p in more:
                    insort(mine, p)
            else:
                mine += more
                mine.sort()


def interval_pairs(places: list[int], lcp: list[int], left: list[int], min_words: int) -> list[tuple[int, int, int]]:
    """(p, q, common words) of the maximal pairs that meet the constraint among
    suffixes ``places`` in their order; ``lcp[k]``: codes that the k-th and the
    next have in common.  Bottom-up with a stack of open intervals."""
    out: list[tuple[int, int, int]] = []

    def merged(a: Node, b: Node, l: int) -> Node:
        small, large = (a, b) if len(a.all) <= len(b.all) else (b, a)
        out.extend((p, q, l) for p, q in small.pairs(large, left, l, min_words - l))
        large.take(small)
        return large

    open_: list[tuple[int, Node]] = []
    for place, l in zip(places, lcp + [-1]):        # after the last one all intervals close
        node = Node(place, left[place])
        while open_ and open_[-1][0] > l:
            depth, parent = open_.pop()
            node = merged(parent, node, depth)
        if open_ and open_[-1][0] == l:
            open_[-1] = (l, merged(open_[-1][1], node, l))
        else:
            open_.append((l, node))
    return out


def find_runs(codes: np.ndarray, sizes: np.ndarray, min_words: int) -> tuple[np.ndarray, ...]:
    """(document, start, length, period) of every run, by document, start and
    period.  ``codes``: the words' numbers, documents one after the other."""
    none = (np.zeros(0, np.int64),) * 4
    ends = np.cumsum(sizes)
    least = -(-min_words // 2)
    # 1: documents with a repeated stretch of ``least`` words
    doc = np.repeat(np.arange(len(sizes)), sizes)
    key = fold(codes.astype(np.uint64) + np.uint64(1), doc.astype(np.uint64) + np.uint64(1))
    at = np.flatnonzero(ends[doc] - np.arange(len(codes)) >= least)
    if not len(at):
        return none
    gram, where = windows(key, least)[at], doc[at]
    order = np.argsort(gram, kind="stable")
    first, count = runs(gram[order])
    kept = np.unique(where[order[first[count > 1]]])
    if not len(kept):
        return none
    # 2: their words, a code of its own after each document
    here = np.isin(doc, kept)
    number = np.searchsorted(kept, doc[here])
    n = sizes[kept]
    begin = np.cumsum(n + 1) - n - 1
    s = np.empty(int(n.sum()) + len(kept), np.int64)
    span = int(codes.max()) + 2
    s[np.arange(len(number)) + number] = codes[here] + number * span
    s[begin + n] = np.arange(len(kept)) * span + span - 1
    tables = rank_tables(s)
    order = np.empty(len(s), np.int64)
    order[tables[-1]] = np.arange(len(s))
    short = tables[min(least.bit_length() - 1, len(tables) - 1)]
    at = np.flatnonzero(short[order[:-1]] == short[order[1:]])
    lcp = np.zeros(len(s), np.int64)
    lcp[at] = common_prefix(tables, order[at], order[at + 1])
    # 3: stretches of suffixes with ``least`` words in common, each a tree
    deep = np.concatenate([lcp >= least, [False]])
    a = np.flatnonzero(deep[:-1] & ~np.concatenate([[False], deep[:-2]]))
    z = np.flatnonzero(deep[:-1] & ~deep[1:])
    left = np.concatenate([[-1], s[:-1]])
    two = a == z                                    # trees of two suffixes need no tree
    p, q, l = order[a[two]], order[a[two] + 1], lcp[a[two]]
    p, q = np.minimum(p, q), np.maximum(p, q)
    ok = (left[p] != left[q]) & (q - p <= l) & (q - p + l >= min_words)
    found = [np.stack([p[ok], q[ok], l[ok]], axis=1)]
    if (~two).any():
        by_place = left.tolist()
        for i, j in zip(a[~two].tolist(), z[~two].tolist()):
            pairs = interval_pairs(order[i:j + 2].tolist(), lcp[i:j + 1].tolist(), by_place, min_words)
            if pairs:
                found.append(np.array(pairs, np.int64))
    p, q, l = np.concatenate(found).T
    length, period = q - p + l, q - p
    order = np.lexsort((period, length, p))
    p, length, period = p[order], length[order], period[order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (length[1:] != length[:-1])   # multiples of the smallest period
    p, length, period = p[new], length[new], period[new]
    of = np.searchsorted(begin, p, "right") - 1
    order = np.lexsort((period, p))
    return kept[of][order], (p - begin[of])[order], length[order], period[order]


# ---- documents --------------------------------------------------------------

RUN = "struct<start: long, length: long, period: long>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, kept_text string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def _rows(ids: list, texts: list[list[bytes]], codes: list[np.ndarray], min_words: int) -> pa.RecordBatch:
    sizes = np.array([len(t) for t in texts], np.int64)
    doc, start, length, period = find_runs(np.concatenate(codes), sizes, min_words)
    of = np.searchsorted(doc, np.arange(len(ids) + 1))
    kept = []
    for k, said in enumerate(texts):
        if of[k] < of[k + 1]:
            keep = np.ones(len(said), bool)
            for i in range(of[k], of[k + 1]):
                keep[start[i] + period[i]:start[i] + length[i]] = False
            said = [said[i] for i in np.flatnonzero(keep).tolist()]
        kept.append(b" ".join(said))
    spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(_RUN))
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
        pa.ListArray.from_arrays(pa.array(of, pa.int32()), spans), pa.array(kept, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "runs", "kept_text"])


def _search(min_words: int, batch_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, codes, numbers, held = [], [], [], _Codes(), 0
        for b in batches:
            for doc, text in zip(b.column(0), b.column(1).cast(pa.binary())):
                said = (text.as_py() or b"").split()            # bytes: ASCII white space only
                if ids and (held + len(said) > batch_words or len(ids) >= batch_words):
                    yield _rows(ids, texts, codes, min_words)
                    ids, texts, codes, numbers, held = [], [], [], _Codes(), 0
                ids.append(doc.as_py())
                texts.append(said)
                codes.append(np.fromiter(map(numbers.__getitem__, said), np.int64, len(said)))
                held += len(said)
        if ids:
            yield _rows(ids, texts, codes, min_words)
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                  batch_words: int = BATCH_WORDS) -> DataFrame:
    """doc_id, n_words, runs, kept_text for every row of ``docs``.

    ``runs`` lists (start, length, period) of every run by start, then period,
    words numbered from 0; ``kept_text`` is the text without the words that
    some run repeats, those after its first period, joined by one space.
    Words are maximal runs outside ``[\\x20\\x09-\\x0D]``, compared as they
    stand.  A null, empty or wordless text has no words, no runs and an empty
    kept text.  Rows that share an id, have none or are repeated are each a
    document; the order of rows changes nothing; empty input gives an empty
    result; only the id and text columns are read.  A text is one row and so
    one task's work; one longer than ``batch_words`` is searched alone, in
    about 100 bytes a word."""
    d = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    return d.mapInArrow(_search(min_words, batch_words), SCHEMA)


def longest(found: Column) -> Column:
    """The run of greatest length (ties: smallest start, then period), or null."""
    first = F.array_max(F.transform(found, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                              (-r["period"]).alias("period"))))
    return F.when(F.size(found) > 0, F.struct((-first["start"]).alias("start"), first["length"].alias("length"),
                                              (-first["period"]).alias("period")))


def listing(found: Column) -> Column:
    """``start,length,period`` and a line feed for every run."""
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return F.array_join(F.transform(found, line), "")


def repeat_tails(text: Column, doc_id: Column) -> Column:
    """``text`` with a periodic tail where h = crc32(doc_id as decimal text)
    ends in 0: with n words (n > 0) and g = floor(h / 10), word i >= a becomes
    word a + (i - a) % p, a = g % n, p = 1 + floor((n - a) / (3 + g % 8)).
    Other texts, and those of rows without an id, stay as they are."""
    w = words(text)
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, n = F.floor(h / 10).cast("long"), F.size(w).cast("long")
    a = F.pmod(g, n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
    # whole arrays at a time: a lambda would split the text anew for each word
    turns = F.array_repeat(F.slice(w, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int"))
    tail = F.slice(F.flatten(turns), F.lit(1), (n - a).cast("int"))
    planted = F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), " ")).otherwise(text)
    return F.when(h % 10 == 0, planted).otherwise(text)
