"""Substring dedup by level-wise doubling.

Windows of ``base`` words are compared first; a window of twice the length is
a candidate only where both of its halves repeat, and so on.

``substring_dedup`` doubles up to its window, whose repeats it removes: longer
ones are covered by their windows.  Only at that length does a block send, for
each distinct candidate, the document that holds it first; the answer says
whether that is the first of the corpus.  ``repeat_lengths`` goes on until no
candidate survives and tells how long the repeated passages are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.blocks import (Block, fold, heard, key_bits, payloads, ranges_for, runs,
                                 shared, windows, word_blocks)

WINDOW = 20
BASE = 10
_LAST = np.int64(np.iinfo(np.int64).max)      # null ids come after all others


def levels_up_to(window: int, base: int) -> list[int]:
    """base, 2 base, ... window; window must be base times a power of two."""
    out = [base]
    while out[-1] < window:
        out.append(2 * out[-1])
    if out[-1] != window:
        raise ValueError(f"window {window} is not {base} times a power of two")
    return out


class _Search:
    """Candidates of one block, level by level."""

    def __init__(self, block: Block, base: int, bits: int):
        self.block, self.size, self.mask = block, base, np.uint64((1 << bits) - 1)
        self.hash = block.word_hashes()
        self.room = block.room()
        self.h = windows(np.ascontiguousarray(self.hash[:, 0]), base)
        self.at = np.flatnonzero(self.room >= base)        # places of the candidate windows

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys, ascending; the candidates' index into them; counts."""
        return np.unique(self.h[self.at] & self.mask, return_inverse=True, return_counts=True)

    def double(self, said: np.ndarray) -> None:
        """Keep what repeats, here or elsewhere; go to twice the length."""
        _, which, count = self.keys()
        repeats = np.zeros(len(self.room), bool)
        repeats[self.at] = (count[which] > 1) | (said[which] > 0)
        n = self.size
        self.h = fold(self.h[:-n], self.h[n:]) if len(self.h) > n else self.h[:0]
        self.size = 2 * n
        places = self.at[repeats[self.at] & (self.room[self.at] >= self.size)]
        self.at = places[repeats[places + n]]

    def first_places(self) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
        """Candidates in order of (key, check, document, place), which of them
        lead their run of equal words, and what is sent of the leaders."""
        check = windows(np.ascontiguousarray(self.hash[:, 1]), self.size)[self.at] >> np.uint64(32)
        ids = np.array([_LAST if d is None else d for d in self.block.doc_ids], np.int64)
        doc = ids[self.block.doc_of_word()[self.at]]
        key = self.h[self.at]
        order = np.lexsort((self.at, doc, check, key))
        k, c = key[order], check[order]
        lead = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])]) if len(k) else np.zeros(0, bool)
        first = order[lead]
        return order, lead, {"keys": key[first], "check": check[first].astype(np.uint32),
                             "doc": doc[first].view(np.uint64) ^ np.uint64(1 << 63)}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        yield from b.to_pylist()


def _searched(row: dict, levels: list[int], bits: int) -> _Search:
    s = _Search(Block.of(row), levels[0], bits)
    for n in levels[:-1]:
        if f"said{n}" not in row:
            break
        s.double(heard(row[f"said{n}"]))
    return s


def _send(levels: list[int], level: int, bits: int, ranges: int):
    def run(batches):
        for row in _rows(batches):
            s = _searched(row, levels, bits)
            if level < levels[-1]:
                yield payloads(row["block"], s.keys()[0], bits, ranges)
            else:
                sent = s.first_places()[2]
                yield payloads(row["block"], sent["keys"], 64, ranges, check=sent["check"], doc=sent["doc"])
    return run


def _elsewhere(keys: np.ndarray, source: np.ndarray) -> np.ndarray:
    first, size = runs(keys)
    return np.repeat((size > 1).astype(np.uint8), size)


def _is_first(keys, source, check, doc) -> np.ndarray:
    same = (keys[1:] == keys[:-1]) & (check[1:] == check[:-1])
    return np.concatenate([[1], (~same).astype(np.uint8)]).astype(np.uint8)


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                   ("kept_text", pa.string()),
                   ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _remove(levels: list[int], bits: int):
    def run(batches):
        for row in _rows(batches):
            s = _searched(row, levels, bits)
            order, lead, _ = s.first_places()
            stays = np.zeros(len(order), bool)
            stays[lead] = heard(row["first"]) > 0
            gone = s.at[order[~stays]]
            edge = np.zeros(len(s.room) + 1, np.int64)
            np.add.at(edge, gone, 1)
            np.add.at(edge, gone + s.size, -1)
            removed = np.cumsum(edge[:-1]) > 0
            yield _documents(s.block, removed)
    return run


def _documents(b: Block, removed: np.ndarray) -> pa.RecordBatch:
    vocabulary = np.array(b.vocabulary, object)
    rows, start = [], 0
    for doc, n in zip(b.doc_ids, b.sizes.tolist()):
        gone = removed[start:start + n]
        kept = b" ".join(vocabulary[b.codes[start:start + n][~gone]].tolist()) if n else b""
        step = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        rows.append({"doc_id": doc, "n_words": n, "n_removed": int(gone.sum()), "kept_text": kept.decode(),
                     "removed": [{"start": int(a), "end": int(z)} for a, z in zip(step[::2], step[1::2])]})
        start += n
    return pa.RecordBatch.from_pylist(rows, schema=_KEPT)


def _ask(blocks: DataFrame, levels: list[int], bits: int, ranges: int) -> DataFrame:
    """``blocks`` with the answers of every level, "first" for the last one."""
    for n in levels:
        last = n == levels[-1]
        columns = {"check": np.uint32, "doc": np.uint64} if last else {}
        schema = "range long, block long, keys binary" + (", check binary, doc binary" if last else "")
        sent = blocks.mapInArrow(_send(levels, n, bits, ranges), schema)
        name = "first" if last else f"said{n}"
        blocks = blocks.join(shared(sent, columns, _is_first if last else _elsewhere, name), "block", "left")
    return blocks


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    base: int = BASE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, removed for every row.

    A word goes when a window of ``window`` words covers it whose word
    sequence also starts earlier: in a smaller doc_id or earlier in the same
    document.  Windows are judged on the input.  removed: spans of word
    numbers; kept_text: the other words joined by one space.  Null texts have
    no words; rows with a null id come after all others; rows that share an
    id are told apart by their place in the input.  Windows are compared by
    96 bits of hash.  Empty input gives an empty result; only the id and text
    columns are read."""
    levels = levels_up_to(window, base)
    blocks = word_blocks(docs, id_col, text_col)
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    bits = key_bits(total)
    asked = _ask(blocks, levels, bits, ranges_for(total))
    kind = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start:int,end:int>>"
    return asked.mapInArrow(_remove(levels, bits), kind)


# ---- doubling until no candidate survives -----------------------------------

class _Doubling:
    """Candidates of one block with both hashes, kept at the places that are
    still candidates, so a level costs what is left of the one before."""

    def __init__(self, block: Block, base: int):
        self.block, self.size, self.room = block, base, block.room()
        word = block.word_hashes()
        self.key, self.check = (windows(np.ascontiguousarray(word[:, i]), base) for i in (0, 1))
        self.at = np.flatnonzero(self.room >= base)
        self.reached = np.zeros(len(self.room), np.int64)   # longest window from a place that repeats

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (key, check) of the candidates, ascending; the candidates'
        index into them; counts."""
        key, check = self.key[self.at], (self.check[self.at] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((check, key))
        k, c = key[order], check[order]
        lead = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])]) if len(k) else np.zeros(0, bool)
        which = np.empty(len(k), np.int64)
        which[order] = np.cumsum(lead) - 1
        return k[lead], c[lead], which, np.bincount(which, minlength=int(lead.sum()))

    def double(self, said: np.ndarray) -> None:
        """Note what repeats, here or elsewhere; go to twice the length."""
        _, _, which, count = self.pairs()
        self.at = self.at[(count[which] > 1) | (said[which] > 0)]
        n = self.size
        self.reached[self.at] = n
        there = self.at[self.room[self.at] >= 2 * n]
        self.at = there[self.reached[there + n] == n]
        for name in ("key", "check"):
            old = getattr(self, name)
            new = np.zeros_like(old)
            new[self.at] = fold(old[self.at], old[self.at + n])
            setattr(self, name, new)
        self.size = 2 * n


def _doubled(row: dict, base: int, answered: int) -> _Doubling:
    d = _Doubling(Block.of(row), base)
    for level in range(answered):
        if not len(d.at):
            break
        d.double(heard(row[f"said{level}"]))
    return d


def _send_pairs(base: int, answered: int, ranges: int):
    def run(batches):
        for row in _rows(batches):
            d = _doubled(row, base, answered)
            if len(d.at):
                keys, check, _, _ = d.pairs()
                yield payloads(row["block"], keys, 64, ranges, check=check)
    return run


def _pair_elsewhere(keys: np.ndarray, source: np.ndarray, check: np.ndarray) -> np.ndarray:
    change = (keys[1:] != keys[:-1]) | (check[1:] != check[:-1])
    first = np.flatnonzero(np.concatenate([[True], change]))
    size = np.diff(np.concatenate([first, [len(keys)]]))
    return np.repeat((size > 1).astype(np.uint8), size)


def passages(reached: np.ndarray) -> list[dict]:
    """Spans (start, end, window) of one document: consecutive places that
    reached the same window, to the end of the last one's window; a span
    that lies in another one is left out."""
    edge = np.flatnonzero(np.concatenate([[True], reached[1:] != reached[:-1]])) if len(reached) else np.zeros(0, int)
    out, far = [], 0
    for a, z in zip(edge.tolist(), [*edge[1:].tolist(), len(reached)]):
        n = int(reached[a])
        if n and z - 1 + n > far:
            far = z - 1 + n
            out.append({"start": a, "end": far, "window": n})
    return out


_LENGTHS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("longest", pa.int64()),
                      ("repeats", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                                      ("window", pa.int32())])))])


def _tell(base: int, answered: int):
    def run(batches):
        for row in _rows(batches):
            d = _doubled(row, base, answered)
            rows, start = [], 0
            for doc, n in zip(d.block.doc_ids, d.block.sizes.tolist()):
                spans = passages(d.reached[start:start + n])
                rows.append({"doc_id": doc, "n_words": n, "longest": max((p["end"] - p["start"] for p in spans), default=0),
                             "repeats": spans})
                start += n
            yield pa.RecordBatch.from_pylist(rows, schema=_LENGTHS)
    return run


def repeat_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: int = BASE) -> DataFrame:
    """doc_id, n_words, longest, repeats for every row of ``docs``.

    Windows of ``base`` words found at another place too (of any document,
    the same one included) are doubled for as long as a candidate survives.
    repeats: spans of word numbers whose windows of ``window`` words, the
    longest doubling that repeats there, all occur elsewhere; a passage of G
    words that repeats as a whole is one span of G words (spans that adjoin
    run together, and a span inside another is left out).  longest: words of
    the longest span, 0 without any.  First occurrences are told as well as
    later ones.  Null and empty texts have no words; rows with a null id or
    the id of another row are told each by itself; a text repeated as a row
    repeats wholly.  Windows are compared by 96 bits of hash.  Empty input
    gives an empty result; only the id and text columns are read.  A text of
    2^k times ``base`` words takes at most k + 1 levels; each reads the blocks
    once more and sends only what is still a candidate."""
    blocks = word_blocks(docs, id_col, text_col)
    ranges = ranges_for(blocks.agg(F.sum("n_words")).first()[0] or 0)
    answered = 0
    while True:
        sent = blocks.mapInArrow(_send_pairs(base, answered, ranges), "range long, block long, keys binary, check binary")
        said = shared(sent, {"check": np.uint32}, _pair_elsewhere, f"said{answered}")
        if said.isEmpty():
            break
        blocks = blocks.join(said, "block", "left")
        answered += 1
    kind = "doc_id long, n_words long, longest long, repeats array<struct<start:int,end:int,window:int>>"
    return blocks.mapInArrow(_tell(base, answered), kind)
