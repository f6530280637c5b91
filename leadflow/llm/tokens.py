"""Token ids of whole texts.

``ByteEncoder`` is for byte-level vocabularies: the merges of the vocabulary
file, run by tiktoken, which gives the same ids as the tokenizers library in
less time and remembers nothing.

``PieceEncoder`` is for a vocabulary that drops white space: a text's ids are
the ids of its words one after the other, so each word is encoded once.  A
worker remembers the words it has met, up to about ``PIECE_BYTES`` of memory,
then it starts anew, which changes nothing but speed.

A special token's string in a text gives that token's id, as the tokenizers
library does unless told otherwise; ``plain`` makes it ordinary text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

PIECE_BYTES = 128 << 20     # memory of remembered pieces, about
_PIECE_COST = 190           # bytes of one, besides its ids
# White space beyond ASCII: texts with any of it are encoded in one call.
_WIDE_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_PIECE = re.compile(r"[^\x20\x09-\x0D]+")
# fixed value: how byte-level vocabularies cut a text before any merge
_BYTE_LEVEL_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _tokenizer(path: str, plain: bool):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = plain
    return t, [] if plain else [x.content for x in t.get_added_tokens_decoder().values()]


class _Codes(dict):
    """A number per piece; pieces met for the first time wait in ``new``."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = code = len(self)
        self.new.append(piece)
        return code


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if
    it is a printing Latin-1 character, else the next unused one from 256 on."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printing]
    return {b: chr(256 + k) for k, b in enumerate(other)}


_LETTERS = _byte_letters()
_BYTES = {letter: b for b, letter in _LETTERS.items()}


def byte_of_letter(letter: str) -> int:
    """The byte that a byte-level vocabulary writes as ``letter``."""
    return _BYTES[letter] if letter in _BYTES else ord(letter)


class ByteEncoder:
    """``encode(texts)``: a uint32 array per text, the tokenizer's own ids."""

    def __init__(self, path: str, plain: bool = False):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) \
                or cut.get("add_prefix_space"):
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        self.tokenizer, self.special = _tokenizer(path, plain)
        added = set(self.tokenizer.get_added_tokens_decoder())
        self.entries = {k: e.encode() if k in added else bytes(map(byte_of_letter, e))
                        for e, k in self.tokenizer.get_vocab().items()}
        self.merges = tiktoken.Encoding("merges", pat_str=_BYTE_LEVEL_CUTS, special_tokens={},
                                        mergeable_ranks={e: k for k, e in self.entries.items() if k not in added})

    def encode(self, many: list[str]) -> Iterator[np.ndarray]:
        for text in many:
            if any(s in text for s in self.special):
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                yield np.array(self.merges.encode_ordinary(text), np.uint32)


# letters of Latin-1, then marks: two runs that the vocabulary splits
_SIMPLE = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,;:!?]*)")


def _as_letters(part: str) -> str:
    if part.isascii():          # printing ASCII stands for itself
        return part
    return part.encode().decode("latin-1").translate(_LETTERS)


class PieceEncoder:
    """``encode(texts)``: a uint32 array per text, the tokenizer's own ids.

    A new word of Latin letters goes straight to the vocabulary's merges, any
    other through the whole tokenizer."""

    def __init__(self, path: str, plain: bool = False, piece_bytes: int = PIECE_BYTES):
        self.tokenizer, self.special = _tokenizer(path, plain)
        self.piece_bytes = piece_bytes
        self.merges = self.tokenizer.model.tokenize
        self.pieces = _PIECE.findall
        self.forget()

    def forget(self) -> None:
        self.code = _Codes()
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _room(self, n_ids: int) -> None:
        while self.used + n_ids > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.code) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))

    def _store(self, ids: np.ndarray, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        self._room(len(ids))
        self.flat[self.used:self.used + len(ids)] = ids
        self.start[codes], self.size[codes] = self.used + starts, sizes
        self.used += len(ids)

    def _learn(self) -> None:
        new, first = self.code.new, len(self.code) - len(self.code.new)
        ids, sizes, odd = [], np.zeros(len(new), np.int64), []
        for k, piece in enumerate(new):
            m = _SIMPLE.fullmatch(piece)
            if m is None:
                odd.append(k)
                continue
            before = len(ids)
            for part in m.groups():
                if part:
                    ids += [t.id for t in self.merges(_as_letters(part.lower()))]
            sizes[k] = len(ids) - before
        codes = first + np.arange(len(new))
        simple = np.ones(len(new), bool)
        simple[odd] = False
        self._store(np.array(ids, np.uint32), codes[simple], np.cumsum(sizes[simple]) - sizes[simple], sizes[simple])
        if odd:
            many = [e.ids for e in self.tokenizer.encode_batch_fast([new[k] for k in odd], add_special_tokens=False)]
            n = np.array([len(x) for x in many])
            flat = np.fromiter((i for x in many for i in x), np.uint32, int(n.sum()))
            self._store(flat, codes[~simple], np.cumsum(n) - n, n)
        self.code.new = []

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def held(self) -> int:
        """Bytes of remembered pieces, about."""
        return len(self.code) * _PIECE_COST + self.used * 4

    def _in_pieces(self, text: str) -> bool:
        return not (any(s in text for s in self.special) or _WIDE_SPACE.search(text))

    def encode(self, many: list[str], at_once: int = 64) -> Iterator[np.ndarray]:
        for a in range(0, len(many), at_once):
            if self.held() > self.piece_bytes:
                self.forget()
            some, codes = many[a:a + at_once], []
            for text in some:
                found = self.pieces(text) if self._in_pieces(text) else []
                codes.append(np.fromiter(map(self.code.__getitem__, found), np.int64, len(found)))
            if self.code.new:
                self._learn()
            for text, c in zip(some, codes):
                yield self._ids(c) if len(c) else self.whole(text)

    def _ids(self, codes: np.ndarray) -> np.ndarray:
        n = self.size[codes]
        ends = np.cumsum(n)
        return self.flat[np.repeat(self.start[codes] - (ends - n), n) + np.arange(ends[-1])]


_KINDS = {"byte": ByteEncoder, "word": PieceEncoder}
_ENCODERS: dict[tuple, ByteEncoder | PieceEncoder] = {}


def encoder(path: str, kind: str, plain: bool = False) -> ByteEncoder | PieceEncoder:
    """The worker's encoder for the vocabulary file; kind: byte (byte-level,
    white space kept) or word (white space dropped)."""
    key = path, kind, plain
    if key not in _ENCODERS:
        _ENCODERS[key] = _KINDS[kind](path, plain)
    return _ENCODERS[key]


def texts(column: Iterable) -> list[str]:
    """Arrow string column to texts, null as empty."""
    return [x or "" for x in column.to_pylist()]
