"""License scans: MinHash bands retrieve templates, shingle containment decides.

For every template length, a text is read through overlapping windows of that
many words.  A window and a template that agree in one band of MinHash values
become a candidate; the number of bands is chosen so that a window with the
least similarity that can matter is missed with probability ``MISS`` at most.
A candidate counts when the window holds at least ``containment`` of the
template's shingles, counted exactly.  Windows with fewer shingles of a
length's templates than that, repeats included, cannot count and are left
out before any MinHash value is taken.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.blocks import Block, fold, windows, word_blocks

_GNU = ("free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free "
        "Software Foundation, either version {1} of the License")
_GNU_ONLY = "GNU {0} version {1} as published"
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met")
_BSD_TWO = (_BSD + ": 1. Redistributions of source code must retain the above copyright notice, this list of conditions "
            "and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
            "this list of conditions and the following disclaimer in the documentation and/or other materials provided "
            "with the distribution.")
_BSD_NAMES = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission.")
_CC = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
_FEE = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted")
_SPDX = ("0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "BSL-1.0", "CC-BY-4.0",
         "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-1.0", "EPL-2.0", "GPL-2.0",
         "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-1.1", "MPL-2.0", "Unlicense", "WTFPL", "Zlib")

# One-line notices, usual notices, titles and distinguishing clauses.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("All-Rights-Reserved", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", _BSD),
    ("CC-BY-4.0", _CC.format("")),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("0BSD", _FEE + '. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES'),
    ("AGPL-3.0", _GNU.format("Affero General Public License", "3")),
    ("AGPL-3.0", _GNU_ONLY.format("Affero General Public License", "3")),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-2-Clause", _BSD_TWO),
    ("BSD-3-Clause", _BSD_TWO + " 3. " + _BSD_NAMES),
    ("BSD-3-Clause", _BSD_NAMES),
    ("BSD-4-Clause", _BSD_TWO + " 3. All advertising materials mentioning features or use of this software must display "
                     "the following acknowledgement: This product includes software developed by the organization. 4. "
                     + _BSD_NAMES),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
                "software and accompanying documentation covered by this license"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", _CC.format("-NonCommercial")),
    ("CC-BY-NC-SA-4.0", _CC.format("-NonCommercial-ShareAlike")),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", _CC.format("-NoDerivatives")),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", _CC.format("-ShareAlike")),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License v1.0 which accompanies this distribution"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0 which is available at"),
    ("GPL-2.0", _GNU.format("General Public License", "2")),
    ("GPL-2.0", _GNU_ONLY.format("General Public License", "2")),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", _GNU.format("General Public License", "3")),
    ("GPL-3.0", _GNU_ONLY.format("General Public License", "3")),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", _FEE + ", provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", _GNU.format("Lesser General Public License", "2.1")),
    ("LGPL-2.1", _GNU_ONLY.format("Lesser General Public License", "2.1")),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", _GNU.format("Lesser General Public License", "3")),
    ("LGPL-3.0", _GNU_ONLY.format("Lesser General Public License", "3")),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-1.1", 'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may '
                "not use this file except in compliance with the License."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
             "be held liable for any damages arising from the use of this software."),
    *((name, f"SPDX-License-Identifier: {name}{end}") for name in _SPDX
      for end in (("", "-only", "-or-later", "+") if "GPL" in name else ("",))),
)
SHINGLE = 2
CONTAINMENT = 0.8
ROWS = 2                # MinHash values per band
MISS = 1e-4
PORTION_WORDS = 200_000  # words of the templates that one pass over the documents looks for, about

_EDGE = re.compile(rb"^[^0-9a-z]+|[^0-9a-z]+$")


def plain(word: bytes) -> bytes:
    """Lower-cased word without marks at its ends (as it is, if only marks)."""
    low = word.lower()
    return _EDGE.sub(b"", low) or low


def _hashes(ws: Sequence[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in ws], np.uint64)


def bands_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands that a pair of the given Jaccard similarity misses, all of them,
    with probability ``miss`` at most: (1 - s**rows)**bands <= miss."""
    return 1 if similarity >= 1 else ceil(log(miss) / log(1 - similarity ** rows))


def least_similarity(length: int, containment: float = CONTAINMENT, shingle: int = SHINGLE,
                     distinct: int | None = None) -> float:
    """Least Jaccard similarity of a window of ``length`` words that holds
    ``containment`` of the shingles of a template as long, ``distinct`` of
    them (all, if not given)."""
    n = max(1, length - shingle + 1)
    m = n if distinct is None else distinct
    inside = ceil(containment * m)
    return inside / (n + m - inside)


@dataclass(frozen=True)
class TemplateClass:
    """Templates of one length: window, bands, and what is looked up."""

    length: int
    shingle: int
    bands: int
    names: list[str]
    sets: list[np.ndarray]          # sorted distinct shingle hashes
    needed: int                     # shingles that the least demanding of them needs
    known: np.ndarray               # sorted distinct shingle hashes of all of them
    keys: list[dict[int, list[int]]]  # per band: key -> templates


def _seeds(n: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(b"minhash%d" % i) for i in range(n)], np.uint64)


def _scramble(x: np.ndarray, seed: np.uint64) -> np.ndarray:
    return fold(x, np.full(1, seed, np.uint64))


def _band_keys(shingles: np.ndarray, width: int, bands: int, rows: int) -> Iterator[np.ndarray]:
    """Per band, the key of every run of ``width`` shingles; one band's
    arrays at a time."""
    seeds = _seeds(bands * rows)
    for b in range(bands):
        key = None
        for s in seeds[b * rows:(b + 1) * rows]:
            low, size = _scramble(shingles, s), 1
            while size < width:                       # least of a sliding run, by doubling
                step = min(size, width - size)
                low, size = np.minimum(low[:len(low) - step], low[step:]), size + step
            key = low if key is None else fold(key, low)
        yield key


def compile_templates(templates: Sequence[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT,
                      rows: int = ROWS) -> list[TemplateClass]:
    by_length: dict[int, list[tuple[str, list[bytes]]]] = {}
    for name, text in templates:
        ws = [plain(w) for w in text.encode().split()]
        if ws:
            by_length.setdefault(len(ws), []).append((name, ws))
    out = []
    for length, group in sorted(by_length.items()):
        k = min(SHINGLE, length)
        runs = [windows(_hashes(ws), k) for _, ws in group]
        sets = [np.unique(sh) for sh in runs]
        few = min(map(len, sets))
        bands = bands_for(least_similarity(length, containment, k, few), rows)
        keys = [{} for _ in range(bands)]
        for i, sh in enumerate(runs):
            for band, key in zip(keys, _band_keys(sh, len(sh), bands, rows)):
                band.setdefault(int(key[0]), []).append(i)
        out.append(TemplateClass(length, k, bands, [n for n, _ in group], sets, max(1, ceil(containment * few - 1e-9)),
                                 np.unique(np.concatenate(sets)), keys))
    return out


def rivals(classes: list[TemplateClass]) -> dict[tuple[int, int], set[tuple[int, int]]]:
    """Per template (class, number): the templates of other licenses that hold
    half of its shingles, or of which it holds half."""
    all_ = [((i, t), c.shingle, c.names[t], c.sets[t]) for i, c in enumerate(classes) for t in range(len(c.sets))]
    out: dict[tuple[int, int], set[tuple[int, int]]] = {at: set() for at, *_ in all_}
    for n, (at, k, name, x) in enumerate(all_):
        for other, k2, name2, y in all_[:n]:
            if k == k2 and name != name2 and 2 * len(np.intersect1d(x, y)) >= min(len(x), len(y)):
                out[at].add(other)
                out[other].add(at)
    return out


def portions(templates: Sequence[tuple[str, str]], containment: float, rows: int, related: bool,
             words: int = PORTION_WORDS) -> Iterator[tuple[list[TemplateClass], dict | None]]:
    """The templates in portions of about ``words`` words, compiled.  Those of
    one license stay together and, with ``related``, those of rivals too,
    which then come with the portion."""
    group = {name: name for name, _ in templates}
    if related:
        classes = compile_templates(templates, containment, rows)
        for (i, t), others in rivals(classes).items():
            for j, u in others:
                a, b = group[classes[i].names[t]], group[classes[j].names[u]]
                if a != b:
                    group = {n: a if g == b else g for n, g in group.items()}
    sets: dict[str, list[tuple[str, str]]] = {}
    for t in templates:
        sets.setdefault(group[t[0]], []).append(t)
    held: list[tuple[str, str]] = []
    size = 0
    for g in [*sets.values(), None]:
        more = sum(len(t.split()) for _, t in g or [])
        if held and (g is None or size + more > words):
            classes = compile_templates(held, containment, rows)
            yield classes, rivals(classes) if related else None
            held, size = [], 0
        held, size = held + (g or []), size + more


_ROW = "doc_id long, license string, first_word long, containment double"
_FOUND = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("first_word", pa.int64()),
                    ("containment", pa.float64())])


def _contained(template: np.ndarray, run: np.ndarray) -> int:
    return int(np.isin(template, run).sum())


def _candidates(c: TemplateClass, sh: np.ndarray, room: np.ndarray, rows: int) -> set[tuple[int, int]]:
    """Window starts and templates of one length that agree in a band."""
    width = c.length - c.shingle + 1
    if len(sh) < width:
        return set()
    near = c.known[np.minimum(np.searchsorted(c.known, sh), len(c.known) - 1)] == sh
    held = np.concatenate([[0], np.cumsum(near)])
    starts = np.flatnonzero((held[width:] - held[:-width] >= c.needed)
                            & (room[:len(sh) - width + 1] >= c.length))      # the window ends inside its document
    if not len(starts):
        return set()
    edge = np.zeros(len(sh) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    inside = np.cumsum(edge[:-1]) > 0                # shingles of those windows, pushed together
    place = (np.cumsum(inside) - 1)[starts]
    out = set()
    for key, wanted in zip(_band_keys(sh[inside], width, c.bands, rows), c.keys):
        found = key[place]
        for i in np.flatnonzero(np.isin(found, np.array(list(wanted), np.uint64))).tolist():
            out.update((int(starts[i]), t) for t in wanted[int(found[i])])
    return out


def _unrivalled(hits: list[tuple], classes: list[TemplateClass], rival: dict) -> list[tuple]:
    """Hits (start, class, template, shingles held) without those of which a
    rival holds more at the same place: windows that overlap by more than
    half of the shorter one; of as many shingles the greater share wins."""
    hits = sorted(hits)
    starts = [h[0] for h in hits]
    most = max((c.length for c in classes), default=0)
    share = lambda h: h[3] / len(classes[h[1]].sets[h[2]])
    out = []
    for h in hits:
        mine, size = rival[h[1], h[2]], classes[h[1]].length
        beaten = False
        if mine:
            for o in hits[bisect_left(starts, h[0] - most):bisect_left(starts, h[0] + size)]:
                if (o[1], o[2]) in mine and (o[3], share(o)) > (h[3], share(h)):
                    other = classes[o[1]].length
                    overlap = min(h[0] + size, o[0] + other) - max(h[0], o[0])
                    if 2 * overlap > min(size, other):
                        beaten = True
                        break
        if not beaten:
            out.append(h)
    return out


def _scan(sent: Broadcast, containment: float, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, rival = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                b = Block.of(row)
                h = _hashes([plain(w) for w in b.vocabulary])[b.codes]
                room, doc = b.room(), b.doc_of_word()
                start = np.cumsum(b.sizes) - b.sizes
                shingles = {k: windows(h, k) for k in {c.shingle for c in classes}}
                hits = []
                for i, c in enumerate(classes):
                    sh = shingles[c.shingle]
                    width = c.length - c.shingle + 1
                    for at, t in _candidates(c, sh, room, rows):
                        held = _contained(c.sets[t], sh[at:at + width])
                        if held / len(c.sets[t]) >= containment:
                            hits.append((at, i, t, held))
                if rival is not None:
                    hits = _unrivalled(hits, classes, rival)
                best: dict[tuple[int, str], tuple[float, int]] = {}
                for at, i, t, held in hits:
                    d, c = int(doc[at]), classes[i]
                    found = (-(held / len(c.sets[t])), at - int(start[d]))
                    if found < best.get((d, c.names[t]), (1.0, 0)):
                        best[d, c.names[t]] = found
                if best:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([b.doc_ids[d] for d, _ in best], pa.int64()), pa.array([n for _, n in best], pa.string()),
                        pa.array([w for _, w in best.values()], pa.int64()),
                        pa.array([-s for s, _ in best.values()], pa.float64())], schema=_FOUND)
    return run


def license_scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT,
                 rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text", best_only: bool = False,
                 portion_words: int = PORTION_WORDS) -> DataFrame:
    """doc_id, license, first_word, containment: one row per document and
    license whose template one of its windows holds.

    first_word and containment are those of the window with the greatest
    containment, the first of equal ones.  Words are compared lower-cased and
    without marks at their ends.  Texts shorter than a template cannot hold
    it; null and empty texts give no row; rows that share an id, or have
    none, are scanned each and give rows of their own; no documents or no
    templates give no rows.  A very long text is a block of its own, scanned
    whole by one task.  Only the id and text columns are read.

    Notices of related licenses differ in a word or two, so a text holds
    enough of several.  With ``best_only`` a place counts only for the one of
    related templates (``rivals``) that it holds most of.

    Templates may be of any length and number: each pass over the blocks of
    words looks for about ``portion_words`` words of them."""
    spark = docs.sparkSession
    blocks = word_blocks(docs, id_col, text_col)
    out = spark.createDataFrame([], _ROW)
    # a portion's size is bounded, a longer single text being its own: it goes to each worker once
    for classes, rival in portions(templates, containment, rows, best_only, portion_words):
        sent = spark.sparkContext.broadcast((classes, rival))
        out = out.union(blocks.mapInArrow(_scan(sent, containment, rows), _ROW))
    return out.select("doc_id", "license", "first_word", F.round("containment", 6).alias("containment"))
