"""Chat formatting, the quality classifier and license scans."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

EVENTS = "conv_id long, message long, seq long, kind string, role string, text string"
TURNS = "conv_id long, turn long, role string, text string"


def replay(events):
    """Fold a log in order of sequence, message by message in a dict."""
    convs = defaultdict(dict)
    order = lambda e: (e[2], e[1], e[3] or "", e[4] or "", e[5] or "")
    for conv, message, _, kind, role, text in sorted(events, key=order):
        c = convs[conv]
        if kind == "regenerate":
            for m in [m for m in c if m > message]:
                del c[m]
        m = c.setdefault(message, [None, ""])
        if m[0] is None or kind == "open":
            m[0] = role
        if kind == "regenerate":
            m[1] = ""
        elif kind == "edit":
            m[1] = text or ""
        else:
            m[1] += text or ""
    return {k: [(r or "", t) for _, (r, t) in sorted(v.items())] for k, v in convs.items()}


def formatted(spark, events, block=4096):
    from leadflow.llm.chat import format_events, parse
    got = defaultdict(list)
    for r in format_events(spark.createDataFrame(events, EVENTS).repartition(3), block).orderBy("conv_id", F.asc_nulls_last("message"), "nth").collect():
        got[r.conv_id] += parse(r.formatted)
    return dict(got)


@pytest.mark.parametrize("block", [4096, 2])
def test_log_is_folded(spark, block):
    rng = random.Random(4)
    events = []
    for conv in range(12):
        seq = 0
        for _ in range(60):
            kind = rng.choice(["open", "delta", "delta", "delta", "edit", "regenerate"])
            text = rng.choice(["a", "<turn:user>", "\\l", "</turn>\n", "", None, "é\U0001F600"]) if kind != "open" else None
            events.append((conv, rng.randrange(9), seq, kind, rng.choice(["user", "assistant", "r>\"o\\le", None]), text))
            seq += 1
    assert formatted(spark, events, block) == replay(events)


def test_log_edges(spark):
    assert formatted(spark, []) == {}
    whole = [(1, 4, 9, "whole", "user", "b"), (1, 4, 9, "whole", "user", "b"), (1, 4, 9, "whole", "user", "a"),
             (1, None, 10, "whole", "user", "z"), (1, 3, 1, "open", "assistant", None), (1, 3, 2, "delta", None, "x"),
             (1, 3, 11, "regenerate", None, None), (1, 3, 12, "delta", None, "new"), (1, 1 << 40, 13, "whole", None, None)]
    for block in (4096, 2):
        assert formatted(spark, whole, block) == {1: [("assistant", "new"), ("", "")]}
    events = [(None, 0, 0, "open", "user", None), (None, 0, 1, None, None, "x"), (5, 0, None, "delta", None, "y"),
              (5, 0, 1, "delta", "user", "z"), (5, 0, 1, "delta", "user", "z")]
    assert formatted(spark, events) == {None: [("user", "x")], 5: [("user", "yzz")]}


def test_escapes_are_reversible():
    from leadflow.llm.chat import escape, parse, render, unescape
    rng = random.Random(1)
    for _ in range(300):
        s = "".join(rng.choice("\\<>lg/turn:\n é") for _ in range(rng.randrange(30)))
        assert unescape(escape(s)) == s and not set("<>") & set(escape(s))
        text, a, z = render("assistant", s)
        assert parse(text) == [("assistant", s)] and unescape(text[a:z]) == s
        assert parse(render(s, s)[0] * 2) == [(s, s)] * 2


def test_turns(spark):
    from leadflow.llm.chat import format_turns
    rows = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok"),
            (1, 0, "system", None), (1, 2, "assistant", "x" * 5000 + "\U0001F600\n"), (1, 1, "user", ""),
            (1, 3, None, "no role"), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (None, 0, "user", "q"),
            (3, 5, "user", "late"), (3, None, "user", "last"), (3, -1, "user", "first"),
            # the whole range of longs, and the places next to a null turn
            *((4, t, "assistant", f"turn {t}") for t in (1, 3_000_000_000, 5_000_000_000, -(1 << 63), (1 << 63) - 1,
                                                       (1 << 62) + 1, 1 << 62, -5_000_000_000, (1 << 53) + 1, 1 << 53)),
            (5, None, "user", "z"), (5, (1 << 31) - 1, "user", "m"), (5, (1 << 31) - 2, "user", "a"), (5, 1 << 31, "user", "b"),
            (6, 0, "assistant", "long " * 400_000), (6, None, "assistant", "a"), (6, None, "user", "b")]
    extra = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(1) for c in ("message", "seq", "kind", "block", "e")})
    got = {r.conv_id: r for r in format_turns(extra.select("conv_id", "turn", "role", "text")).collect()}
    want = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0)):
        want[c].append((role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert format_turns(spark.createDataFrame([], TURNS)).count() == 0


# ---- 4 ----------------------------------------------------------------------

def test_pairs_are_ranked():
    from leadflow.llm.ranker import fit_pairs
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    good = x[:, 0] - 0.5 * x[:, 2] + 0.1 * rng.normal(size=600) > 0
    mean, w = fit_pairs(x, good, pairs=4000)
    raw = (x - mean) @ w
    assert w[0] > 0 > w[2] and abs(w[1]) < 0.2 * w[0]
    assert np.mean(raw[good][:, None] > raw[~good][None, :]) > 0.98
    assert (fit_pairs(x, np.ones(600, bool))[1] == 0).all()


def test_training_rows_are_bounded(spark):
    """Of many labels those below a hash limit are taken: at most max_rows,
    nearly as many, the same at every run; few labels are all taken."""
    from leadflow.llm import ranker as R
    feats = spark.range(5000).select(F.col("id").alias("doc_id"), *[(F.col("id") % (7 + k)).cast("double").alias(n)
                                                                    for k, n in enumerate(R.FEATURES)])
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 7 > 3).cast("int").alias("quality"))
    seen = []
    real, R.fit_pairs = R.fit_pairs, lambda x, good, **kw: (seen.append(x.shape[0]), real(x, good, **kw))[1]
    try:
        models = [R.train(feats, labels, max_rows=m) for m in (700, 700, 100_000)]
    finally:
        R.fit_pairs = real
    assert models[0] == models[1] and seen[0] == seen[1] and 600 < seen[0] <= 700
    assert seen[2] == 5000 - feats.filter(R.held_out(F.col("doc_id"))).count()


def test_classifier(spark):
    from leadflow.llm.ranker import classify
    docs = spark.createDataFrame(
        [(i, "the quick brown fox walks over %d hills and rests. " % i * 3 if i % 3 else "BUY!!! ### %d !!! *** " % i * 9)
         for i in range(300)] + [(1, "the same id"), (None, "no id"), (301, None), (302, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 300)] + [(5, None), (None, 1), (9999, 0)],
                                   "doc_id long, quality int")
    extra = docs.withColumns({c: F.lit(1) for c in ("l", "l_id", "held_out", "_t", "quality", "score")})
    got = classify(extra, labels).collect()
    assert len(got) == 304 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    import zlib
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    seen = [(r.predicted, int(r.doc_id % 3 > 0)) for r in got if r.held_out and r.doc_id < 300 and r.doc_id != 1]
    assert np.mean([a == b for a, b in seen]) > 0.95
    assert len({r.score for r in got if r.doc_id in (301, 302)}) == 1
    assert {r.score for r in classify(docs, labels.limit(0)).collect()} == {0.5}
    assert classify(docs.limit(0), labels).count() == 0


# ---- 9 ----------------------------------------------------------------------

def brute_scan(rows, templates, containment):
    from leadflow.llm.license_scan import SHINGLE, plain
    want = Counter()
    for doc, text in rows:
        ws = [plain(w) for w in (text or "").encode().split()]
        best = {}
        for name, t in templates:
            tw = [plain(w) for w in t.encode().split()]
            k = min(SHINGLE, len(tw))
            sh = lambda x: {tuple(x[i:i + k]) for i in range(len(x) - k + 1)}
            for i in range(len(ws) - len(tw) + 1):
                share = len(sh(tw) & sh(ws[i:i + len(tw)])) / len(sh(tw))
                if share >= containment:
                    best[name] = min(best.get(name, (0, 0)), (-share, i))
        want.update((doc, n, i, round(-s, 6)) for n, (s, i) in best.items())
    return want


def test_license_scan(spark):
    from leadflow.llm.license_scan import TEMPLATES, bands_for, license_scan
    rng = random.Random(2)
    rows = [(None, "Released under the MIT License."), (0, None), (1, ""), (2, "license"), (3, "MIT " * 3000)]
    for i in range(10, 90):
        ws = [rng.choice(["alpha", "the", "license", "Version", "under"]) for _ in range(rng.randrange(80))]
        notice = rng.choice(TEMPLATES)[1].split()
        if i % 3 == 0:
            notice[rng.randrange(len(notice))] = "changed"
        if i % 5 == 0:
            notice = [w.upper() + "," for w in notice]
        rows.append((i, " ".join(ws[:40] + notice + ws[40:])))
    rows += rows[-2:]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    extra = docs.withColumns({c: F.lit("x") for c in ("license", "first_word", "block", "containment")})
    got = Counter(tuple(r) for r in license_scan(extra).collect())
    want = brute_scan(rows, TEMPLATES, 0.8)
    assert not got - want and sum((want - got).values()) <= 1      # a miss has probability 1e-4 for each
    assert license_scan(docs.limit(0)).count() == license_scan(docs, templates=()).count() == 0
    s = 0.5
    assert (1 - s ** 2) ** bands_for(s) <= 1e-4 < (1 - s ** 2) ** (bands_for(s) - 1)


def test_long_and_many_templates(spark):
    """Texts of licenses, longer than any notice, in one and in several
    portions; related ones told apart by what a text holds most of."""
    from leadflow.llm.license_scan import license_scan
    rng = random.Random(5)
    words = lambda n: ["w%d" % rng.randrange(3000) for _ in range(n)]
    long = {"L1": words(6000), "L2": words(2500), "L3": words(40)}
    near = list(long["L2"])
    for i in range(0, 400, 3):
        near[i] = "other"
    templates = [*((n, " ".join(w)) for n, w in long.items()), ("L2-variant", " ".join(near)), ("L3", "short title of it")]
    worn = [w if rng.random() > .05 else "typo" for w in long["L1"]]
    rows = [(1, " ".join(words(50) + long["L1"] + words(50))), (2, " ".join(worn)), (3, " ".join(long["L2"])),
            (4, " ".join(words(9) + near)), (5, " ".join(long["L1"][:3000])), (6, "see the short title of it here"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_scan(rows, templates, 0.8)
    assert {(d, n) for d, n, *_ in want} == {(1, "L1"), (2, "L1"), (3, "L2"), (3, "L2-variant"), (4, "L2"),
                                             (4, "L2-variant"), (6, "L3")}
    for words_at_once in (200_000, 3000, 1):
        assert Counter(tuple(r) for r in license_scan(docs, templates, portion_words=words_at_once).collect()) == want
        best = license_scan(docs, templates, best_only=True, portion_words=words_at_once)
        assert {(r.doc_id, r.license) for r in best.collect()} == {(1, "L1"), (2, "L1"), (3, "L2"), (4, "L2-variant"), (6, "L3")}


BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
       "following conditions are met: {0} Redistributions of source code must retain the above copyright notice, this list "
       "of conditions and the following disclaimer. {1} Redistributions in binary form must reproduce the above copyright "
       "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
       "with the distribution. {2} THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
       "EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.")
NAMES = ("Neither the name of {0} nor the names of its contributors may be used to endorse or promote products derived "
         "from this software without specific prior written permission.")
GNU = ("{0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2} License as published "
       "by the Free Software Foundation{3} either version {4} of the License, or (at your option) any later version.")
USUAL = [
    ("GPL-3.0", GNU.format("This program", ":", "General Public", ",", "3")),
    ("GPL-3.0", GNU.format("Foo", ":", "General Public", ",", "3")),
    ("GPL-2.0", GNU.format("This program", ";", "General Public", ";", "2")),
    ("LGPL-2.1", GNU.format("This library", ";", "Lesser General Public", ";", "2.1")),
    ("LGPL-3.0", GNU.format("This program", ":", "Lesser General Public", ",", "3")),
    ("AGPL-3.0", GNU.format("This program", ":", "Affero General Public", ",", "3")),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License version 2 as published by the Free Software Foundation."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; version 2 of the License."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSD-2-Clause", BSD.format("1.", "2.", "")),
    ("BSD-2-Clause", BSD.format("*", "*", "")),
    ("BSD-3-Clause", BSD.format("1.", "2.", "3. " + NAMES.format("the copyright holder"))),
    ("BSD-3-Clause", BSD.format("*", "*", "* " + NAMES.format("Foo Inc."))),
    ("BSD-4-Clause", BSD.format("1.", "2.", "3. All advertising materials mentioning features or use of this software must "
                                "display the following acknowledgement: This product includes software developed by the "
                                "University. 4. " + NAMES.format("the University"))),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "SPDX-License-Identifier: MIT"),
]


def test_usual_notices_are_told_apart(spark):
    from leadflow.llm.license_scan import license_scan
    around = "some words of code " * 12
    rows = [(i, f"{around}{t} {around}") for i, (_, t) in enumerate(USUAL)]
    rows += [(100 + i, t) for i, (_, t) in enumerate(USUAL)]
    both = USUAL[2][1] + " " + USUAL[0][1]          # two related notices, one after the other
    rows.append((200, f"{around}{both} {around}"))
    got = license_scan(spark.createDataFrame(rows, "doc_id long, text string"), best_only=True).collect()
    want = Counter((k + i, n) for k in (0, 100) for i, (n, _) in enumerate(USUAL)) + Counter([(200, "GPL-2.0"), (200, "GPL-3.0")])
    assert Counter((r.doc_id, r.license) for r in got) == want


def test_registered_scan_finds_usual_notices(spark, tmpdir_path):
    from leadflow.llm.queries import QUERIES
    rows = [(i, t, "en", "s", len(t)) for i, (_, t) in enumerate(USUAL)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.mode(
        "overwrite").parquet(f"{tmpdir_path}/licenses/documents.parquet")
    got = QUERIES["op9_license_scan"](spark, f"{tmpdir_path}/licenses").collect()
    assert Counter((r.doc_id, r.license) for r in got) == Counter((i, n) for i, (n, _) in enumerate(USUAL))
