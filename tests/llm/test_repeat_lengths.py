"""Doubling until no candidate survives, against counting every window."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_small_cases import ROWS, SCHEMA, passage, words


def brute_lengths(rows, base):
    """Per row its spans: every window of every doubled length is counted."""
    texts = [words(t) for _, t in rows]
    reached = [[0] * len(w) for w in texts]
    n = base
    while any(len(w) >= n for w in texts):
        seen = Counter(tuple(w[i:i + n]) for w in texts for i in range(len(w) - n + 1))
        for w, r in zip(texts, reached):
            for i in range(len(w) - n + 1):
                if seen[tuple(w[i:i + n])] > 1:
                    r[i] = n
        n *= 2
    out = Counter()
    for (doc, _), w, r in zip(rows, texts, reached):
        spans = []
        for i, n in enumerate(r):
            if n and i and r[i - 1] == n:
                spans[-1][1] = i + n
            elif n:
                spans.append([i, i + n, n])
        spans = [s for s in spans if not any(o is not s and o[0] <= s[0] and s[1] <= o[1] for o in spans)]
        out[doc, len(w), max((b - a for a, b, _ in spans), default=0), tuple(map(tuple, spans))] += 1
    return out


def told(df):
    return Counter((r.doc_id, r.n_words, r.longest, tuple((p.start, p.end, p.window) for p in r.repeats))
                   for r in df.collect())


@pytest.mark.parametrize("base", [1, 3, 10])
def test_lengths(spark, base):
    from leadflow.llm.substring import repeat_lengths
    rows = [r for r in ROWS if r[0] != 13] + [(13, "x " * 700 + passage(4, 90), "de", "c", 1),
                                              (20, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns(
        {c: F.lit(1) for c in ("block", "n_words", "longest", "said0", "sizes")})
    assert told(repeat_lengths(docs, base=base)) == brute_lengths([r[:2] for r in rows], base)


def test_empty_table_and_no_repeats(spark):
    from leadflow.llm.substring import repeat_lengths
    assert repeat_lengths(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = spark.createDataFrame([(1, passage(1, 50)), (2, "a b")], "doc_id long, text string")
    assert told(repeat_lengths(alone)) == Counter({(1, 50, 0, ()): 1, (2, 2, 0, ()): 1})


def test_lengths_over_many_blocks(spark, monkeypatch):
    """Passages of several lengths across many small blocks and key ranges;
    one span tells each planted passage's length."""
    from leadflow.llm import substring
    rng = np.random.default_rng(5)
    text = lambda n: " ".join("v%d" % x for x in rng.integers(0, 10**9, n))
    planted = [text(n) for n in (10, 19, 47, 160, 333)]
    rows = [(int(i), " ".join([text(30), planted[i % 5], text(30)])) for i in rng.permutation(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    whole = substring.word_blocks
    monkeypatch.setattr(substring, "word_blocks", lambda *a: whole(*a, block_words=300))
    monkeypatch.setattr(substring, "ranges_for", lambda n: 5)
    got = substring.repeat_lengths(docs)
    assert told(got) == brute_lengths(rows, 10)
    assert all(r.longest == (10, 19, 47, 160, 333)[r.doc_id % 5] for r in got.collect())
