"""Periodic runs against a scan of every period of every text."""

import hashlib
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def brute_runs(w, min_words):
    """(start, length, smallest period) by extending every period."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(min_words, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def kept_words(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


@pytest.mark.parametrize("min_words", [1, 2, 3, 5, 12, 13])
def test_find_runs(min_words):
    from leadflow.llm.periodic import find_runs
    rng = np.random.default_rng(min_words)
    for _ in range(60):
        docs = []
        for _ in range(rng.integers(1, 6)):
            w = rng.integers(0, rng.integers(1, 5), rng.integers(0, 100))
            if len(w) and rng.random() < .5:
                a, p = rng.integers(0, len(w)), rng.integers(1, 10)
                w[a:] = np.resize(w[a:a + p], len(w) - a)
            docs.append(w.astype(np.int64))
        doc, *found = find_runs(np.concatenate(docs), np.array([len(w) for w in docs]), min_words)
        for k, w in enumerate(docs):
            got = [tuple(int(x[i]) for x in found) for i in np.flatnonzero(doc == k)]
            assert got == sorted(brute_runs(w.tolist(), min_words), key=lambda r: (r[0], r[2]))


def test_hot_words():
    """A word repeated often, and stretches of it between others, stay cheap."""
    from leadflow.llm.periodic import find_runs
    w = np.concatenate([np.concatenate([np.zeros(200, np.int64), [k]]) for k in range(1, 100)])
    both = np.concatenate([np.zeros(30_000, np.int64), w])
    doc, start, length, period = find_runs(both, np.array([30_000, len(w)]), 12)
    assert Counter(doc.tolist()) == {0: 1, 1: 99} and set(period.tolist()) == {1}
    assert length[0] == 30_000 and set(length[1:].tolist()) == {200}


ROWS = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a b " * 6), (6, "a b " * 5 + "a"), (7, "a b " * 5 + "a c"),
        (8, "x " * 3000 + "y z " * 2000), (8, "x " * 3000 + "y z " * 2000), (8, "p q r s t u\n" * 2),
        (None, "a\tb\x0bc " * 9), (9, "A a " * 9), (10, "é é 　 " * 12), (11, "same line\n" * 40 + "end " + "same line\n" * 40),
        (12, " ".join("w%d" % (i * i % 50) for i in range(700))), (13, " ".join("w%d" % i for i in range(3000)))]


def as_rows(df):
    return Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.kept_text) for r in df.collect())


def test_documents(spark):
    from leadflow.llm.periodic import periodic_runs
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    want = Counter()
    for i, t in ROWS:
        w = WORD.findall(t or "")
        found = sorted(brute_runs(w, 12), key=lambda r: (r[0], r[2]))
        want[i, len(w), tuple(found), " ".join(kept_words(w, found))] += 1
    assert as_rows(periodic_runs(docs)) == want
    assert as_rows(periodic_runs(docs, batch_words=500)) == want        # texts longer than a batch
    clash = docs.withColumns({c: F.lit(1) for c in ("runs", "n_words", "kept_text", "start", "best")})
    assert as_rows(periodic_runs(clash)) == want
    assert as_rows(periodic_runs(docs.toDF("the id", "the text"), "the id", "the text")) == want
    assert periodic_runs(docs.limit(0)).count() == 0


def test_planted_tails(spark):
    from leadflow.llm.periodic import repeat_tails
    rows = [(i, t) for i in range(-20, 120) for t in (None, "", " ", "one", "a b  c", " ".join(map(str, range(37))))]
    rows += [(None, "a b c")]
    got = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", "text", repeat_tails(F.col("text"), F.col("doc_id")).alias("new")).collect()
    assert any(r.text != r.new for r in got)
    for r in got:
        assert WORD.findall(r.new or "") == planted(r.doc_id, WORD.findall(r.text or ""))


@pytest.mark.skipif(not os.path.exists(SMALL), reason="driver tables missing")
def test_query(spark):
    from leadflow.llm.queries import QUERIES
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter()
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        w = planted(r.doc_id, WORD.findall(r.text or ""))
        if len(w) > 4000:               # the scan of every period is quadratic
            continue
        found = sorted(brute_runs(w, 12), key=lambda x: (x[0], x[2]))
        s, n, q = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None,) * 3
        want[r.doc_id, len(found), s, n, q, found and 1000 * n // q or None,
             sha("".join("%d,%d,%d\n" % x for x in found)), sha(" ".join(kept_words(w, found)))] += 1
    out = QUERIES["op11_periodic_runs"](spark, SMALL)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert {t for _, t in out.dtypes} == {"bigint", "string"}
    got = Counter(tuple(r) for r in out.collect())
    ids = {k[0] for k in want}
    assert Counter({k: v for k, v in got.items() if k[0] in ids}) == want
    assert sum(k[1] > 0 for k in want) > 5
