"""Piecewise fingerprints against a byte-by-byte version, and the chain of
documents against a sorted list."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
M32, M64 = (1 << 32) - 1, (1 << 64) - 1


def plain_hashes(data):
    out = []
    for i in range(len(data)):
        h = sum((data[i - k] + 1) * pow(0x9E3779B1, k, 1 << 32) for k in range(7) if i >= k) & M32
        h ^= h >> 15
        h = h * 0x85EBCA6B & M32
        out.append(h ^ h >> 13)
    return out


def plain_fold(a, b):
    x = (a * 0x9E3779B97F4A7C15 + (b ^ b >> 32) * 0xC2B2AE3D27D4EB4F) & M64
    x = (x ^ x >> 29) * 0x165667B19E3779F9 & M64
    return x ^ x >> 32


def plain_fingerprint(text):
    data = (text or "").encode()
    if not data:
        return "1::"
    h = plain_hashes(data)
    cut = lambda x, k: x % (1 << k) == (1 << k) - 1
    k = 0
    while sum(cut(x, k) for x in h) >= 64 and k < 32:
        k += 1
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    signed = []
    for size in (k, k + 1):
        chunks, now = [], []
        for i, x in enumerate(h):
            now.append(x)
            if cut(x, size) or i == len(h) - 1:
                chunks.append(sum(v * 0xC2B2AE3D27D4EB4F for v in now) & M64)
                now = []
        signed.append("".join(digits[s >> 6] + digits[s & 63] for s in (plain_fold(c, c) >> 52 for c in chunks)))
    return f"{1 << k}:{signed[0]}:{signed[1]}"


def plain_distance(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


def text_of(seed, n):
    return " ".join("w%x" % x for x in np.random.default_rng(seed).integers(0, 3000, n))


TEXTS = [None, "", " ", "a", "ab", "abcdefg", "abcdefgh", "x" * 1000, "é" * 40, "emoji \U0001F600 " * 9, "one two three",
         text_of(1, 30), text_of(2, 400), text_of(2, 400) + " end", text_of(3, 3000), "Onon " * 300, "\n" * 65]


def test_fingerprint_and_distance():
    from leadflow.llm.piecewise import edit_distance, fingerprint
    for t in TEXTS:
        assert fingerprint(t) == plain_fingerprint(t)
    rng = np.random.default_rng(4)
    for _ in range(600):
        a, b = (rng.integers(0, rng.integers(1, 6), rng.integers(0, 70)).tolist() for _ in range(2))
        b = a[:len(b)] + b[:7] if rng.random() < .4 else b
        assert edit_distance(a, b) == plain_distance(a, b)


def test_likeness():
    from leadflow.llm.piecewise import fingerprint, likeness
    a, b = text_of(5, 800), text_of(6, 800)
    f = fingerprint
    assert likeness(f(a), f(a)) == likeness(f(""), f(None)) == 1.0
    assert likeness(f(a), f("")) == likeness(f(""), f(a)) == 0.0
    assert likeness(f(a), f(b)) == likeness(f(b), f(a)) < 0.1
    moved = a[:1500] + " put in here " + a[1500:]
    assert likeness(f(a), f(moved)) > 0.9 and likeness(f(a), f(a + b[:len(a) // 4])) > 0.6
    assert 0.4 < likeness(f(a), f(a + b)) < 0.6       # block sizes one step apart
    assert likeness(f(a), f(text_of(5, 800) + text_of(7, 9000))) < 0.1


def chain(rows):
    """The contract's rows, from a list in order of id."""
    from leadflow.llm.piecewise import likeness
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    texts = [r[1] or "" for r in rows]
    out = Counter()
    for k, (i, t) in enumerate(zip((r[0] for r in rows), texts)):
        after = texts[(k + 1) % len(texts)]
        q = len(t) // 4
        new = t[:len(t) - q] + after[:q]
        a, b, c = map(plain_fingerprint, (t, new, after))
        out[i, len(t), hashlib.sha256(new.encode()).hexdigest(), a, b, likeness(a, b), likeness(a, c)] += 1
    return out


def got(df):
    return Counter((r.doc_id, r.n_chars, r.edited_sha.hex(), *r[3:]) for r in df.collect())


def test_chain(spark):
    from leadflow.llm.piecewise import compare_with_next, fingerprints
    rows = [(i * 3 - 9, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(compare_with_next(docs)) == chain(rows)
    clash = docs.withColumns({c: F.lit(1) for c in ("id", "h", "part", "role", "fingerprint", "n_chars", "next")})
    assert got(compare_with_next(clash)) == chain(rows)
    assert got(compare_with_next(docs.toDF("the id", "t"), "the id", "t")) == chain(rows)
    assert compare_with_next(docs.limit(0)).count() == 0
    for one in ([(4, "alone by itself")], [(None, "alone by itself")]):
        assert got(compare_with_next(spark.createDataFrame(one, "doc_id long, text string"))) == chain(one)
    same = [(5, "twin text here")] * 3 + [(None, "no id")] * 2 + [(1, "first")]
    assert got(compare_with_next(spark.createDataFrame(same, "doc_id long, text string"))) == chain(same)
    assert Counter(tuple(r) for r in fingerprints(docs).collect()) == \
        Counter((i, len(t or ""), plain_fingerprint(t)) for i, t in rows)


@pytest.mark.skipif(not os.path.exists(SMALL), reason="driver tables missing")
def test_query(spark):
    from leadflow.llm.queries import QUERIES
    out = QUERIES["op12_document_fingerprints"](spark, SMALL)
    assert out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                           "near_next"]
    rows = out.collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert Counter(tuple(r) for r in rows) == chain(docs)
    texts = dict(docs)
    near = sorted(r.near_edited for r in rows)
    assert near[len(near) // 20] > 0.5 > sorted(r.near_next for r in rows)[-len(near) // 20]
    by_print = {}
    for i, mark in ((r.doc_id, r.fingerprint) for r in rows):
        assert by_print.setdefault(texts[i], mark) == mark
