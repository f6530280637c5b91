"""Scores of the quality classifier against a plain-Python version."""

import math
import re
import unicodedata
import zlib

import numpy as np
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NOUNS = "river stone market letter garden window bread winter doctor music".split()


def texts():
    rng = np.random.default_rng(9)
    out = {}
    for i in range(90):
        if i % 2:
            lines = [" ".join(rng.choice(NOUNS, 9)).capitalize() + "." for _ in range(int(rng.integers(2, 9)))]
            out[i] = "\n".join(lines)
        else:
            out[i] = ("BUY now!!! $$$ 100%% " * int(rng.integers(1, 12))) + "\nclick #1 " * int(rng.integers(0, 6))
    out.update({90: "", 91: None, 92: " \t\r\n", 93: "é" * 400, 94: "Zoë Ünï 😀 ٣٤ \n\n\n", 95: "word " * 60_000,
                96: out[3], 97: "\n" * 50})
    return out


def brute_features(t):
    t = t or ""
    w, lines = WORD.findall(t), t.split("\n")
    n, chars = max(len(w), 1), max(len(t), 1)
    per = lambda k: math.log1p(100.0 * k / chars)
    kind = lambda c: sum(unicodedata.category(x) == c for x in t)
    return [math.log1p(len(w)), math.log1p(len(t) / n), len(set(w)) / n,
            math.log1p(len(set(w))) / math.log1p(n), len(set(lines)) / len(lines), math.log1p(len(t) / len(lines)),
            per(kind("Lu")), per(kind("Nd")), per(sum(t.count(c) for c in "#*$%&|<>")), per(t.count("!")),
            per(sum(t.count(c) for c in ".,;:"))]


def brute_weights(x, good, pairs, seed, ridge):
    """The same drawn pairs; the loss is brought down by plain gradient steps."""
    g, b = np.flatnonzero(good), np.flatnonzero(~good)
    rng = np.random.default_rng(seed)
    scale = np.array([s or 1.0 for s in x.std(axis=0)])
    z = (x - x.mean(axis=0)) / scale
    d = z[rng.choice(g, pairs)] - z[rng.choice(b, pairs)]
    w, step = np.zeros(x.shape[1]), 1.0 / (np.square(d).sum(axis=1).mean() / 4 + ridge)
    v, t = w, 1.0
    for _ in range(4000):                              # accelerated descent
        p = 1.0 / (1.0 + np.exp(d @ v))
        nxt = v + step * ((d * p[:, None]).mean(axis=0) - ridge * v)
        u = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, w, t = nxt + (t - 1) / u * (nxt - w), nxt, u
    return w / scale


def test_weights_minimise_the_pairwise_loss():
    from leadflow.llm.ranker import fit_pairs
    rng = np.random.default_rng(1)
    good = rng.random(200) < 0.4
    x = np.column_stack([rng.normal(size=200) + good, rng.normal(size=200) * 30, np.full(200, 2.5)])
    mean, w = fit_pairs(x, good, pairs=3000, seed=4, ridge=1e-2)
    assert np.allclose(mean, x.mean(axis=0)) and w[2] == 0
    assert np.allclose(w, brute_weights(x, good, 3000, 4, 1e-2), atol=1e-5)


def test_scores_by_brute_force(spark):
    """Features, weights, threshold and score of every row worked out again."""
    from leadflow.llm.ranker import FEATURES, classify, features
    from leadflow.llm import ranker
    t = texts()
    docs = spark.createDataFrame([(i, s) for i, s in t.items()], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id long, quality int")
    want = {i: brute_features(s) for i, s in t.items()}
    for r in features(docs).collect():
        assert np.allclose([r[n] for n in FEATURES], want[r.doc_id], atol=1e-9), r.doc_id

    place = {r.doc_id: r.p for r in labels.select("doc_id", F.xxhash64("doc_id").alias("p")).collect()}
    train = sorted((i for i in range(90) if zlib.crc32(str(i).encode()) % 3 != 1), key=place.get)
    x, good = np.array([want[i] for i in train]), np.array([i % 2 == 1 for i in train])
    w = ranker.fit_pairs(x, good)[1]
    raw = (x - x.mean(axis=0)) @ w
    cut, spread = np.quantile(raw, 1 - good.mean()), raw.std()
    got = {r.doc_id: r for r in classify(docs, labels).collect()}
    assert set(got) == set(t)
    for i, r in got.items():
        z = ((np.array(want[i]) - x.mean(axis=0)) @ w - cut) / spread
        assert math.isclose(r.score, 1 / (1 + math.exp(min(-z, 700))), abs_tol=1e-6), i
        assert r.held_out is (zlib.crc32(str(i).encode()) % 3 == 1)
        assert r.predicted == int(r.score >= 0.5)
    assert got[90].score == got[91].score and got[96].score == got[3].score
