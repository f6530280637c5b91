"""Quality classifier: Bradley-Terry ranking on preference pairs.

Every labelled good document is preferred to every labelled bad one.  Scores
are linear in a document's features; the weights minimise the logistic loss
on feature differences of drawn pairs.  The score at the quantile that parts
the training labels becomes the threshold.

Features and scores are Spark expressions over whole texts; only a bounded
matrix of labelled training rows reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import words
from leadflow.operators.stage import stage

MAX_TRAIN_ROWS = 20_000     # labelled rows that may reach the driver
PAIRS = 100_000             # preference pairs drawn from them


def _per_char(pattern: str) -> Callable[[Column, Column], Column]:
    return lambda t, w: F.log1p(100.0 * F.regexp_count(t, F.lit(pattern)) / F.greatest(F.char_length(t), F.lit(1)))


FEATURES: dict[str, Callable[[Column, Column], Column]] = {
    "log_words": lambda t, w: F.log1p(F.size(w)),
    "word_length": lambda t, w: F.log1p(F.char_length(t) / F.greatest(F.size(w), F.lit(1))),
    "distinct_words": lambda t, w: F.size(F.array_distinct(w)) / F.greatest(F.size(w), F.lit(1)),
    # distinct words fall with length in any text; this is what is left over
    "distinct_for_length": lambda t, w: F.log1p(F.size(F.array_distinct(w))) / F.log1p(F.greatest(F.size(w), F.lit(1))),
    "distinct_lines": lambda t, w: F.size(F.array_distinct(F.split(t, "\n"))) / F.size(F.split(t, "\n")),
    "line_length": lambda t, w: F.log1p(F.char_length(t) / F.size(F.split(t, "\n"))),
    "capitals": _per_char(r"\p{Lu}"),
    "digits": _per_char(r"\p{Nd}"),
    "symbols": _per_char(r"[#*$%&|<>]"),
    "exclamations": _per_char("!"),
    "stops": _per_char(r"[.,;:]"),
}


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and one double per feature, written once (the texts are read
    once, whole); a null text has the features of an empty one."""
    t, w = F.col("_t"), F.col("_w")
    d = (docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
         .withColumn("_w", words(t)))
    return stage(d.select("doc_id", *[F.coalesce(f(t, w).cast("double"), F.lit(0.0)).alias(n)
                                      for n, f in FEATURES.items()]), "bt_features")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass(frozen=True)
class Ranker:
    mean: list[float]
    weight: list[float]       # of the feature, scale included
    threshold: float
    spread: float

    def raw(self) -> Column:
        return sum(((F.col(n) - F.lit(m)) * F.lit(w) for n, m, w in zip(FEATURES, self.mean, self.weight)), F.lit(0.0))

    def score(self) -> Column:
        """0 to 1, 0.5 at the threshold."""
        return 1.0 / (1.0 + F.exp(-(self.raw() - F.lit(self.threshold)) / F.lit(self.spread)))


def fit_pairs(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = 11, ridge: float = 1e-3,
              rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Feature means and Bradley-Terry weights from rows ``x`` and labels.

    ``pairs`` (good, bad) pairs are drawn at random; Newton steps minimise
    mean log(1 + exp(-w.(x_good - x_bad))) + ridge |w|^2 / 2 on standardised
    features.  Without both labels there is no pair and the weights are 0."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    g, b = np.flatnonzero(good), np.flatnonzero(~good)
    w = np.zeros(x.shape[1])
    if len(g) and len(b):
        z = (x - mean) / scale
        rng = np.random.default_rng(seed)
        d = z[rng.choice(g, pairs)] - z[rng.choice(b, pairs)]
        for _ in range(rounds):
            p = 1.0 / (1.0 + np.exp(np.clip(d @ w, -35, 35)))          # chance that the pair is taken wrongly
            grad = -(d * p[:, None]).mean(axis=0) + ridge * w
            hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w))
            step = np.linalg.solve(hess, grad)
            w = w - step
            if np.abs(step).max() < 1e-6:
                break
    return mean, w / scale


def train(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          max_rows: int = MAX_TRAIN_ROWS) -> Ranker:
    """Learn from labels 0/1 of rows that are not held out.  Of more than
    ``max_rows`` such labels, those with the least hash of their id are taken:
    the labels are counted, and a hash limit that about ``max_rows`` of them
    stay below is put before the join, so no task sorts or gathers all."""
    place = F.xxhash64("l_id")
    lab = (labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("l"))
           .filter(F.col("l").isin(0, 1) & ~held_out(F.col("l_id"))))
    n = lab.count()
    if n > max_rows:
        lab = lab.filter(place < int(-2.0**63 + 2.0**64 * max_rows / n))
    found = (feats.join(lab, F.col("doc_id") == F.col("l_id")).select(place.alias("place"), "doc_id", "l", *FEATURES)
             .collect())
    # the limit lets a few more than max_rows through now and then, or ids shared by several rows
    rows = [r[1:] for r in sorted(found, key=lambda r: (r.place, r.doc_id, r.l, r[3:]))[:max_rows]]
    if not rows:
        return Ranker([0.0] * len(FEATURES), [0.0] * len(FEATURES), 0.0, 1.0)
    x = np.array([r[2:] for r in rows], float)
    good = np.array([r[1] == 1 for r in rows])
    mean, weight = fit_pairs(x, good)
    raw = (x - mean) @ weight
    threshold = float(np.quantile(raw, 1.0 - good.mean()))
    return Ranker(mean.tolist(), weight.tolist(), threshold, float(raw.std()) or 1.0)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Scores depend on the text alone.  Null and empty texts are scored alike;
    rows that share an id are scored each by its text (a null id is not held
    out); without usable labels every score is 0.5.  A very long text
    is measured whole by the task that reads it.  Only the named columns are
    read; empty input gives an empty result."""
    feats = features(docs, id_col, text_col)
    model = train(feats, labels, "doc_id", label_col, max_rows)
    s = feats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score"))
    return s.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
