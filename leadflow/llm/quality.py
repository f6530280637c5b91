"""Quality rules as a short-circuit cascade.

Every rule is a condition under which a document is rejected.  On a sample
each rule's cost (seconds per row beyond reading the words) and selectivity
(share rejected) are estimated; the rules are then tried in order of
rejections per second, and a document that one rejects is not shown to the
later ones.  The order changes the work, never the verdict: a document is
kept when no rule rejects it.

DataFrame functions only.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import words
from leadflow.operators.stage import stage

SYMBOLS = r"[#*$%&|<>]"
SAMPLE_ROWS = 2_000


# ---- measures; w: array of words, t: the text (not null) -------------------

def n_words(t: Column, w: Column) -> Column:
    return F.size(w).cast("long")


def word_chars(t: Column, w: Column) -> Column:
    return F.char_length(F.array_join(w, "")).cast("long")


def n_symbols(t: Column, w: Column) -> Column:
    return (F.char_length(t) - F.char_length(F.translate(t, "#*$%&|<>", ""))).cast("long")


def _worded_lines(t: Column) -> Column:
    return F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(t: Column, w: Column) -> Column:
    return let(_worded_lines(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(t: Column, w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Windows are hashed to 64 bits and sorted with their places, so equal ones
    meet as neighbours; the places of repeated windows are sorted again and
    each adds the words it covers beyond the next one's start: n log n in the
    length of the text, whatever repeats."""
    last = F.size(w) - 2
    windows = F.transform(F.sequence(F.lit(1), last), lambda i: F.struct(
        F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)).alias("h"), i.alias("i")))
    return F.when(last < 2, F.lit(0)).otherwise(let(F.sort_array(windows), _covered)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: inside, it is a bound
    variable, which no optimizer rule can copy into several places."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(s: Column) -> Column:
    same = lambda x, k: x["h"].eqNullSafe(F.get(s, k)["h"])
    repeated = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
    return _span(F.sort_array(F.transform(repeated, lambda x: x["i"])))


def _span(p: Column) -> Column:
    """Words covered by 3-word windows that start at the sorted places ``p``."""
    return F.aggregate(p, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
                       lambda a, i: F.struct((i + 3).alias("end"),
                                             (a["n"] + 3 - F.greatest(F.lit(0), a["end"] - i)).alias("n")),
                       lambda a: a["n"])


MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
    "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words}


# ---- rules -----------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Column, Column], Column]     # (text, words) -> boolean


def _share(pattern: str, percent: int) -> Callable[[Column, Column], Column]:
    """Characters matching ``pattern`` make up more than ``percent`` of the text."""
    return lambda t, w: F.regexp_count(t, F.lit(pattern)) * 100 > F.char_length(t) * percent


BASE = (
    Rule("few_words", lambda t, w: n_words(t, w) < 50),
    Rule("repeated_windows", lambda t, w: 100 * n_repeat_words(t, w) > 50 * n_words(t, w)),
)
FURTHER = (
    # more symbols than one for every ten words
    Rule("symbols", lambda t, w: 10 * n_symbols(t, w) > n_words(t, w)),
    # more exclamation marks than one for every five words
    Rule("exclamations", lambda t, w: 5 * (F.char_length(t) - F.char_length(F.translate(t, "!", ""))) > n_words(t, w)),
    # more than half of the text in capitals
    Rule("capitals", _share(r"\p{Lu}", 50)),
    # words of 1 to 2 or over 20 characters on average
    Rule("word_length", lambda t, w: (word_chars(t, w) < 2 * n_words(t, w)) | (word_chars(t, w) > 20 * n_words(t, w))),
    # over half of the lines repeat an earlier one
    Rule("repeated_lines", lambda t, w: 2 * n_dup_lines(t, w) > F.size(_worded_lines(t))),
)
RULES = (*BASE, *FURTHER)


@dataclass(frozen=True)
class RuleStats:
    name: str
    seconds_per_row: float
    rejected: float


def estimate(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES,
             sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[RuleStats]:
    """Cost and selectivity of each rule on about ``sample_rows`` rows (all
    rows of a smaller table), by timing one aggregate per rule over the
    written sample.  Only the order of the rules depends on it.  An empty
    table gives cost and selectivity 0."""
    rows = docs.count()                       # Parquet metadata only
    part = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    if rows > sample_rows:
        part = part.sample(False, sample_rows / rows, seed)
    part = stage(part.coalesce(1) if rows <= sample_rows else part, "cascade_sample")
    read = part.withColumn("w", words(F.col("t")))

    def run(condition: Column) -> tuple[float, int, int]:
        began = time.perf_counter()
        n, bad = read.agg(F.count("w"), F.count_if(condition)).first()
        return time.perf_counter() - began, n, bad

    run(F.size("w") > 0)                      # opens the files, compiles the scan
    bare, n, _ = run(F.size("w") > 1)
    out = []
    for r in rules:
        took, _, bad = run(r.rejects(F.col("t"), F.col("w")))
        out.append(RuleStats(r.name, max(took - bare, 1e-6) / max(n, 1), bad / max(n, 1)))
    return out


def cascade_order(rules: Sequence[Rule], stats: Sequence[RuleStats]) -> list[Rule]:
    """Rules by rejections per second, most first; equal ones by name."""
    gain = {s.name: s.rejected / s.seconds_per_row for s in stats}
    return sorted(rules, key=lambda r: (-gain[r.name], r.name))


def first_rejection(rules: Sequence[Rule], t: Column, w: Column) -> Column:
    """Name of the first rule that rejects, null if none: a CASE stops at its
    first true branch, so later rules are not evaluated."""
    first, *rest = rules
    case = F.when(first.rejects(t, w), F.lit(first.name))
    for r in rest:
        case = case.when(r.rejects(t, w), F.lit(r.name))
    return case


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          rules: Sequence[Rule] = FURTHER, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the measures, base_failed and kept for every row.

    A null or empty text has no words: base_failed.  The base rules read
    measures that are reported anyway; the cascade runs on what they leave.
    Each row is judged by its own text, rows that repeat or share an id
    alike; a text exactly at a limit passes.  A very long text is judged
    whole, by the one task that reads it.  An empty table gives an empty
    result; only the id and text columns are read."""
    order = cascade_order(rules, estimate(docs, text_col, rules, sample_rows))
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def verdict(m: Column, w: Column) -> Column:
        failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
        kept = F.when(failed, F.lit(False)).otherwise(first_rejection(order, t, w).isNull())
        return F.struct(*[m[n].alias(n) for n in MEASURES], failed.alias("base_failed"), kept.alias("kept"))

    # one bound value for all: a later filter cannot copy the word split into
    # the loops over words
    judged = let(words(t), lambda w: let(F.struct(*[f(t, w).alias(n) for n, f in MEASURES.items()]),
                                         lambda m: verdict(m, w)))
    return docs.select(F.col(id_col).alias("doc_id"), judged.alias("m")).select(
        "doc_id", *[F.col(f"m.{c}").alias(c) for c in (*MEASURES, "base_failed", "kept")])


def keep_good(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES,
              sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` (columns unchanged) without the documents that a rule rejects;
    base and further rules form one cascade.  Verdicts are those of
    ``judge``: null and empty texts go, repeated rows stay or go together, a
    very long text is judged whole by one task, an empty table stays empty;
    of the columns only the text is looked at, others may have any name."""
    order = cascade_order(rules, estimate(docs, text_col, rules, sample_rows))
    t = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.filter(let(words(t), lambda w: first_rejection(order, t, w)).isNull())
