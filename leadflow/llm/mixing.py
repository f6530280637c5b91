"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words; a document's expected number of
copies is target / source size.  Within a source the documents are put in
order of size, their expected copies are prefix-summed, one random offset is
added, and a document is emitted once for every whole number its share of the
line crosses.  Ordering by size keeps the words taken within about one
document of the target, and of ``DRAWS`` random offsets the one that comes
nearest is the source's.

Main path: DataFrame functions only.  The prefix sum has two levels (range
partitions, then rows inside one), so a source with a third of all rows is
spread over as many tasks as any other rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadflow.llm.common import WORD, internal
from leadflow.operators.stage import stage

WEIGHTS = (5, 2, 1)      # by rank of the source, repeating
MAX_COPIES = 3
DRAWS = 16
BROADCAST_ROWS = 1_000_000
_ROW_BITS = 33           # monotonically_increasing_id: row number in the low bits


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def targets(source_sizes: DataFrame, weights: Sequence[float] = WEIGHTS,
            max_copies: float = MAX_COPIES) -> DataFrame:
    """source, source_size, target from (source, source_size), one row per source.

    Sources in code point order, null last, take the weights in turn.  The
    shares of the whole size are in proportion to the weights, stop at
    ``max_copies`` times the source's size, and the excess goes to the other
    sources by weight until none is above: target = min(cap, level * weight)
    with one level for all.  The level is found over the sources in order of
    cap / weight: the first prefix of capped sources after which the next
    source is not above its cap.  One row per source enters these windows."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = source_sizes.withColumn("weight", w).withColumn("cap", F.lit(max_copies) * F.col("source_size"))
    everything = Window.partitionBy()
    before, after = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    s = s.select("source", "source_size", "weight", "cap",
                 ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                  / F.sum("weight").over(after)).alias("level"))
    # the level of the first row (by cap / weight) that stays under its cap
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.min_by("level", F.when(fits, F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)
    return s.select("source", "source_size", F.least(F.col("cap").cast("double"), level * F.col("weight"))
                    .alias("target"))


def _offset(source: Column, seed: int, draw: int) -> Column:
    """A random offset of the source, in (0, 1) and off both ends."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{draw}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 7), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 28))


def _digest(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _mix_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES,
              seed: int = 17) -> DataFrame:
    # no row is counted twice: sizes are computed once and written
    sized = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                              _digest(F.col(text_col)).alias("digest"), n_words(F.col(text_col)).alias("size")), "mix_sizes")
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_copies)
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id").asc_nulls_last(),
             F.col("digest")]
    placed = stage(sized.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("at", F.monotonically_increasing_id()), "mix_order")
    row = F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = placed.withColumn("part", F.shiftright("at", _ROW_BITS)).withColumn("row", row)
    # one row per (range partition, source): at most partitions + sources rows
    per_part = placed.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = (per_part.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
                .select(F.col("source").alias("p_source"), F.col("part").alias("p_part"), "first", "before"))
    goal = goal.withColumnsRenamed({"source": "g_source"})
    per_part = stage(per_part.join(goal, F.col("p_source").eqNullSafe(F.col("g_source"))).drop("g_source"),
                     "mix_parts")
    # counted: broadcast up to BROADCAST_ROWS rows, beyond that an ordinary
    # join whose hot keys the skew handling splits
    small = F.broadcast if per_part.count() <= BROADCAST_ROWS else (lambda df: df)
    d = placed.join(small(per_part), F.col("source").eqNullSafe(F.col("p_source"))
                    & (F.col("part") == F.col("p_part")))
    # prefix sum of equal expectations: rank * rate, exact in the rank
    rank = F.col("before") + F.col("row") - F.col("first") + 1
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    d = d.withColumn("rank", rank).withColumn("rate", rate)

    def copies(offset: Column) -> Column:
        line = lambda k: F.floor(k * F.col("rate") + offset)
        return (line(F.col("rank")) - line(F.col("rank") - 1)).cast("long")

    # words each drawn offset would take: one row per source
    drawn = d.groupBy("source").agg(F.first("target").alias("target"), *[
        F.sum(copies(_offset(F.col("source"), seed, k)) * F.col("size")).alias(f"take{k}") for k in range(DRAWS)])
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"take{k}") - F.col("target")), F.lit(k),
                                             _offset(F.col("source"), seed, k).alias("offset")) for k in range(DRAWS)]))
    drawn = drawn.select(F.col("source").alias("o_source"), nearest["offset"].alias("offset"))
    d = d.join(small(drawn), F.col("source").eqNullSafe(F.col("o_source")))
    return (d.withColumn("copies", copies(F.col("offset")))
            .select("doc_id", "source", "digest", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row.

    size: words of the text (null text: 0).  copies is 0 to ``max_copies``;
    taken = copies * size.  A source without words has target 0 and no
    copies.  Null sources form one source.  The result depends only on the
    rows (ids break ties of size, wholly equal rows are interchangeable), so
    reruns agree; documents with null ids come last among their size.  A very
    long text is one document like any other: a number after its words are
    counted.  Empty input gives an empty result; only the three named columns
    are read."""
    return _mix_rows(docs, id_col, text_col, source_col, weights, max_copies, seed).drop("digest")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **kw) -> DataFrame:
    """The mix itself: ``docs`` (columns unchanged) with every row emitted as
    often as ``mix`` gives it copies.

    Rows are matched to their copies by id and text; rows equal in both are
    interchangeable, so per such key only the number of rows with 0, 1, ...
    copies travels, and the n-th of them takes the n-th number.  The texts
    are shuffled once.  Null ids, texts and sources match null; a null or
    wordless text has size 0 and is in the mix if ``mix`` gives it a copy.
    Other columns may have any name.  Empty input gives an empty result."""
    top = int(kw.get("max_copies", MAX_COPIES))
    key, digest, source, nth, copies, each, *upto = (
        internal(n, docs.columns) for n in ("_mix_id", "_mix_text", "_mix_source", "_mix_nth", "_mix_copies",
                                            "_mix_each", *[f"_mix_upto{k}" for k in range(top + 1)]))
    plan = (_mix_rows(docs, id_col, text_col, source_col, **kw)
            .groupBy(F.col("doc_id").alias(key), F.col("digest").alias(digest), F.col("source").alias(source))
            .agg(*[F.sum((F.col("copies") <= k).cast("long")).alias(c) for k, c in enumerate(upto)]))
    mine = [F.col(f"`{id_col}`"), _digest(F.col(f"`{text_col}`")), F.col(f"`{source_col}`")]
    numbered = docs.withColumn(nth, F.row_number().over(Window.partitionBy(*mine).orderBy(F.lit(0))))
    found = F.lit(True)
    for a, b in zip(mine, (key, digest, source)):
        found = found & a.eqNullSafe(F.col(b))
    n = sum([(F.col(nth) > F.col(c)).cast("int") for c in upto], F.lit(0))
    return (numbered.join(plan, found).withColumn(copies, n).filter(F.col(copies) > 0)
            .withColumn(each, F.explode(F.array_repeat(F.lit(True), F.col(copies))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
