"""Outputs: partner feed, summaries, frequency and gap audit (A7-A9, B25,
B26, D3-D6, D8, E5, F1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadflow import rules as R


def partner_feed(funnel: DataFrame) -> DataFrame:
    """The 16 feed columns in their fixed order (one row per person)."""
    return funnel.select(*R.FEED_COLUMNS)


def _summary_aggs():
    return [
        F.count("IS_PREQUAL").alias("NUM_LEADS"),
        F.sum("IS_PREQUAL").cast("bigint").alias("NUM_PQ"),
        F.sum("IS_APPL").cast("bigint").alias("NUM_APPS"),
        F.sum("IS_APPROVE").cast("bigint").alias("NUM_APPR"),
        F.sum("IS_FUNDED").cast("bigint").alias("NUM_BOOKED"),
        F.sum("AMOUNT_FUNDED").cast("decimal(18,2)").alias("DOLLARS_BOOKED"),
        F.sum("COST").cast("bigint").alias("LEAD_COST"),
    ]


def daily_summary(funnel: DataFrame) -> DataFrame:
    """The six per-date summaries as one aggregation (one scan, one
    exchange); rows without a lead date are excluded, as the class
    statistics do."""
    return (funnel.filter(F.col("LEADDATE").isNotNull())
            .groupBy(F.to_date("LEADDATE").alias("LEADDATE")).agg(*_summary_aggs()))


_SUMMARY_OF = {"NUM_LEADS": "IS_PREQUAL", "NUM_PQ": "IS_PREQUAL", "NUM_APPS": "IS_APPL", "NUM_APPR": "IS_APPROVE",
               "NUM_BOOKED": "IS_FUNDED", "DOLLARS_BOOKED": "AMOUNT_FUNDED", "LEAD_COST": "COST"}
_MEASURES = tuple(dict.fromkeys(_SUMMARY_OF.values()))


def summary_changes(before: DataFrame, after: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What the funnel rows ``after`` in place of ``before`` change in the
    daily summary: per lead date, signed sums (``s_``) and signed numbers of
    values (``n_``) of each measure.  One partial aggregate over the changed
    rows alone; a row that is in both cancels out.  ``by``: columns that tell
    several batches apart, whose changes are then found together, in rows of
    their own."""
    cols = [*by, "LEADDATE", *_MEASURES]
    rows = before.select(*cols, F.lit(-1).alias("_sign")).unionByName(after.select(*cols, F.lit(1).alias("_sign")))
    sign = F.col("_sign")
    return (rows.filter(F.col("LEADDATE").isNotNull()).groupBy(*by, F.to_date("LEADDATE").alias("LEADDATE"))
            .agg(F.sum(sign).alias("n_rows"),
                 *[F.sum(F.when(sign > 0, F.col(c)).otherwise(-F.col(c))).alias(f"s_{c}") for c in _MEASURES],
                 *[F.sum(F.when(F.col(c).isNotNull(), sign)).alias(f"n_{c}") for c in _MEASURES]))


def corrected_summary(changes: DataFrame) -> DataFrame:
    """``daily_summary`` of the rows left after all ``changes`` (the rows of
    ``summary_changes`` of any number of batches, the first against nothing).
    A date without rows goes; a measure without values is null, as in a sum
    over them."""
    sums = changes.groupBy("LEADDATE").agg(F.sum("n_rows").alias("n_rows"), *[
        F.sum(f"{k}_{c}").alias(f"{k}_{c}") for c in _MEASURES for k in "sn"]).filter(F.col("n_rows") > 0)
    out = []
    for name, c in _SUMMARY_OF.items():
        n = F.coalesce(F.col(f"n_{c}"), F.lit(0))
        kind = "decimal(18,2)" if name == "DOLLARS_BOOKED" else "bigint"
        out.append((n if name == "NUM_LEADS" else F.when(n > 0, F.col(f"s_{c}"))).cast(kind).alias(name))
    return sums.select("LEADDATE", *out)


def daily_summary_total(funnel: DataFrame, keep_total: bool = True) -> DataFrame:
    """Per-date rows plus the grand-total row (``IS_TOTAL`` = 1).

    ``rollup`` + ``grouping()`` tells the total apart from a date that is
    missing; the reference deletes its total, ``keep_total`` chooses.
    """
    f = funnel.filter(F.col("LEADDATE").isNotNull()).withColumn("LEADDATE", F.to_date("LEADDATE"))
    out = f.rollup("LEADDATE").agg(*_summary_aggs(), F.grouping("LEADDATE").alias("IS_TOTAL"))
    out = out.withColumn("IS_TOTAL", F.col("IS_TOTAL").cast("int"))
    return out if keep_total else out.filter(F.col("IS_TOTAL") == 0)


def weekly_summary(funnel: DataFrame) -> DataFrame:
    """Summary by lead week (Monday start) with a total row and ratios.

    The ratio definitions are ours (the reference leaves them to a
    workbook): each stage over the stage before it, and cost per booking.
    """
    f = (funnel.filter(F.col("LEADDATE").isNotNull())
         .withColumn("LEAD_WEEK", F.to_date(F.date_trunc("week", F.col("LEADDATE")))))
    out = f.rollup("LEAD_WEEK").agg(*_summary_aggs(), F.grouping("LEAD_WEEK").cast("int").alias("IS_TOTAL"))

    def ratio(n, d):
        return F.try_divide(F.col(n).cast("double"), F.col(d).cast("double"))

    return out.select(
        "LEAD_WEEK", "IS_TOTAL", "NUM_LEADS", "NUM_PQ", "NUM_APPS", "NUM_APPR",
        "NUM_BOOKED", "DOLLARS_BOOKED", "LEAD_COST",
        ratio("NUM_PQ", "NUM_LEADS").alias("PQ_RATE"),
        ratio("NUM_APPS", "NUM_PQ").alias("APP_RATE"),
        ratio("NUM_APPR", "NUM_APPS").alias("APPROVAL_RATE"),
        ratio("NUM_BOOKED", "NUM_APPR").alias("BOOKING_RATE"),
        ratio("LEAD_COST", "NUM_BOOKED").alias("COST_PER_BOOKED"))


def funnel_frequency(funnel: DataFrame) -> DataFrame:
    """Count of each flag combination with percent and cumulative
    columns (listing order = flags ascending).

    The grouped result has at most 2^5 rows, so the running sums use a
    global window over that tiny result only.
    """
    flags = list(R.FUNNEL_FLAGS)
    g = funnel.groupBy(*flags).agg(F.count(F.lit(1)).alias("Funnel"))
    order = Window.orderBy(*[F.col(c).asc() for c in flags]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    total = Window.partitionBy(F.lit(1))
    return (g.withColumn("_total", F.sum("Funnel").over(total))
             .withColumn("Cumulative_Frequency", F.sum("Funnel").over(order))
             .select(*flags, "Funnel",
                     (F.col("Funnel") * 100.0 / F.col("_total")).alias("Percent"),
                     "Cumulative_Frequency",
                     (F.col("Cumulative_Frequency") * 100.0 / F.col("_total")).alias("Cumulative_Percent")))


def funnel_gaps(funnel: DataFrame) -> DataFrame:
    """Flag combinations with a 0 above a 1 in the funnel, with counts
    and the first broken step (e.g. funded but not approved)."""
    flags = list(R.FUNNEL_FLAGS)
    broken = None
    for upper, lower in zip(flags, flags[1:]):
        cond = (F.col(upper) == 0) & (F.col(lower) == 1)
        broken = (F.when(cond, F.lit(f"{lower} without {upper}")) if broken is None
                  else broken.when(cond, F.lit(f"{lower} without {upper}")))
    return (funnel.withColumn("GAP", broken).filter(F.col("GAP").isNotNull())
            .groupBy(*flags, "GAP").agg(F.count(F.lit(1)).alias("Funnel")))
