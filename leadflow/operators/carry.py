"""Carry-over flag of a one-to-many match-merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sticky_flag(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                flag: Column, name: str) -> DataFrame:
    """``name`` = 1 once ``flag`` was true on this or an earlier row of the
    key, rows ordered by the columns ``order`` (ascending, nulls first).

    Computed without gathering a key's rows: the first flagged position per
    key is ``min(struct(order))`` - an aggregate with map-side partial
    aggregation, so even a key holding a third of all rows is reduced before
    the shuffle - joined back by key; a row is flagged when its position is
    at or after that first one.  Missing keys form one group, as in a SAS
    BY group (null-safe join).
    """
    pos = F.struct(*[F.col(f"`{c}`") for c in order])
    firsts = (df.filter(flag).groupBy(*keys).agg(F.min(pos).alias("_first"))
              .select(*[F.col(k).alias(f"_fk_{k}") for k in keys], "_first"))
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_fk_{k}"))
        cond = c if cond is None else cond & c
    out = df.join(firsts, cond, "left")
    return (out.withColumn(name, F.when(F.col("_first").isNotNull() & (pos >= F.col("_first")), F.lit(1))
                           .otherwise(F.lit(0)))
            .drop("_first", *[f"_fk_{k}" for k in keys]))
