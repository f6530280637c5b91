"""Best row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (a total order: callers
    append tiebreak columns so the pick is deterministic).

    ``row_number() ... = 1`` lets Catalyst insert a partial
    ``WindowGroupLimit`` below the shuffle: each map task keeps only its own
    best row per key, so even a key holding a third of all rows sends one
    row per task through the exchange.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))
