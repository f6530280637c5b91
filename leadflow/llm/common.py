"""Small helpers shared by the training-data operators.

Words everywhere are maximal runs of characters outside ``[\\x20\\x09-\\x0D]``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.operators.stage import stage
from leadflow.session import scratch_path

WORD_SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Array of the words of ``text`` (null text: empty array)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_SPACE + "+"), "")


def internal(name: str, taken: Sequence[str]) -> str:
    """A column name that no input column has (case-insensitively)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def stage_parallelism(spark: SparkSession) -> int:
    """Reducers of the session: the shuffle partition setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage_by_key(df: DataFrame, name: str, key: str) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``key``, as many as
    the session has reducers, and read back: joins on ``key`` then shuffle
    only their other side.  The table name serves to declare the buckets and
    is given up at once; the files stay like those of ``stage``."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    (df.write.bucketBy(stage_parallelism(spark), key).option("path", scratch_path(spark, "stage", table))
     .saveAsTable(table))
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")        # an external table: its files are kept
    return out


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         max_rounds: int = 60) -> DataFrame:
    """(node, comp): the smallest node reachable over undirected ``edges``.

    Alternating large-star / small-star rounds: each round points a node's
    larger neighbours (then its smaller ones and itself) at the node's least
    neighbour, so a component of n nodes becomes a star in O(log n) rounds.
    Per-node minima are grouped aggregates joined back on the node, so a
    node with a third of all edges is pre-aggregated before the shuffle and
    its join partition can be split.  Every round is written to the shared
    folder, which cuts the lineage.  Empty edges give an empty result;
    self-loops and repeated edges change nothing.  Raises if the rounds run
    out, rather than return unfinished labels.
    """
    e = stage(edges.select(F.col(src).cast("long").alias("u"), F.col(dst).cast("long").alias("v"))
              .filter("u <> v").distinct(), "cc")
    for _ in range(max_rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stage(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"),
                                                                   F.col("m").alias("v"))
                      .filter("u <> v").distinct(), "cc")
        # every edge now points from the larger node u to a smaller node v
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = stage(large.join(low, "u")
                      .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                                F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                              .alias("p")).select("p.u", "p.v").filter("u <> v").distinct(), "cc")
        # a forest of stars: nobody has two parents, no parent has a parent
        unsettled = small.groupBy("u").count().filter("count > 1").select("u").union(
            small.join(small.select(F.col("u").alias("p")).distinct(), F.col("v") == F.col("p"),
                       "left_semi").select("u"))
        e = small
        if unsettled.isEmpty():
            break
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
