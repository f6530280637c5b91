"""Places of rows: in their group, without gathering it, and in their files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadflow.operators.stage import stage

_ROW_BITS = 33              # monotonically_increasing_id: partition above, row below


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str,
                scope: str | None = None) -> DataFrame:
    """``df`` with ``name`` = 1, 2, ... within each group of equal ``keys``
    (missing keys are one group) by ``order``, which should be total.

    Rows are range-partitioned by (keys, order) and written in that order, so
    a group may lie in many partitions, however large it is.  The rows of
    each partition are counted, the counts summed up over the partitions (one
    row each), and a row's number is its place among all rows less the place
    of its group's first one, a minimum that is pre-aggregated."""
    place, part, before, first = "_place", "_part", "_before", "_first"
    by = [*[F.col(f"`{k}`").asc() for k in keys], *order]
    rows = stage(df.repartitionByRange(*by).sortWithinPartitions(*by)
                 .withColumn(place, F.monotonically_increasing_id()), "numbered", scope)
    rows = rows.withColumn(part, F.shiftright(place, _ROW_BITS))
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(part, F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias(before))
    at = rows.join(counts, part).withColumn(
        place, F.col(before) + F.col(place).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).drop(part, before)
    firsts = at.groupBy(*keys).agg(F.min(place).alias(first)).withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = None
    for k in keys:
        c = F.col(f"`{k}`").eqNullSafe(F.col(f"`_k_{k}`"))
        same = c if same is None else same & c
    return (at.join(firsts, same).withColumn(name, F.col(place) - F.col(first) + 1)
            .drop(place, first, *[f"_k_{k}" for k in keys]))


def input_order(position: Column) -> Column:
    """The place of a row just read from files: its file's ``position``, the
    place of the split in the file, and the row's place among the rows of its
    task.  A split is read by one task from start to end, so these order rows
    by file and line, whatever the splits; no row has to be counted for it.
    Use it on the columns of the scan itself."""
    return F.struct(position.alias("file"), F.col("_metadata.file_block_start").alias("split"),
                    F.monotonically_increasing_id().alias("row"))
