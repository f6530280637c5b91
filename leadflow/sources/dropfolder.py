"""Partner drop folders built from table data (for the file sources)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.sources.files import _hadoop_fs


def csv_field(c: Column) -> Column:
    """One CSV field as pandas writes text: quoted, quotes doubled; null is
    an empty, unquoted field."""
    return F.when(c.isNull(), F.lit("")).otherwise(
        F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit('"'), F.lit('""')), F.lit('"')))


def csv_line(cols: Sequence[Column]) -> Column:
    return F.concat_ws(",", *[csv_field(c) for c in cols])


def write_batched_files(lines: DataFrame, folder: str, header_line: str,
                        order: Sequence[Column] = ()) -> str:
    """Write ``lines`` (columns ``batch`` date, ``value`` text) as one CSV
    file per batch date, header first, into ``folder/<yyyy-mm-dd>.csv``,
    and stamp each file's modification time with its date (newest batch =
    newest file).  One file per batch is the delivery unit; batches are
    spread over tasks by the shuffle.  ``order``: of the lines in each file,
    by columns of ``lines``.  ``folder`` must be a new one.
    """
    spark = lines.sparkSession
    staging = f"{folder}/_staging"
    # lines leave as Latin-1 bytes, the encoding that deliveries have
    latin = F.encode(F.col("value"), "ISO-8859-1").cast("string")
    places = [c.alias(f"_by{i}") for i, c in enumerate(order)]
    keyed = lines.select(F.date_format("batch", "yyyy-MM-dd").alias("batch"), latin.alias("value"), *places)
    hdr = keyed.select("batch").distinct().select("batch", F.lit(0).alias("_o"),
                                                  F.lit(header_line).alias("value"))
    by = [f"_by{i}" for i in range(len(places))]
    body = keyed.select("batch", F.lit(1).alias("_o"), "value", *by)
    # Sorted by (batch, _o) before the write, so the writer's own ordering
    # requirement (by batch) is already met and the header stays first.
    (body.unionByName(hdr, allowMissingColumns=True).repartition("batch").sortWithinPartitions("batch", "_o", *by)
     .drop("_o", *by).write.mode("overwrite").partitionBy("batch").text(staging))
    jvm = spark.sparkContext._jvm
    fs, root = _hadoop_fs(spark, staging)
    import datetime as dt
    for d in fs.listStatus(root):
        name = d.getPath().getName()
        if not name.startswith("batch="):
            continue
        day = name.split("=", 1)[1]
        ms = int(dt.datetime.strptime(day, "%Y-%m-%d").replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
        for f in fs.listStatus(d.getPath()):
            if f.getPath().getName().startswith("part-"):
                dst = jvm.org.apache.hadoop.fs.Path(f"{folder}/{day}.csv")
                if not fs.rename(f.getPath(), dst):
                    raise OSError(f"cannot move {f.getPath()} to {dst}")
                fs.setTimes(dst, ms, -1)
    fs.delete(jvm.org.apache.hadoop.fs.Path(staging), True)
    return folder
