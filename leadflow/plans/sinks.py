"""Sinks: dated application snapshot, partner CSV feed, summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow import rules as R
from leadflow.plans.one_file import write_one_csv


def write_snapshot(snapshot: DataFrame, path: str, run_date: dt.date) -> None:
    """Dated snapshot of all application rows, one partition per run
    date; rerunning a day replaces only that day (dynamic overwrite)."""
    (snapshot.withColumn("run_date", F.lit(run_date))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path))


def feed_for_csv(feed: DataFrame, rules: R.FunnelRules = R.DAILY) -> DataFrame:
    """The feed as its profile prints it, all columns text.

    Dates follow ``rules.feed_date_format`` (a lead time keeps its time of
    day); amounts have two decimals, or the fewest that tell them.  Numbers
    go through decimal(18,2) (half-up), not ``format_string``, which prints
    null as 'nu' and rounds differently.
    """
    kinds, out = dict(feed.dtypes), []
    for c in R.FEED_COLUMNS:
        col, kind = F.col(c), kinds[c]
        if kind.startswith("timestamp"):
            col = F.date_format(col, f"{rules.feed_date_format} HH:mm:ss")
        elif kind == "date":
            col = F.date_format(col, rules.feed_date_format)
        elif kind in ("double", "float") or kind.startswith("decimal"):
            col = col.cast("decimal(18,2)").cast("string")
            if rules.feed_numbers == "shortest":
                col = F.regexp_replace(col, r"\.?0+$", "")
        else:
            col = col.cast("string")
        out.append(col.alias(rules.funded_date_name if c == "FundedDate" else c))
    return feed.select(*out)


def write_partner_feed(feed: DataFrame, folder: str, run_date: dt.date, rules: R.FunnelRules = R.DAILY,
                       single_file: bool = False) -> str:
    """UTF-8 CSV, funded rows first, as the folder ``feed_MMDDYYYY`` of
    part files that follow each other in order, or, if asked for, as one
    file ``feed_MMDDYYYY.csv`` put together from such parts.

    The new feed is complete before the old one is touched, and the old one
    is deleted only after the new one has its name."""
    name = f"{folder.rstrip('/')}/feed_{run_date.strftime('%m%d%Y')}"
    staging, target = f"{name}._new", f"{name}.csv" if single_file else name
    rows = feed_for_csv(feed, rules)
    order = [F.col("IS_FUNDED").desc(), F.col("CK_TRACKING_ID").asc()]
    from leadflow.sources.files import _hadoop_fs
    fs, root = _hadoop_fs(feed.sparkSession, staging)
    if single_file:
        new = write_one_csv(rows, staging, order)
    else:
        (rows.orderBy(*order).write.mode("overwrite").option("header", True)
         .option("encoding", "UTF-8").option("nullValue", "").csv(staging))
        new = root
    replace_path(feed.sparkSession, fs, new, target)
    if single_file:
        fs.delete(root, True)
    return target


def _moved(fs, source, target) -> bool:
    from py4j.protocol import Py4JJavaError
    try:
        return bool(fs.rename(source, target))
    except Py4JJavaError:                   # some filesystems raise instead
        return False


def replace_path(spark: SparkSession, fs, new, target: str) -> None:
    """Give ``new`` the name ``target``.  What had that name is set aside,
    put back if the move fails, and deleted last."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    dst, aside = path(target), path(f"{target}._old")
    had = fs.exists(dst)
    if had:
        if fs.exists(aside):
            fs.delete(aside, True)
        if not _moved(fs, dst, aside):
            raise OSError(f"cannot set {target} aside")
    if not _moved(fs, new, dst):
        if had and not _moved(fs, aside, dst):
            raise OSError(f"cannot move {new} to {target}; the old one is {aside}")
        raise OSError(f"cannot move {new} to {target}")
    if had:
        fs.delete(aside, True)


def write_summary(summary: DataFrame, path: str) -> None:
    """Summary table as CSV."""
    summary.orderBy("LEADDATE").coalesce(1).write.mode("overwrite").option("header", True).csv(path)
