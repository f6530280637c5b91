"""Materialising a small pivot relation once (lineage cut)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from leadflow.session import scratch_path


def stage(df: DataFrame, name: str, scope: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back.

    Used for relations that several later scans filter by (the lead
    persons' candidate tasks and loans): they are computed once instead of
    once per reference, the lineage is cut (an executor lost later does not
    recompute the leads), and the planner sees their real file size, so a
    broadcast of them is decided on a measured size, not a guess.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage", *([scope] if scope else []), name, unique=True)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: no footer-reading job when reading it back
    return spark.read.schema(df.schema).parquet(path)


def drop_scope(spark, scope: str) -> None:
    """Delete every table staged under ``scope`` (once nothing reads them)."""
    from leadflow.sources.files import _hadoop_fs
    fs, p = _hadoop_fs(spark, scratch_path(spark, "stage", scope))
    if fs.exists(p):
        fs.delete(p, True)
