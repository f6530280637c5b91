"""The reference programs as jobs: files in, report files out.

``daily_job``: newest + oldest lead file of a drop folder -> daily profile ->
dated application snapshot (A7), partner feed (A8), frequency listing (D5).
``weekly_job``: lead files -> weekly profile -> partner feed, daily summary
(A9) and weekly summary (D8).  Servicing relations are passed in, or derived
from the tables at ``sf_dir`` (stand-ins).  Both write the rows they could
not use, with a reason, and derive each intermediate table once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from leadflow import rules as R
from leadflow.functions.dates import guess_dates
from leadflow.plans.applications import read_apps_file
from leadflow.plans.leads import (DATE_COLUMNS, lead_rejects,
                                  partner_filter)
from leadflow.plans.profile_run import Run
from leadflow.plans.reports import (daily_summary, funnel_frequency,
                                    partner_feed, weekly_summary)
from leadflow.plans.sinks import (write_partner_feed, write_snapshot,
                                  write_summary)
from leadflow.sources.files import (ORDER_COL, list_files, newest_and_oldest,
                                    read_lead_files, surplus_rows)
from leadflow.sources.servicing import Servicing


def write_rejects(spark: SparkSession, files, raw, rules: R.FunnelRules, path: str, guesses=None) -> None:
    """Rows dropped by the reader (more fields than the header) and lead rows
    with no person key, a bad amount or a date that cannot be read, as JSON
    lines with file and reason."""
    surplus_rows(spark, files).write.mode("overwrite").json(f"{path}/files")
    lead_rejects(raw, rules, guesses).drop(ORDER_COL).write.mode("overwrite").json(f"{path}/leads")


def daily_job(spark: SparkSession, sf_dir: str, drop_folder: str, out_dir: str,
              run_date: dt.date, rules: R.FunnelRules = R.PROFILES["daily"],
              servicing: Servicing | None = None, single_file: bool = False) -> dict:
    """The snapshot is written first and read back, and the funnel is staged
    once, so feed and frequency listing share one derivation.  The feed is a
    folder of part files; ``single_file`` makes one file of them.

    The date columns are read as the files' rows themselves suggest (B4);
    ``date_guesses`` of the result says how, and which are ambiguous."""
    files = newest_and_oldest(list_files(spark, drop_folder))
    raw = read_lead_files(spark, files, missing_text=R.PANDAS_MISSING_TEXT)
    guesses = guess_dates(partner_filter(raw, rules.partner), DATE_COLUMNS)
    first = Run(spark, sf_dir, raw_leads=raw, rules=rules, servicing=servicing, guesses=guesses)
    out = {"files": files,
           "date_guesses": guesses,
           "snapshot": f"{out_dir}/app_snapshot",
           "rejects": f"{out_dir}/rejects_{run_date:%m%d%Y}",
           "frequency": f"{out_dir}/frequency_{run_date:%m%d%Y}"}
    try:
        write_rejects(spark, files, raw, rules, out["rejects"], guesses)
        write_snapshot(first.snapshot, out["snapshot"], run_date)
        run = first.with_snapshot(read_snapshot(spark, out["snapshot"], run_date))
        out["feed"] = write_partner_feed(partner_feed(run.staged_funnel), f"{out_dir}/feed", run_date, rules,
                                         single_file=single_file)
        (funnel_frequency(run.staged_funnel).coalesce(1).write.mode("overwrite")
         .option("header", True).csv(out["frequency"]))
    finally:
        first.cleanup()          # outputs are written; staged pivots go
    return out


def read_snapshot(spark: SparkSession, path: str, run_date: dt.date):
    """One day's application snapshot written by ``daily_job`` (hand-off)."""
    from pyspark.sql import functions as F
    return (spark.read.parquet(path).filter(F.col("run_date") == F.lit(run_date))
            .drop("run_date"))


def weekly_job(spark: SparkSession, sf_dir: str, lead_paths, out_dir: str,
               run_date: dt.date, rules: R.FunnelRules = R.PROFILES["weekly"],
               snapshot_path: str | None = None,
               snapshot_date: dt.date | None = None,
               servicing: Servicing | None = None, apps_files=None,
               single_file: bool = False) -> dict:
    """The apps come from ``apps_files`` (exported apps files), or from the
    daily job's snapshot of ``snapshot_date`` at ``snapshot_path`` (the
    weekly_v2 hand-off), or else from the servicing relations.  The feed is
    a folder of part files; ``single_file`` makes one file of them."""
    snap = read_snapshot(spark, snapshot_path, snapshot_date) if snapshot_path else None
    apps = read_apps_file(spark, apps_files, rules) if apps_files else None
    files = list(lead_paths)
    raw = read_lead_files(spark, files, with_order=True)
    run = Run(spark, sf_dir, raw_leads=raw, rules=rules, snapshot=snap, servicing=servicing, apps=apps)
    out = {"summary": f"{out_dir}/summary_{run_date:%m%d%Y}",
           "rejects": f"{out_dir}/rejects_{run_date:%m%d%Y}",
           "weekly_summary": f"{out_dir}/weekly_summary_{run_date:%m%d%Y}"}
    try:
        write_rejects(spark, files, raw, rules, out["rejects"])
        funnel = run.staged_funnel
        out["feed"] = write_partner_feed(partner_feed(funnel), f"{out_dir}/feed", run_date, rules,
                                         single_file=single_file)
        write_summary(daily_summary(funnel), out["summary"])
        (weekly_summary(funnel).orderBy("IS_TOTAL", "LEAD_WEEK").coalesce(1)
         .write.mode("overwrite").option("header", True).csv(out["weekly_summary"]))
    finally:
        run.cleanup()
    return out
