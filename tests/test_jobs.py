"""The programs end to end: drop folder -> report files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from leadflow import rules as R
from leadflow.catalog import lead_drop_folder
from leadflow.plans.jobs import daily_job, weekly_job
from leadflow.sources.files import list_files, read_header
from leadflow.sources.standins import APP_DATE_FLOOR, LEAD_FILE_HEADER

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SMALL), reason="driver tables missing")


def test_read_header(spark):
    folder = lead_drop_folder(spark, SMALL)
    path = list_files(spark, folder)[0][0]
    assert read_header(spark, path) == list(LEAD_FILE_HEADER)


def test_daily_and_weekly_jobs(spark, tmpdir_path):
    folder = lead_drop_folder(spark, SMALL)
    from leadflow.session import scratch_path
    stage_root = scratch_path(spark, "stage")
    before = set(os.listdir(stage_root)) if os.path.isdir(stage_root) else set()
    out = daily_job(spark, SMALL, folder, f"{tmpdir_path}/daily", dt.date(2020, 1, 3))
    assert len(out["files"]) == 2
    after = set(os.listdir(stage_root)) if os.path.isdir(stage_root) else set()
    assert after <= before                      # the job's staged pivots were removed
    leads = (spark.read.option("header", True).csv(out["files"])
             .filter(F.col("IRMPName") == R.PROFILES["daily"].partner))
    persons = leads.select("Applicant SSN").distinct().count()
    feed = spark.read.option("header", True).csv(out["feed"])
    assert feed.count() == persons > 0
    assert spark.read.parquet(out["snapshot"]).select("run_date").distinct().count() == 1

    rules = R.PROFILES["weekly"].with_floor(APP_DATE_FLOOR)
    files = [p for p, _ in list_files(spark, folder)]
    wk = weekly_job(spark, SMALL, files, f"{tmpdir_path}/weekly", dt.date(2020, 1, 3), rules)
    summary = spark.read.option("header", True).csv(wk["summary"])
    weekly_feed = spark.read.option("header", True).csv(wk["feed"])
    total = summary.agg(F.sum(F.col("NUM_LEADS").cast("long"))).collect()[0][0]
    assert total == weekly_feed.count() > 0
    assert spark.read.option("header", True).csv(wk["weekly_summary"]).filter("IS_TOTAL = 1").count() == 1


@pytest.mark.parametrize("single", [False, True])
def test_jobs_write_part_files_unless_asked(spark, tmpdir_path, monkeypatch, single):
    from leadflow.plans import jobs
    asked, write = [], jobs.write_partner_feed

    def noted(*args, **kw):
        asked.append(kw.get("single_file", False))
        return write(*args, **kw)

    monkeypatch.setattr(jobs, "write_partner_feed", noted)
    folder, day = lead_drop_folder(spark, SMALL), dt.date(2020, 1, 3)
    choice = {"single_file": True} if single else {}
    feeds = [daily_job(spark, SMALL, folder, f"{tmpdir_path}/d", day, **choice)["feed"],
             weekly_job(spark, SMALL, [p for p, _ in list_files(spark, folder)], f"{tmpdir_path}/w", day, **choice)["feed"]]
    assert asked == [single, single]
    for feed in feeds:
        assert os.path.isfile(feed) is single and os.path.isdir(feed) is not single
        assert spark.read.option("header", True).csv(feed).count() > 0


def test_weekly_v2_hand_off(spark, tmpdir_path):
    """weekly_v2 reading the daily job's snapshot gives the same feed as
    weekly_v2 querying the apps itself (same partner, same persons)."""
    folder = lead_drop_folder(spark, SMALL)
    day = dt.date(2020, 1, 6)
    out = daily_job(spark, SMALL, folder, f"{tmpdir_path}/d", day)
    rules = R.PROFILES["weekly_v2"].with_floor(APP_DATE_FLOOR)
    a = weekly_job(spark, SMALL, out["files"], f"{tmpdir_path}/w1", day, rules,
                   snapshot_path=out["snapshot"], snapshot_date=day)
    b = weekly_job(spark, SMALL, out["files"], f"{tmpdir_path}/w2", day, rules)
    fa = spark.read.option("header", True).csv(a["feed"])
    fb = spark.read.option("header", True).csv(b["feed"])
    assert fa.count() == fb.count() > 0
    assert fa.exceptAll(fb).count() == 0 and fb.exceptAll(fa).count() == 0


def test_replace_keeps_the_old_one_when_a_move_fails(spark, tmpdir_path):
    from leadflow.plans.sinks import replace_path
    from leadflow.sources.files import _hadoop_fs
    old, new = os.path.join(tmpdir_path, "feed.csv"), os.path.join(tmpdir_path, "new.csv")
    for p, t in ((old, "old"), (new, "new")):
        with open(p, "w") as f:
            f.write(t)
    fs, missing = _hadoop_fs(spark, os.path.join(tmpdir_path, "not there"))
    with pytest.raises(Exception):
        replace_path(spark, fs, missing, old)
    assert open(old).read() == "old"
    replace_path(spark, fs, _hadoop_fs(spark, new)[1], old)
    assert open(old).read() == "new" and not os.path.exists(old + "._old")


def test_feed_as_parts_and_settings(spark, tmpdir_path):
    from leadflow.plans.profile_run import Run
    from leadflow.plans.reports import partner_feed
    from leadflow.plans.sinks import write_partner_feed, write_snapshot
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    run = Run(spark, SMALL)
    for _ in range(2):
        path = write_partner_feed(partner_feed(run.staged_funnel), tmpdir_path, dt.date(2020, 1, 3))
    assert os.path.isdir(path)
    assert spark.read.option("header", True).csv(path).count() == run.staged_funnel.count()
    for day in (3, 4, 3):
        write_snapshot(run.snapshot, f"{tmpdir_path}/s", dt.date(2020, 1, day))
    assert spark.read.parquet(f"{tmpdir_path}/s").groupBy("run_date").count().select("count").distinct().count() == 1
    assert spark.conf.get(key) == before


def test_own_servicing_tables_and_apps_file(spark, tmpdir_path):
    """Relations read from Parquet folders, and the weekly program fed by an
    apps file, give the rows of the stand-in run."""
    from leadflow.plans.applications import app_workbook, read_apps_file
    from leadflow.plans.profile_run import Run
    from leadflow.sources.servicing import Servicing
    from leadflow.sources.standins import stand_in_servicing
    from leadflow.sources.tables import Tables
    relations = stand_in_servicing(Tables(spark, SMALL))
    for n in Servicing.relations():
        getattr(relations, n).write.parquet(f"{tmpdir_path}/srv/{n}")
    own = Servicing.from_folder(spark, f"{tmpdir_path}/srv")
    a, b = Run(spark, SMALL, "daily").funnel, Run(spark, SMALL, "daily", servicing=own).funnel
    assert a.count() > 0 and a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    for profile in ("weekly", "weekly_v2"):
        plain = Run(spark, SMALL, profile)
        (app_workbook(plain.snapshot, plain.rules).withColumn("ApplicationEnterDate", F.date_format("ApplicationEnterDate", "MM/dd/yyyy"))
         .write.option("header", True).option("quoteAll", True).option("escape", '"').csv(f"{tmpdir_path}/apps_{profile}"))
        files = [p for p, _ in list_files(spark, f"{tmpdir_path}/apps_{profile}")]
        from_file = Run(spark, SMALL, profile, apps=read_apps_file(spark, files, plain.rules))
        x, y = plain.funnel, from_file.funnel
        assert x.count() > 0 and x.exceptAll(y).count() == y.exceptAll(x).count() == 0


def test_unmapped_status_code_is_not_lost(spark):
    """A status code that only the user's own code table knows."""
    from pyspark.sql import functions as G
    from leadflow.plans.profile_run import Run
    from leadflow.sources.standins import stand_in_servicing
    from leadflow.sources.tables import Tables
    from dataclasses import replace
    s = stand_in_servicing(Tables(spark, SMALL))
    other = replace(s, task=s.task.withColumn("status_code_id", G.col("status_code_id") + 40),
                    task_status_codes=s.task_status_codes.withColumn("status_code_id", G.col("status_code_id") + 40))
    a, b = Run(spark, SMALL, servicing=s).snapshot, Run(spark, SMALL, servicing=other).snapshot
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_each_job_derives_its_tables_once(spark, tmpdir_path, monkeypatch):
    from leadflow.plans import applications, profile_run
    from leadflow.operators import stage as plain
    names = []

    def counted(df, name, scope=None):
        names.append(name)
        return plain(df, name, scope)

    monkeypatch.setattr(applications, "stage", counted)
    monkeypatch.setattr(profile_run, "stage", counted)
    folder = lead_drop_folder(spark, SMALL)
    daily_job(spark, SMALL, folder, f"{tmpdir_path}/d", dt.date(2020, 1, 3))
    assert sorted(names) == ["best_leads_daily", "funnel_daily", "loans", "tasks"]
    names.clear()
    weekly_job(spark, SMALL, [p for p, _ in list_files(spark, folder)], f"{tmpdir_path}/w", dt.date(2020, 1, 3))
    assert sorted(names) == ["apps_weekly", "best_leads_weekly", "funnel_weekly", "loans", "tasks"]
