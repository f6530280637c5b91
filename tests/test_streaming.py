"""A10: new files are read once; best leads re-derived from the history."""

import os

from leadflow import rules as R
from leadflow.streaming import best_leads_from_history, ingest_lead_files

HEADER = ["IRMPName", "Applicant SSN", "Sub ID", "Application Date", "Decision Date/Time",
          "Decision Status", "Loan Type", "Applicant Address State", "Applicant Credit Score",
          "Amt. Fin."]


def _file(folder, name, rows):
    with open(os.path.join(folder, name), "w", encoding="latin-1") as f:
        f.write(",".join(HEADER) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def _row(ssn, sub, date, score):
    return ["CreditPartner", ssn, sub, date, date, "Declined", "Personal", "SC", score, "1000.00"]


def test_incremental_ingest(spark, tmpdir_path):
    drop = os.path.join(tmpdir_path, "drop")
    os.makedirs(drop)
    hist, ckpt = os.path.join(tmpdir_path, "hist"), os.path.join(tmpdir_path, "ckpt")
    _file(drop, "a.csv", [_row("1", "10", "1/1/2020 9:00", "700"), _row("2", "20", "1/1/2020 9:00", "650")])
    _file(drop, "b.csv", [_row("3", "30", "1/2/2020 9:00", "600")])
    h1 = ingest_lead_files(spark, drop, hist, ckpt, max_files_per_trigger=1)
    assert sorted(r.sub_id for r in h1.collect()) == ["10", "20", "30"]
    # a later file: only it is read by the next run; person 1 gets a newer lead
    _file(drop, "c.csv", [_row("1", "11", "1/5/2020 9:00", "500")])
    h2 = ingest_lead_files(spark, drop, hist, ckpt, max_files_per_trigger=1)
    assert sorted(r.sub_id for r in h2.collect()) == ["10", "11", "20", "30"]
    best = {r.ssn: r.CK_TRACKING_ID for r in
            best_leads_from_history(h2, R.PROFILES["daily"].with_partner("CreditPartner")).collect()}
    assert best == {"000000001": "11", "000000002": "20", "000000003": "30"}


def test_stream_reads_each_file_by_its_header(spark, tmpdir_path):
    drop = os.path.join(tmpdir_path, "drop")
    os.makedirs(drop)
    for name, text in (("a.csv", "A,B\n10,20\n"), ("b.csv", "b,a\n21,11\n1,2,3\n"), ("c.csv", "A,C\nNA,Caf\u00e9\n")):
        with open(os.path.join(drop, name), "w", encoding="latin-1") as f:
            f.write(text)
    got = ingest_lead_files(spark, drop, os.path.join(tmpdir_path, "h"), os.path.join(tmpdir_path, "c"),
                            max_files_per_trigger=1, missing_text=R.PANDAS_MISSING_TEXT)
    rows = sorted(((r.a, r.b, r.c) for r in got.collect()), key=str)
    assert rows == [("10", "20", None), ("11", "21", None), (None, None, "Caf\u00e9")]
