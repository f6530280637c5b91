"""Lenient CSV, header normalisation, union, newest/oldest pick (A1-A4)."""

import os

from leadflow.sources.files import (list_files, newest_and_oldest,
                                    normalise_headers, normalise_name,
                                    read_lenient_csv, union_by_name)

HEADER = ["Applicant SSN", "Sub ID", "Amt. Fin.", "Decision Status"]


def write(path, text, encoding="latin-1"):
    with open(path, "wb") as f:
        f.write(text.encode(encoding))


def test_normalise_name():
    assert normalise_name("  Amt. Fin. ") == "amt._fin."
    assert normalise_name("Decision Date/Time") == "decision_date/time"


def test_lenient_csv_ragged_latin1(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "leads.csv")
    write(p, "Applicant SSN,Sub ID,Amt. Fin.,Decision Status\n"
             '123,1,100.5,"Auto Approved"\n'
             '124,2,200,"Declined",surplus\n'           # one field too many: dropped
             '125,3\n'                                   # too few: padded
             '126,4,300,"Caf\xe9 ""quoted""\nsecond line"\n')
    df = normalise_headers(read_lenient_csv(spark, p, HEADER))
    assert df.columns == ["applicant_ssn", "sub_id", "amt._fin.", "decision_status"]
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("123", "1", "100.5", "Auto Approved"),
                   ("125", "3", None, None),
                   ("126", "4", "300", 'Café "quoted"\nsecond line')]


def test_union_by_name(spark):
    a = spark.createDataFrame([("1", "x")], "a string, b string")
    b = spark.createDataFrame([("y", "2")], "b string, a string")
    c = spark.createDataFrame([("3",)], "a string")
    got = sorted(tuple(r) for r in union_by_name([a, b, c]).collect())
    assert got == [("1", "x"), ("2", "y"), ("3", None)]


def test_newest_and_oldest(spark, tmpdir_path):
    paths = []
    for i, name in enumerate(["b.csv", "a.csv", "c.csv"]):
        p = os.path.join(tmpdir_path, name)
        write(p, "x\n1\n")
        os.utime(p, (1_600_000_000 + i * 60, 1_600_000_000 + i * 60))
        paths.append(p)
    write(os.path.join(tmpdir_path, "_SUCCESS"), "")
    picked = newest_and_oldest(list_files(spark, tmpdir_path))
    assert [os.path.basename(p) for p in picked] == ["c.csv", "b.csv"]
    assert newest_and_oldest([("only", 5)]) == ["only"]
    assert newest_and_oldest([]) == []


def test_read_lead_files_missing_text(spark, tmpdir_path):
    from leadflow import rules as R
    from leadflow.sources.files import read_lead_files
    p1 = os.path.join(tmpdir_path, "a.csv")
    p2 = os.path.join(tmpdir_path, "b.csv")
    write(p1, "Applicant SSN,Sub ID,Amt. Fin.\n123,1,NA\n124,2,NULL\n")
    write(p2, "Sub ID,Applicant SSN\n3,n/a\n")
    got = sorted((tuple(r) for r in read_lead_files(spark, [p1, p2], R.PANDAS_MISSING_TEXT).collect()),
                 key=lambda t: t[1])
    assert got == [("123", "1", None), ("124", "2", None), (None, "3", None)]
    kept = sorted(tuple(r) for r in read_lead_files(spark, [p1]).collect())
    assert kept == [("123", "1", "NA"), ("124", "2", "NULL")]


def test_over_long_rows_by_number_of_fields(spark, tmpdir_path):
    from leadflow.sources.files import surplus_rows
    p = os.path.join(tmpdir_path, "a.csv")
    write(p, 'a,b\n1,2\n3,4,\n5,6,,\n7\n"8,""x""\n9","y"\n10,11,12\n13,14,15,16\n"17,18",\n')
    df = read_lenient_csv(spark, p, ["a", "b"])
    want = [("1", "2"), ("17,18", None), ("7", None), ('8,"x"\n9', "y")]
    assert sorted(tuple(r) for r in df.collect()) == want
    assert df.select("b").count() == len(want)                    # pruned columns change nothing
    assert sorted(r.b or "" for r in df.select("b").collect()) == ["", "", "2", "y"]
    bad = surplus_rows(spark, [p]).collect()
    assert len(bad) == 4 and {r.record.split(",")[0] for r in bad} == {"3", "5", "10", "13"}
    assert all(r.file.endswith("a.csv") and r.reject_reason for r in bad)


def test_files_of_one_header_are_one_scan(spark, tmpdir_path):
    from leadflow.sources.files import by_header
    for i, h in enumerate(["a,b", "b,a", "a,b"]):
        write(os.path.join(tmpdir_path, f"{i}.csv"), h + "\n1,2\n")
    write(os.path.join(tmpdir_path, "empty.csv"), "")
    groups = by_header(spark, [os.path.join(tmpdir_path, n) for n in ("0.csv", "1.csv", "2.csv", "empty.csv")])
    assert {k: len(v) for k, v in groups.items()} == {("a", "b"): 2, ("b", "a"): 1}


# ---- files in splits, and the order of their lines -------------------------

def test_order_of_lines_over_splits_and_files(spark, tmpdir_path):
    """Ties of the weekly pick follow file and line, in files of many splits."""
    import dataclasses
    from pathlib import Path

    from leadflow import rules as R
    from leadflow.plans.leads import best_leads, typed_leads
    from leadflow.sources.files import read_lead_files
    head = "IRMPName,Applicant SSN,IRPID,Application Number,Applicant Address Zip,App. Cell Phone,Decision Status," \
           "Loan Type,Applicant Address State,Sub ID,Application Date,Decision Date/Time,Applicant Credit Score,Amt. Fin."
    lines = [f'P,{k % 97},I,N,Z,,"Auto Approved",L,S,id{(k * 7919) % 6000:05},1/2/2020 3:04,1/2/2020 3:04,{600 + k % 3},10.5'
             for k in range(6000)]
    files = [f"{tmpdir_path}/{n}" for n in ("z first+1.csv", "a second.csv", "m, third.csv")]
    for i, f in enumerate(files):
        Path(f).write_text("\n".join([head, *lines[2000 * i:2000 * i + 2000]]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = read_lead_files(spark, files, with_order=True)
        assert raw.rdd.getNumPartitions() > 20
        assert [r.sub_id for r in raw.orderBy("_order").select("sub_id").collect()] == [x.split(",")[9] for x in lines]
        rules = dataclasses.replace(R.PROFILES["weekly"], partner=None)
        best = best_leads(typed_leads(raw, rules), rules)
        assert "_order" not in best.columns
        got = {r.ssn: r.CK_TRACKING_ID for r in best.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {}
    for k, x in enumerate(lines):
        f = x.split(",")
        p = int(f[1])
        if p not in want or int(f[12]) > want[p][0]:
            want[p] = int(f[12]), f[9]
    assert got == {p: t for p, (_, t) in want.items()}


def test_only_files_with_open_quotes_are_read_whole(spark, tmpdir_path):
    from pathlib import Path

    from leadflow.sources.files import open_quote_files, read_lead_files, scans
    plain, spans, doubled = (f"{tmpdir_path}/{n}.csv" for n in ("plain", "spans", "doubled"))
    Path(plain).write_text("A,B\n" + "".join(f"{i},x\n" for i in range(4000)))
    Path(spans).write_text('A,B\n1,"two\nlines"\n2,y\n')
    Path(doubled).write_text('A,B\n1,"say ""hi"", twice"\n')
    files = [plain, spans, doubled]
    assert open_quote_files(spark, files) == {1}
    assert scans(spark, files) == [(("A", "B"), [plain, doubled], False), (("A", "B"), [spans], True)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        df = read_lead_files(spark, files)
        assert df.rdd.getNumPartitions() > 5
        got = sorted((r.a, r.b) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted([(str(i), "x") for i in range(4000)] + [("1", "two\nlines"), ("2", "y"), ("1", 'say "hi", twice')])
    assert sorted((r.a, r.b) for r in read_lead_files(spark, files, multi_line=True).collect()) == got
