"""B4 with guessed formats: readings, evidence and what nothing decides."""

import datetime as dt

from leadflow import rules as R
from leadflow.functions.dates import date_evidence, guess_dates, read_dates
from leadflow.plans.leads import lead_rejects, typed_leads
from leadflow.sources.files import normalise_headers


def _read(spark, texts, day_first=()):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, `a/b` string")
    return [r[0] for r in df.orderBy("i").select(read_dates("a/b", day_first)).collect()]


def test_ways_to_write_a_date(spark):
    day = dt.datetime(2019, 3, 5)
    same = ["2019-03-05", "2019/3/5", "20190305", "5 Mar 2019", "5-mar-2019", "March 5, 2019", "mar. 5 2019",
            "3/5/2019", "03-05-19", " 3.5.2019 ", "2019-03-05 12:00 AM"]
    assert _read(spark, same) == [day] * len(same)
    clock = ["3/5/2019 15:04", "3/5/2019 3:04 PM", "2019-03-05T15:04:00", "3/5/2019 03:04 p.m."]
    assert _read(spark, clock) == [dt.datetime(2019, 3, 5, 15, 4)] * len(clock)
    assert _read(spark, ["3/5/2019 1:02:03.5"]) == [dt.datetime(2019, 3, 5, 1, 2, 3, 500000)]
    assert _read(spark, ["1/2/69", "1/2/68"]) == [dt.datetime(1969, 1, 2), dt.datetime(2068, 1, 2)]


def test_what_is_no_date(spark):
    bad = [None, "", "  ", "NaT", "2019", "2019-13-01", "29/2/2019", "31.4.2020", "5 Marx 2019", "3/5/2019 25:00",
           "3/5/2019 13:00 PM", "3/5-2019", "3/5/2019 and more", "2019-03-05 10:00+02:00", "x" * 100_000]
    assert _read(spark, bad) == [None] * len(bad)


def test_all_days_of_all_orders(spark):
    """Every day of a leap year and a common year, month first and day first."""
    days = [dt.date(2019, 1, 1) + dt.timedelta(k) for k in range(731)]
    want = [dt.datetime.combine(d, dt.time()) for d in days]
    assert _read(spark, [f"{d.day}.{d.month}.{d.year}" for d in days], (".",)) == want
    assert _read(spark, [f"{d.month}.{d.day}.{d.year}" for d in days]) == want
    assert _read(spark, [f"{d:%d %B %Y}" for d in days]) == want


def test_evidence_decides_each_separator_apart(spark):
    rows = [("13/1/2020", "1/2/2020", "13-1-2020"), ("14/1/2020", "3/3/2020", "1-13-2020"), ("1/15/2020", None, ""),
            ("2/3/2020", "", "5-6-2020"), ("2.13.2020", "x", None), ("13/1/2020", "1/2/2020", "13-1-2020")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = {(r.column, r.separator): r for r in date_evidence(df, ["a", "b", "c"]).collect()}
    a = got["a", "/"]
    assert (a.n_text, a.n_unparsed, a.n_month_first, a.n_day_first, a.n_same, a.n_open) == (6, 0, 1, 3, 0, 1)
    assert (a.day_first, a.mixed, a.ambiguous) == (True, True, False)
    assert not got["a", "."].day_first and got["a", "."].n_month_first == 1
    b = got["b", "/"]
    assert (b.n_text, b.n_unparsed, b.n_same, b.n_open) == (4, 1, 1, 2) and b.ambiguous and not b.day_first
    c = got["c", "-"]
    assert (c.n_month_first, c.n_day_first, c.n_open, c.day_first, c.ambiguous) == (1, 2, 1, True, False)
    guess = guess_dates(df, ["a", "b", "c"])
    assert guess["a"].day_first == ("/",) and guess["b"].ambiguous == ("/",) and guess["b"].n_unparsed == 1
    read = [r[0] for r in df.select(guess["a"].parse()).collect()]
    assert read == [dt.datetime(2020, 1, 13), dt.datetime(2020, 1, 14), dt.datetime(2020, 1, 15),
                    dt.datetime(2020, 3, 2), dt.datetime(2020, 2, 13), dt.datetime(2020, 1, 13)]


def test_tie_and_empty(spark):
    df = spark.createDataFrame([("13/1/2020",), ("1/13/2020",), ("1/2/2020",)], "a string")
    g = guess_dates(df, ["a"])["a"]
    assert g.day_first == () and g.ambiguous == ("/",)          # as many of either kind: month first, and said so
    empty = spark.createDataFrame([], "a string, column string")
    assert date_evidence(empty, ["a", "column"]).collect() == []
    g = guess_dates(empty, ["a", "column"])
    assert g["column"].day_first == g["column"].ambiguous == () and g["a"].n_unparsed == 0


def test_leads_read_by_the_guess(spark):
    header = ["IRMPName", "Applicant SSN", "Sub ID", "Application Date", "Decision Date/Time", "Decision Status",
              "Loan Type", "Applicant Address State", "Applicant Credit Score", "Amt. Fin."]
    rows = [("CreditPartner", "1", "10", "13/2/2020 9:00", "2/13/2020", "Declined", "P", "SC", "700", "1"),
            ("CreditPartner", "1", "11", "1/3/2020 9:00", "soon", "Declined", "P", "SC", "700", "1")]
    raw = normalise_headers(spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in header)))
    rules = R.PROFILES["daily"].with_partner("CreditPartner")
    guess = guess_dates(raw, ["application_date", "decision_date/time"])
    leads = {r.CK_TRACKING_ID: r for r in typed_leads(raw, rules, guess).collect()}
    assert leads["10"].LEADDATE == dt.datetime(2020, 2, 13, 9) and leads["11"].LEADDATE == dt.datetime(2020, 3, 1, 9)
    assert leads["10"].DECISION_TS == dt.datetime(2020, 2, 13) and leads["11"].DECISION_TS is None
    why = {r.sub_id: r.reject_reason for r in lead_rejects(raw, rules, guess).collect()}
    assert why == {"11": "decision_date/time is not a date"}
