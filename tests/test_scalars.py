"""Scalar operators on the hand-made edge rows (FIXTURES.md section 7)."""

from decimal import Decimal

from pyspark.sql import functions as F

from leadflow import functions as L


def one(spark, schema, rows, *exprs):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_canonical_id(spark):
    rows = [("123",), ("12345678901",), (None,), ("000000123",)]
    got = one(spark, "k string", rows, L.canonical_id("k"), L.canonical_id("k", null_as="nan"))
    assert got == [("000000123", "000000123"), ("12345678901", "12345678901"),
                   (None, "000000nan"), ("000000123", "000000123")]


def test_canonical_id_numeric(spark):
    got = one(spark, "k string", [("123",), (" 42 ",), ("12x",), (None,)], L.canonical_id_numeric("k"))
    assert got == [(123,), (42,), (None,), (None,)]


def test_score_parse(spark):
    rows = [(None,), ("SHORT.1",), ("Score automobile.01",), ("FICO08-0712.5X",),
            ("FICO08-0712.5X   ",), ("ABCDEFGHIJKLMNOP",)]
    got = [r[0] for r in one(spark, "s string", rows, L.score_parse(F.col("s")))]
    assert got == [0, 0, 0, 712, 712, None]   # no '.' -> null (T-SQL would error)


def test_cost_tier(spark):
    rows = [(Decimal("0"),), (Decimal("2500"),), (Decimal("2500.01"),), (Decimal("-5"),), (None,)]
    got = one(spark, "a decimal(18,2)", rows, L.cost_tier("a", 125), L.cost_tier("a", 0))
    assert got == [(0, 0), (125, 125), (200, 200), (125, 0), (0, 0)]


def test_fallback_offer(spark):
    rows = [(None, 12.0), (0.0, 12.0), (36.0, 12.0), (-1.0, 12.0)]
    got = one(spark, "l double, s double", rows,
              L.fallback_offer("l", "s", False), L.fallback_offer("l", "s", True))
    assert got == [(None, 12.0), (12.0, 12.0), (36.0, 36.0), (12.0, 12.0)]


def test_row_max(spark):
    got = one(spark, "a double, b double", [(None, None), (1.0, None), (1.0, 3.0)], L.row_max("a", "b"))
    assert got == [(None,), (1.0,), (3.0,)]


def test_sentinel_and_text(spark):
    rows = [("None",), ("NULL",), ("",), ("LN1",), (None,)]
    got = one(spark, "x string", rows, L.sentinel_to_null("x", ["None", "NULL"]),
              L.text_coercion("x", "None"))
    assert got == [(None, "None"), (None, "NULL"), ("", ""), ("LN1", "LN1"), (None, "None")]


def test_parse_dates(spark):
    import datetime as dt
    rows = [("6/28/2018 9:30",), ("2018-06-28 09:30:00",), ("6/28/2018",), ("junk",), (None,)]
    got = [r[0] for r in one(spark, "s string", rows, L.parse_dates("s"))]
    assert got == [dt.datetime(2018, 6, 28, 9, 30), dt.datetime(2018, 6, 28, 9, 30),
                   dt.datetime(2018, 6, 28), None, None]


def test_int_fill_strict(spark):
    rows = [("12.9",), ("-12.9",), (None,), ("n/a",)]
    got = one(spark, "s string", rows, L.int_fill("s"), L.int_strict("s"))
    assert got == [(12, 12), (-12, -12), (0, None), (0, None)]


def test_final_loan_amount(spark):
    d = Decimal
    rows = [  # bal, loan, method, note, addon, payoff
        (None, None, None, None, None, None),
        (d("10.00"), "LN1", "SI", d("1.00"), None, None),
        (None, "LN1", "SI", d("1000000.25"), d("0.00"), "9,999.00"),
        (None, "LN1", "78", d("1000000.25"), None, "9,999.00"),
        (None, "LN1", "78", d("1000000.25"), None, None),
        (None, "", "XX", None, None, None),
    ]
    df = spark.createDataFrame(rows, "b decimal(18,2), n string, m string, o decimal(18,2), "
                                     "a decimal(18,2), p string")
    cols = [F.col(c) for c in "bnmoap"]
    got = [r[0] for r in df.select(L.final_loan_amount(*cols)).collect()]
    assert got == [d("0.00"), d("10.00"), d("1000000.20"), d("9999.00"), d("1000000.20"), None]
    got2 = [r[0] for r in df.select(L.final_loan_amount(*cols, cut=False)).collect()]
    assert got2[2] == d("1000000.25")


def test_code_lookup(spark):
    got = one(spark, "c int", [(1,), (2,), (9,)], L.code_lookup("c", ((1, "A"), (2, "B'x"))),
              L.code_lookup(F.col("c"), ((1, "A"), (2, "B'x"))))
    assert got == [("A", "A"), ("B'x", "B'x"), (None, None)]


def test_bad_numbers_never_raise(spark):
    rows = [("NaN",), ("Infinity",), ("1" * 30,), ("99999999999",), ("123.0",), (" 7 ",), ("",), (None,)]
    got = one(spark, "s string", rows, L.canonical_id_numeric("s"), L.int_fill("s"), L.int_strict("s"),
              L.canonical_id(L.canonical_id_numeric("s")))
    assert got == [(None, 0, None, None), (None, 0, None, None), (None, 0, None, None),
                   (99999999999, 0, None, "99999999999"), (123, 123, 123, "000000123"), (7, 7, 7, "000000007"),
                   (None, 0, None, None), (None, 0, None, None)]


def test_dates_do_not_depend_on_the_zone(spark):
    import datetime as dt
    rows = [("3/12/2017 2:30",), ("2017-03-12T02:30:00",), ("13/1/2017",), ("2/30/2017",), ("3/12/2017 25:00",)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r[0] for r in one(spark, "s string", rows, L.parse_dates("s").cast("string"))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2017-03-12 02:30:00", "2017-03-12 02:30:00", None, None, None]
    assert dt.datetime.fromisoformat(got[0]) == dt.datetime(2017, 3, 12, 2, 30)
