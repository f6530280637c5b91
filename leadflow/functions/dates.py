"""B4 with the format left open: what a date column's texts themselves say.

Most ways to write a date can be read in one way only (year first, or a month
by its name).  Numbers with the year last can be month first or day first;
``date_evidence`` counts, in one aggregate over all columns, the rows that
decide it, for each column and separator apart, and ``guess_dates`` turns the
counts into a reading.  The rows are then parsed once, by one expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.functions.scalars import col_

SEPARATORS = ("/", "-", ".")
_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
           "november", "december")
_NAME = r"([a-z]{3})(?:" + "|".join(f"(?<={m[:3]}){m[3:]}" for m in _MONTHS if len(m) > 3) + ")?"
_TIME = r"(?:t| +)(\d{1,2})(:\d{2}(?::\d{2}(?:\.\d+)?)?) *(?:([ap])\.?m\.?)?$"
_YEAR_LAST = r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4}|\d{2})"
# ways to write a date that can be read in one way only, and that way as year-month-day
_PLAIN = ((r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})$", "$1-$3-$4"),
          (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
          (rf"^(\d{{1,2}})[ -]{_NAME}\.?,?[ -](\d{{4}}|\d{{2}})$", "$3-$2-$1"),
          (rf"^{_NAME}\.? +(\d{{1,2}}),? +(\d{{4}})$", "$3-$1-$2"),
          # two digits of a year: 69 to 99 are the last century's, 00 to 68 this one's
          (r"^(69|[7-9]\d)-", "19$1-"), (r"^(\d{2})-", "20$1-"))


def _text(c) -> Column:
    """Lower case without blanks around; an empty text is missing."""
    return F.nullif(F.lower(F.trim(col_(c).cast("string"))), F.lit(""))


def _stamp(s: Column, day_first: Column) -> Column:
    """``s`` as timestamp_ntz if it is a date and an optional time of day,
    else null.  Its parts are put in order and cast once; what is no date
    keeps its shape and fails the cast."""
    order = F.when(day_first, "$4-$3-$1").otherwise("$4-$1-$3")
    date = F.regexp_replace(F.regexp_replace(s, _TIME, ""), F.lit(_YEAR_LAST + "$"), order)
    for pattern, iso in _PLAIN:
        date = F.regexp_replace(date, pattern, iso)
    name = F.regexp_extract(s, r"(?:^|[ -])([a-z]{3})[a-z]*\.?,?[ -]", 1)
    month = F.floor((F.instr(F.lit("".join(f" {m[:3]}" for m in _MONTHS)), F.concat(F.lit(" "), name)) + 3) / 4)
    date = F.regexp_replace(date, F.lit("-[a-z]{3}-"), F.concat(F.lit("-"), month.cast("string"), F.lit("-")))
    hour, rest, half = (F.regexp_extract(s, _TIME, i) for i in (1, 2, 3))
    h = hour.try_cast("int")
    h = F.when(half == "", h).when(h.between(1, 12), h % 12 + F.when(half == "p", 12).otherwise(0))
    time = F.when(hour == "", F.lit(" 00:00:00")).otherwise(F.concat(F.lit(" "), h.cast("string"), rest))
    return F.concat(date, time).try_cast("timestamp_ntz")


def read_dates(c, day_first: Sequence[str] = ()) -> Column:
    """Text -> timestamp_ntz.  Numbers with the year last are read month
    first, or day first after the separators named; a text that is no date
    that way is read the other way.  Missing, empty and unreadable: null."""
    s = _text(c)
    first, second = (F.regexp_extract(s, _YEAR_LAST, i).try_cast("int") for i in (1, 3))
    # twelve and less is a date either way, more is no month
    other = first > 12
    if day_first:
        swap = F.regexp_extract(s, _YEAR_LAST, 2).isin(*day_first)
        other = F.when(swap, second <= 12).otherwise(other)
    return _stamp(s, other)


def date_evidence(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column and separator (three rows a column):

        n_text          rows with a text that is not empty (of the column)
        n_unparsed      of them, no date in any way (of the column)
        n_month_first   year last, a date month first only
        n_day_first     year last, a date day first only
        n_same          both, and the same date
        n_open          both, and different dates
        day_first       read day first: more rows are so only than month first only
        mixed           there are rows of either kind
        ambiguous       rows are open and nothing decides: as many of either kind

    One pass and one aggregate over ``df``, three rows a column whatever its
    size; empty ``df``: no rows."""
    text, sep, m, d = (F.col(c) for c in ("_text", "_sep", "_m", "_d"))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), _text(c).alias("_text")) for c in columns])
    read = df.select(F.inline(cells)).select(
        "column", "_text", F.regexp_extract(text, _YEAR_LAST, 2).alias("_sep"),
        _stamp(text, F.lit(False)).alias("_m"), _stamp(text, F.lit(True)).alias("_d"))
    kinds = {"n_month_first": m.isNotNull() & d.isNull(), "n_day_first": m.isNull() & d.isNotNull(),
             "n_same": m == d, "n_open": m != d}
    counts = read.groupBy("column").agg(
        F.count("_text").alias("n_text"), F.count_if(text.isNotNull() & m.isNull() & d.isNull()).alias("n_unparsed"),
        *[F.count_if((sep == mark) & kind).alias(f"{name}{k}") for k, mark in enumerate(SEPARATORS)
          for name, kind in kinds.items()])
    rows = F.array(*[F.struct(F.lit(mark).alias("separator"), *[F.col(f"{name}{k}").alias(name) for name in kinds])
                     for k, mark in enumerate(SEPARATORS)])
    m, d = F.col("n_month_first"), F.col("n_day_first")
    return (counts.select("column", "n_text", "n_unparsed", F.inline(rows))
            .withColumn("day_first", d > m).withColumn("mixed", (d > 0) & (m > 0))
            .withColumn("ambiguous", (F.col("n_open") > 0) & (d == m)))


@dataclass(frozen=True)
class DateGuess:
    """How one column is read: the separators after which numbers are day
    first, and those whose open rows nothing decides (read month first)."""

    column: str
    day_first: tuple[str, ...]
    ambiguous: tuple[str, ...]
    n_unparsed: int

    def parse(self) -> Column:
        return read_dates(self.column, self.day_first)


def guess_dates(df: DataFrame, columns: Sequence[str]) -> dict[str, DateGuess]:
    """A guess per column from all rows of ``df``.  The driver receives three
    rows a column."""
    rows = date_evidence(df, columns).collect()
    return {c: DateGuess(c, tuple(r.separator for r in rows if r.column == c and r.day_first),
                         tuple(r.separator for r in rows if r.column == c and r.ambiguous),
                         next((r.n_unparsed for r in rows if r.column == c), 0)) for c in columns}
