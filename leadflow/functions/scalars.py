"""Pure Column expressions for the scalar operators.

Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen; nothing calls back into Python per row.  ANSI mode is
on in Spark 4, so every text boundary goes through ``try_cast`` /
``try_to_timestamp``: a bad value becomes null instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadflow import rules as R

__all__ = [
    "col_", "canonical_id", "canonical_id_numeric", "text_coercion",
    "sentinel_to_null", "parse_dates", "int_fill", "int_strict",
    "to_double", "to_decimal", "score_parse", "amount_text_cut",
    "final_loan_amount", "customer_type", "row_max", "fallback_offer",
    "cost_tier", "sas_text", "DATE_FORMATS", "cents", "money",
    "money_text", "code_lookup",
]


def col_(c: Column | str) -> Column:
    """Accept a column name (backticks added for dotted names) or a Column."""
    if isinstance(c, Column):
        return c
    return F.col(f"`{c}`") if ("." in c or "/" in c or " " in c) else F.col(c)


def canonical_id(c, width: int = R.PERSON_KEY_WIDTH,
                 null_as: str | None = None) -> Column:
    """B2: text person key left-padded with '0' to ``width``.

    Longer text is kept whole (plain ``lpad`` would cut it).  A null key
    stays null unless ``null_as`` asks for the reference's text rendering
    (``'nan'`` gives ``'000000nan'``).
    """
    s = col_(c).cast("string")
    if null_as is not None:
        s = F.coalesce(s, F.lit(null_as))
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def canonical_id_numeric(c) -> Column:
    """B2n: numeric person key (text * 1); bad text, NaN, infinity and
    numbers beyond a long become null."""
    return F.trim(col_(c).cast("string")).try_cast("double").try_cast("bigint")


def text_coercion(c, null_text: str | None = None) -> Column:
    """Cast to text; optionally spell missing as ``null_text``."""
    s = col_(c).cast("string")
    return s if null_text is None else F.coalesce(s, F.lit(null_text))


def sentinel_to_null(c, sentinels: Iterable[str] = ("None",),
                     trim: bool = True, case_insensitive: bool = False) -> Column:
    """Sentinel text (e.g. 'None', 'NULL', 'nan') becomes null."""
    s = col_(c)
    probe = F.trim(s) if trim else s
    vals = list(sentinels)
    if case_insensitive:
        probe = F.upper(probe)
        vals = [v.upper() for v in vals]
    return F.when(probe.isin(vals), F.lit(None).cast("string")).otherwise(s)


# Named formats tried in order (B4); the first that parses wins.
DATE_FORMATS = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy",
                "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss",
                "yyyy-MM-dd HH:mm", "yyyy-MM-dd")


def parse_dates(c, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text -> timestamp_ntz by a named list of formats.

    The text is rewritten as an ISO date and time by its format's fields and
    cast without a zone, so the session's time zone, and the hours that it
    skips, play no part."""
    if isinstance(c, str):
        c = col_(c)
    s = F.trim(c.cast("string"))
    return F.coalesce(*[_parse_ntz(s, f) for f in formats])


# Fields of the formats as digit patterns, and how each is written in ISO.
_FIELDS = {"yyyy": r"(\d{4})", "MM": r"(\d{2})", "dd": r"(\d{2})", "HH": r"(\d{2})", "mm": r"(\d{2})",
           "ss": r"(\d{2})", "M": r"(\d{1,2})", "d": r"(\d{1,2})", "H": r"(\d{1,2})"}


def _parse_ntz(s: Column, fmt: str) -> Column:
    """``s`` as timestamp_ntz if it has exactly the format ``fmt``, else null."""
    import re
    order, pattern = [], ""
    for part in re.findall(r"yyyy|MM|dd|HH|mm|ss|M|d|H|'[^']*'|.", fmt):
        if part in _FIELDS:
            order.append(part[0])
            pattern += _FIELDS[part]
        else:
            pattern += re.escape(part.strip("'"))
    at = {f: F.lpad(F.regexp_extract(s, f"^{pattern}$", i + 1), 2 if f != "y" else 4, "0") for i, f in enumerate(order)}
    clock = [at.get(f, F.lit("00")) for f in "Hms"]
    iso = F.concat(at["y"], F.lit("-"), at["M"], F.lit("-"), at["d"], F.lit(" "), F.concat_ws(":", *clock))
    return F.when(s.rlike(f"^{pattern}$"), iso.try_cast("timestamp_ntz"))


def to_double(c) -> Column:
    return col_(c).try_cast("double")


def to_decimal(c, precision: int = 18, scale: int = 2) -> Column:
    """text/number -> decimal(p,s), rounding half-up; bad text -> null."""
    return F.trim(col_(c).cast("string")).try_cast(f"decimal({precision},{scale})")


def int_fill(c) -> Column:
    """Null -> 0, then truncate toward zero."""
    return F.coalesce(to_double(c).try_cast("int"), F.lit(0))


def int_strict(c) -> Column:
    """Truncate toward zero; null, bad text and numbers beyond an int
    are null (``reject_reasons`` lists them)."""
    return to_double(c).try_cast("int")


def score_parse(c) -> Column:
    """Guarded bureau-score parse.

    null, shorter than 13 (trailing blanks ignored) or a blank followed by a
    letter -> 0; otherwise the 4 characters before the first '.' as int.
    """
    s = col_(c)
    bad = (s.isNull() | (F.length(F.rtrim(s)) < R.SCORE_MIN_LENGTH)
           | s.rlike("(?i) [a-z]"))
    digits = F.right(F.substring_index(s, ".", 1), F.lit(R.SCORE_DIGITS)).try_cast("int")
    has_dot = F.instr(s, ".") > 0
    return F.when(bad, F.lit(0)).when(has_dot, digits)


def amount_text_cut(amount: Column, keep: int | None = R.AMOUNT_TEXT_KEEP_CHARS) -> Column:
    """Render a decimal as text and keep its first ``keep`` characters."""
    txt = amount.cast("string")
    return txt if keep is None else F.substring(txt, 1, keep)


def final_loan_amount(net_balance: Column, loan_number: Column,
                      interest_method: Column, note_amount: Column,
                      addon_total: Column, payoff_text: Column,
                      cut: bool = True) -> Column:
    """Earliest balance, else the loan amount by interest method."""
    method = (F.when(interest_method.isin(*R.INTEREST_METHODS_PRECOMPUTED), F.lit("P"))
              .when(interest_method == R.INTEREST_METHOD_SIMPLE, F.lit("I"))
              .otherwise(F.lit("0")))
    total = note_amount + F.coalesce(addon_total, F.lit(Decimal("0.00")))
    total_txt = amount_text_cut(total, R.AMOUNT_TEXT_KEEP_CHARS if cut else None)
    payoff = F.regexp_replace(payoff_text, ",", "")
    chosen = F.when(method == "I", total_txt).otherwise(F.coalesce(payoff, total_txt))
    amount = chosen.try_cast("decimal(18,2)")
    return F.coalesce(
        net_balance.cast("decimal(18,2)"),
        F.when(loan_number.isNull(), F.lit(Decimal("0.00")).cast("decimal(18,2)")).otherwise(amount))


def customer_type(result_id: Column) -> Column:
    """Workflow result id -> customer type (unmapped -> null)."""
    out = None
    for rid, name in R.CUSTOMER_TYPE_BY_RESULT_ID:
        out = F.when(result_id == rid, F.lit(name)) if out is None else out.when(result_id == rid, F.lit(name))
    return out


def code_lookup(c, pairs) -> Column:
    """Value of a small fixed code table (pairs of code, text) as a CASE
    expression: a projection instead of a join, so no exchange at all.
    Unknown codes give null (a left join's miss)."""
    if isinstance(c, str):
        arms = " ".join(f"WHEN {_sql_lit(code)} THEN {_sql_lit(text)}" for code, text in pairs)
        return F.expr(f"CASE `{c}` {arms} END")
    c = col_(c)
    out = None
    for code, text in pairs:
        out = F.when(c == code, F.lit(text)) if out is None else out.when(c == code, F.lit(text))
    return out


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def row_max(*cols) -> Column:
    """Row-wise max ignoring nulls; all null -> null."""
    return F.greatest(*[col_(c) for c in cols])


def fallback_offer(large, small, large_null_falls_back: bool) -> Column:
    """Large offer when > 0, else the small one.

    daily: a missing large offer leaves the result unset (null);
    weekly: missing is not > 0, so the small offer is used.
    """
    large, small = col_(large), col_(small)
    if large_null_falls_back:
        return F.when(large > 0, large).otherwise(small)
    return F.when(large > 0, large).when(large <= 0, small)


def cost_tier(amount, negative_cost: int = R.COST_LOW) -> Column:
    """Funded amount -> lead cost (0 / 125 / 200, break at 2,500).

    null or 0 -> 0; daily charges ``negative_cost`` (125) for a negative
    amount, weekly charges 0 (``0 < x <= 2500``).
    """
    a = col_(amount)
    return (F.when(a.isNull() | (a == 0), F.lit(0))
            .when(a > R.COST_BREAK, F.lit(R.COST_HIGH))
            .when(a > 0, F.lit(R.COST_LOW))
            .otherwise(F.lit(negative_cost)))


def sas_text(c) -> Column:
    """SAS compares text ignoring trailing blanks; missing text is ''."""
    return F.coalesce(F.rtrim(col_(c)), F.lit(""))


def cents(c) -> Column:
    """Exact integer cents of a 2-decimal double (both engines agree)."""
    return F.round(col_(c) * 100).cast("bigint")


def money(cents_col: Column) -> Column:
    """Integer cents -> decimal(18,2), exact."""
    return (cents_col.cast("decimal(18,2)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def money_text(cents_col: Column) -> Column:
    """Integer cents -> 'units.cc' text, exact."""
    return F.concat((cents_col / 100).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((cents_col % 100).cast("string"), 2, "0"))
