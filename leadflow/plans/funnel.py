"""Funnel derivation per profile (B16-B24, C16, C17, E3, E4, E6; SURVEY 2.8).

Each reference program assigns the flags with an ordered list of masked
writes; here each flag is the closed form of that list, one expression per
column, so the whole funnel is a single projection after the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow import rules as R
from leadflow.functions import (canonical_id, cost_tier, fallback_offer,
                                parse_dates, row_max, sas_text,
                                sentinel_to_null)
from leadflow.operators import best_per_key, match_merge, sticky_flag
from leadflow.plans.applications import app_workbook



def _zero2() -> Column:
    return F.lit(Decimal("0.00")).cast("decimal(18,2)")


def _zero0() -> Column:
    return F.lit(Decimal("0")).cast("decimal(18,0)")


APP_ORDER_COLS = ("ApplicationEnterDate", "task_refno", "CustomerType", "LoanStatus",
                  "StatusCodes", "FinalLoanAmount", "SSNo")


def app_order(desc: bool) -> list[Column]:
    """Total order of one person's application rows: by application date and
    task number, then the columns a fanned-out task row can differ in."""
    d = "desc_nulls_last" if desc else "asc_nulls_first"
    first = [getattr(F.col(c), d)() for c in APP_ORDER_COLS[:2]]
    rest = [F.col(c).asc_nulls_first() for c in APP_ORDER_COLS[2:]]
    return first + rest


def latest_apps(snapshot: DataFrame) -> DataFrame:
    """Latest application per person (ties: highest task number)."""
    return best_per_key(snapshot, ["ssn"], app_order(desc=True))


def _flag(c: Column) -> Column:
    return F.when(c, F.lit(1)).otherwise(F.lit(0))


def funnel_daily(best_leads: DataFrame, snapshot: DataFrame,
                 mode: str = "faithful", keep: Sequence[str] = ()) -> DataFrame:
    """``daily`` profile: one row per lead person (C16 + closed-form flags).
    ``keep``: further columns of the leads that stay with their rows."""
    intended = mode == "intended"
    apps = latest_apps(snapshot).drop("lead_app")
    j = best_leads.join(apps, "ssn", "left")
    D, A = F.col("LEADDATE"), F.col("ApplicationEnterDate")
    before = (A < F.to_date(D)) if intended else (A < D)
    pre = F.coalesce(before, F.lit(False))
    live = A.isNotNull() & ~pre
    offer = F.coalesce(row_max("SmallApprovedAmount", "LargeApprovedAmount"), _zero2())
    amt_approved = F.when(pre, _zero2()).otherwise(offer)
    status = F.col("TaskStatus")
    declined = F.col("ReasonDeclined")
    loan_number = sentinel_to_null(F.col("LoanNumber"), ["None"], trim=False)
    approve = live & (F.coalesce(status.isin(*R.APPROVED_STATUSES), F.lit(False))
                      | ((amt_approved > 0) & declined.isNull()))
    funded = live & ((F.coalesce(status == R.STATUS_FUNDED, F.lit(False)))
                     | loan_number.isNotNull())
    appl = live
    prequal = F.coalesce(F.col("PQ_DECISION") == R.AUTO_APPROVED, F.lit(False)) | appl

    def approved_pick(large: str, small: str) -> Column:
        picked = fallback_offer(large, small, large_null_falls_back=False)
        if intended:
            return F.when(pre, F.lit(0.0)).otherwise(picked)
        return F.when(F.col(large).isNotNull(), picked).otherwise(F.when(pre, F.lit(0.0)))

    amount_funded = F.col("FinalLoanAmount")
    term_funded = F.when(funded, F.col("FinalTerm")).otherwise(_zero0())
    rate_funded = F.when(funded, F.col("FinalAPR")).otherwise(F.lit(0.0))
    if intended:
        amount_funded = F.when(pre, _zero2()).otherwise(amount_funded)
    out = j.select(
        "ssn", "CK_TRACKING_ID", "LEADDATE", "LEAD_SCORE", "PQ_DECISION",
        F.when(pre, F.lit(None).cast("date")).otherwise(A).alias("ApplicationEnterDate"),
        F.when(pre, F.lit(None).cast("date")).otherwise(F.col("FundedDate")).alias("FundedDate"),
        F.lit(1).alias("ISPQAPP"),
        _flag(prequal).alias("IS_PREQUAL"),
        _flag(appl).alias("IS_APPL"),
        _flag(approve).alias("IS_APPROVE"),
        _flag(funded).alias("IS_FUNDED"),
        F.col("AMT_APPLIED"),
        amt_approved.alias("AMT_APPROVED"),
        approved_pick("LargeTerm", "SmallTerm").alias("TERM_APPROVED"),
        approved_pick("LargeAPR", "SmallAPR").alias("RATE_APPROVED"),
        amount_funded.cast("decimal(18,2)").alias("AMOUNT_FUNDED"),
        term_funded.cast("decimal(18,0)").alias("TERM_FUNDED"),
        rate_funded.cast("double").alias("RATE_FUNDED"),
        F.lit(0).alias("APP_BEFORE_LEAD"),
        _flag(pre).alias("_pre"),
        *keep,
    )
    return out.withColumn("COST", cost_tier("AMOUNT_FUNDED", R.COST_LOW))


def weekly_apps(snapshot: DataFrame, rules: R.FunnelRules) -> DataFrame:
    """Apps table of a weekly profile: workbook rendering, person key,
    date floor (B20: a missing date is below the floor), funded date."""
    return weekly_apps_of(app_workbook(snapshot, rules), rules)


def weekly_apps_of(wb: DataFrame, rules: R.FunnelRules) -> DataFrame:
    """``weekly_apps`` of the apps table as the weekly program reads it: the
    rendered snapshot, or an apps file (``sources.files.read_apps_file``)."""
    if rules.person_key == "number":
        wb = wb.withColumn("ssn", F.col("SSNo"))
    else:
        wb = wb.withColumn("ssn", canonical_id(F.col("SSNo").cast("string")))
    if rules.app_date_floor is not None:
        wb = wb.filter(F.col("ApplicationEnterDate").isNotNull()
                       & (F.col("ApplicationEnterDate") >= F.lit(rules.app_date_floor)))
    if rules.funded_date_text:
        txt = sentinel_to_null(F.col("FundedDate"), [rules.null_text])
        wb = wb.withColumn("FundedDate", F.to_date(parse_dates(F.trim(txt), ("MM/dd/yyyy", "M/d/yyyy"))))
    return wb.drop("lead_app")


def weekly_flagged(best_leads: DataFrame, apps: DataFrame,
                   rules: R.FunnelRules) -> DataFrame:
    """weekly / weekly_v2: one row per (lead, app) with the DATA step's own
    flags and amounts (C17), before anything is carried over.  ``_pos`` is
    the row's place in its person's applications, ``_prequal`` whether the
    row itself sets the prequal flag."""
    m = match_merge(best_leads, apps, "ssn")
    D, A = F.col("LEADDATE"), F.col("ApplicationEnterDate")
    pre = (A.isNull() & D.isNotNull()) | F.coalesce(A < D, F.lit(False))
    status = sas_text("TaskStatus")
    offer = row_max("SmallApprovedAmount", "LargeApprovedAmount")
    ok = (status.isin(*R.APPROVED_STATUSES)
          | (F.coalesce(offer > 0, F.lit(False))
             & (sas_text("ReasonDeclined") == F.lit(rules.not_declined))))
    approve = ~pre & ok
    appl = ~pre & (F.coalesce(F.col("AmountRequested") > 0, F.lit(False)) | ok)
    raw_funded = (status == R.STATUS_FUNDED) | ~sas_text("LoanNumber").isin(*rules.loan_number_none)
    funded = ~pre & raw_funded

    def zero_if_pre(c: Column, zero) -> Column:
        return F.when(pre, zero).otherwise(c)

    rows = m.select(
        "*",
        _flag(pre).alias("APP_BEFORE_LEAD"),
        _flag(appl).alias("IS_APPL"),
        _flag(approve).alias("IS_APPROVE"),
        _flag(funded).alias("IS_FUNDED"),
    )
    amount_funded = zero_if_pre(F.col("FinalLoanAmount"), _zero2()).cast("decimal(18,2)")
    out = rows.select(
        "ssn", "CK_TRACKING_ID", "LEADDATE", "LEAD_SCORE", "PQ_DECISION",
        "task_refno", "CustomerType", "LoanStatus", "StatusCodes", "FinalLoanAmount", "SSNo",
        zero_if_pre(A, F.lit(None).cast("date")).alias("ApplicationEnterDate"),
        zero_if_pre(F.col("FundedDate"), F.lit(None).cast("date")).alias("FundedDate"),
        F.lit(1).alias("ISPQAPP"),
        "IS_APPL", "IS_APPROVE", "IS_FUNDED",
        F.col("AMT_APPLIED"),
        zero_if_pre(offer, _zero2()).cast("decimal(18,2)").alias("AMT_APPROVED"),
        zero_if_pre(fallback_offer("LargeTerm", "SmallTerm", True), F.lit(0.0)).alias("TERM_APPROVED"),
        zero_if_pre(fallback_offer("LargeAPR", "SmallAPR", True), F.lit(0.0)).alias("RATE_APPROVED"),
        amount_funded.alias("AMOUNT_FUNDED"),
        zero_if_pre(F.when(funded, F.col("FinalTerm")).otherwise(_zero0()), _zero0())
            .cast("decimal(18,0)").alias("TERM_FUNDED"),
        zero_if_pre(F.when(funded, F.col("FinalAPR")).otherwise(F.lit(0.0)), F.lit(0.0))
            .cast("double").alias("RATE_FUNDED"),
        "APP_BEFORE_LEAD",
        F.struct(*APP_ORDER_COLS).alias("_pos"),
        F.coalesce((F.col("LEAD_PREQUAL") == 1) | (F.col("IS_APPL") == 1), F.lit(False)).alias("_prequal"),
    ).withColumn("COST", cost_tier("AMOUNT_FUNDED", 0))
    return out


def weekly_rows(best_leads: DataFrame, apps: DataFrame,
                rules: R.FunnelRules) -> DataFrame:
    """``weekly_flagged`` with the prequal flag carried over to every later
    row of the person (E4)."""
    rows = weekly_flagged(best_leads, apps, rules)
    return sticky_flag(rows, ["ssn"], ["_pos"], F.col("_prequal"), "IS_PREQUAL").drop("_pos", "_prequal")


_DETAIL_COLUMNS = ("CustomerType", "LoanStatus", "StatusCodes", "FinalLoanAmount", "SSNo")


def best_outcome(rows: DataFrame, rules: R.FunnelRules) -> DataFrame:
    """One row per person - before-lead first (as written; 'intended'
    puts it last), then funded, then approved, then app order."""
    before = F.col("APP_BEFORE_LEAD").asc() if rules.mode == "intended" else F.col("APP_BEFORE_LEAD").desc()
    best = best_per_key(rows, ["ssn"], [before, F.col("IS_FUNDED").desc(),
                                        F.col("IS_APPROVE").desc(), *app_order(desc=False)])
    return best.drop(*_DETAIL_COLUMNS)


def funnel_weekly(best_leads: DataFrame, apps: DataFrame,
                  rules: R.FunnelRules) -> DataFrame:
    """weekly / weekly_v2: best outcome per person with the carried-over flag
    (E4 and E6) in one aggregation.

    Two minima per person: the best row, as a struct led by its rank, and the
    first place whose row sets the prequal flag; the best row has the flag
    if it is not before that place.  Both are partially aggregated below the
    one exchange, so no person's rows - the missing key's included - come
    together in one task."""
    rows = weekly_flagged(best_leads, apps, rules)
    before = F.col("APP_BEFORE_LEAD") if rules.mode == "intended" else -F.col("APP_BEFORE_LEAD")
    rank = [before.alias("_1"), (-F.col("IS_FUNDED")).alias("_2"), (-F.col("IS_APPROVE")).alias("_3"),
            F.struct(*APP_ORDER_COLS).alias("_4")]
    payload = [c for c in rows.columns if c not in ("ssn", "_prequal", *_DETAIL_COLUMNS)]
    per = rows.groupBy("ssn").agg(F.min(F.struct(*rank, *payload)).alias("w"),
                                  F.min(F.when(F.col("_prequal"), F.col("_pos"))).alias("first"))
    prequal = F.when(F.col("first").isNotNull() & (F.col("w._pos") >= F.col("first")), F.lit(1)).otherwise(F.lit(0))
    return per.select("ssn", *[F.col(f"w.{c}").alias(c) for c in payload if c != "_pos"],
                      prequal.alias("IS_PREQUAL"))
