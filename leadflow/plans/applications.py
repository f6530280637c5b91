"""Application snapshot: the servicing query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow import rules as R
from leadflow.functions import (canonical_id, final_loan_amount, parse_dates,
                                score_parse, text_coercion, to_decimal,
                                to_double)
from leadflow.operators import (blank_key, coalesced_key_join, broadcast_small,
                                earliest_balance, history_pivot,
                                left_join_left_pred, semi_join, stage,
                                status_codes, text_key)
from leadflow.sources.files import read_delimited
from leadflow.sources.servicing import Servicing

SNAPSHOT_COLUMNS = (
    "firstname", "lastname", "task_refno", "LoanNumber", "StatusCodes",
    "TaskStatus", "LoanStatus", "WasCreditReportPulled", "FundedDate",
    "CreditScore", "FinalLoanAmount", "ApplicationEnterDate", "FinalTerm",
    "InterestRate", "FinalAPR", "LastAction", "LastResult", "AmountRequested",
    "SmallApprovedAmount", "LargeApprovedAmount", "SmallAPR", "LargeAPR",
    "SmallTerm", "LargeTerm", "Cifno", "ReasonDeclined", "FreeIncome",
    "MonthlyGrossIncome", "MonthlyNetIncome", "CustomerType", "SSNo", "ssn",
    "lead_app")


# Loan-side columns that an application row is made of.
LOAN_COLUMNS = ("loan_group_no", "ls_status_code", "statflags", "netbalance", "interest_method",
                "original_note_amount", "addonint_total", "ld_userdef11")


def borrowers_for(srv: Servicing, persons: DataFrame | None) -> DataFrame:
    """Borrower map rows whose canonical person key is among the leads."""
    b = srv.borrower.withColumn("ssn", canonical_id("SSNo"))
    return b if persons is None else semi_join(b, persons.select("ssn"), "ssn")


def application_tasks(srv: Servicing, borrowers: DataFrame) -> DataFrame:
    """Customer -> link -> task -> task detail (C2, C3, C5), one row per
    (borrower, task); lead keys are pushed in before any lookup runs."""
    c = srv.cif.join(borrowers.select("SSNo", "ssn", F.col("Cifno").alias("b_cifno")),
                     F.col("cifno") == F.col("b_cifno"), "inner").drop("b_cifno")
    links = srv.tmr.filter(F.col("tmr_code_id") == 1)
    ta = (c.join(links, F.col("cifno") == F.col("child_refno"), "inner")
           .join(srv.task, F.col("parent_refno") == F.col("task_refno"), "inner")
           .drop("child_refno", "parent_refno")
           .join(broadcast_small(srv.task_status_codes).withColumnRenamed("status_code", "TaskStatus"),
                 "status_code_id", "inner"))
    # Only details of candidate tasks can match; the semi-join is pushed
    # below the detail projection, so its text fields are derived for those
    # rows only.  The left join keeps C5's semantics.
    td = (semi_join(srv.task_detail, ta.select("task_refno"), "task_refno")
          .withColumnRenamed("task_refno", "td_task_refno")
          .withColumnRenamed("userdef05", "td_userdef05"))
    return left_join_left_pred(ta, td, F.col("task_refno") == F.col("td_task_refno"),
                               F.col("task_template_no") == 1)


def candidate_loans(srv: Servicing, tasks: DataFrame) -> DataFrame:
    """Loan accounts some candidate task can match (C7): the task's loan
    number, or any loan whose number is missing/'' (those match every task
    without a loan number).  One semi-join on the coalesced number."""
    keys = tasks.select(blank_key(F.col("userdef100")).alias("_k")).distinct()
    return srv.loanacct.join(keys, blank_key(F.col("loan_number")) == F.col("_k"), "left_semi")


def loan_rows(srv: Servicing, loans: DataFrame) -> DataFrame:
    """Loan-side columns keyed by loan number.

    ``loans`` is the staged candidate set; each big loan table is scanned
    once and filtered by it before any aggregation or join.
    """
    accounts = loans.select("acctrefno")
    st = status_codes(semi_join(srv.loanacct_statuses, accounts, "acctrefno"), srv.loan_status_codes)
    numbers = loans.select(text_key(F.col("loan_number")).alias("_number"))
    bal = earliest_balance(srv.aged_balance.join(
        numbers, text_key(F.col("loannumber")) == F.col("_number"), "left_semi"))
    detail = semi_join(srv.loanacct_detail, accounts, "acctrefno").withColumnRenamed("userdef11", "ld_userdef11")
    return (loans.join(detail, "acctrefno", "left")
            .join(semi_join(srv.loanacct_setup, accounts, "acctrefno"), "acctrefno", "left")
            .join(st, "acctrefno", "left")
            .join(bal, text_key(F.col("loan_number")) == F.col("loannumber"), "left")
            .join(broadcast_small(srv.loan_status_codes).withColumnRenamed("status_code", "ls_status_code"),
                  "status_code_no", "left")
            .select("loan_number", *LOAN_COLUMNS))


def application_snapshot(srv: Servicing, persons: DataFrame | None = None,
                         mode: str = "faithful", distinct: bool = True) -> DataFrame:
    """Every application row of the lead persons (before per-person dedupe).

    ``persons`` (column ``ssn``) restricts the whole query to the leads'
    people up front; the reference ran the query for everyone and filtered
    in the later merge - the result is the same.  ``distinct=False`` skips
    the final whole-row DISTINCT for consumers that pick one row per person
    by a total order (identical rows cannot change that pick).  The candidate tasks and
    their loans are staged once (small, shared by several scans); every big
    servicing table is then read once and filtered by them.
    """
    intended = mode == "intended"
    borrowers = borrowers_for(srv, persons)
    tasks = stage(application_tasks(srv, borrowers).filter(
        blank_key(F.col("userdef100")) != R.LOAN_NUMBER_CLOSED_BRANCH), "tasks", srv.scope)
    loans = stage(candidate_loans(srv, tasks), "loans", srv.scope)

    # All history lookups in one pass, only for the candidate tasks.
    hist = semi_join(srv.task_routing_history, tasks.select("task_refno"), "task_refno")
    hp = history_pivot(hist, srv.workflow_action, srv.workflow_result, last_by_time=intended)
    # C11: an application needs an application-entered date; this makes the
    # task-detail join effectively inner (the lookups key on its task).
    hp = hp.filter(F.col("ApplicationEnterDate").isNotNull())
    rows = tasks.join(hp, F.col("td_task_refno") == hp["task_refno"], "inner").drop(hp["task_refno"])

    detail = semi_join(srv.cif_detail, tasks.select("cifno"), "cifno").withColumnRenamed("cifno", "h_cifno")
    rows = rows.join(detail, F.col("cifno") == F.col("h_cifno"), "left")

    # set semantics (a DISTINCT or a total-order pick follows): blank loans
    # are paired as their distinct rows
    rows = coalesced_key_join(rows, loan_rows(srv, loans), "userdef100", "loan_number", "left",
                              needed=LOAN_COLUMNS, scope=srv.scope)
    rows = rows.filter(F.coalesce(F.col("loan_group_no"), F.lit(R.DEFAULT_LOAN_GROUP))
                       != R.EXCLUDED_LOAN_GROUP)
    rows = rows.withColumn("_type", F.explode_outer("_types"))

    amount = final_loan_amount(F.col("netbalance"), F.col("userdef100"),
                               F.col("interest_method"), F.col("original_note_amount"),
                               F.col("addonint_total"), F.col("ld_userdef11"),
                               cut=not intended)
    snap = rows.select(
        F.col("firstname1").alias("firstname"),
        F.col("lastname1").alias("lastname"),
        F.col("task_refno"),
        F.col("userdef100").alias("LoanNumber"),
        F.col("statflags").alias("StatusCodes"),
        F.col("TaskStatus"),
        F.when(F.col("userdef100").isNotNull(), F.col("ls_status_code")).alias("LoanStatus"),
        F.col("WasCreditReportPulled"),
        F.col("FundedDate"),
        score_parse(F.col("userdef05")).alias("CreditScore"),
        amount.alias("FinalLoanAmount"),
        F.col("ApplicationEnterDate"),
        to_decimal("userdef54", 18, 0).alias("FinalTerm"),
        to_double("userdef55").alias("InterestRate"),
        to_double("userdef57").alias("FinalAPR"),
        F.col("LastAction"),
        F.col("LastResult"),
        to_decimal("userdef34").alias("AmountRequested"),
        to_decimal("userdef10").alias("SmallApprovedAmount"),
        to_decimal("userdef19").alias("LargeApprovedAmount"),
        to_double("userdef14").alias("SmallAPR"),
        to_double("userdef21").alias("LargeAPR"),
        to_double("userdef12").alias("SmallTerm"),
        to_double("userdef20").alias("LargeTerm"),
        F.col("cifno").alias("Cifno"),
        F.col("userdef11").alias("ReasonDeclined"),
        to_decimal("userdef07").alias("FreeIncome"),
        to_decimal("userdef04").alias("MonthlyGrossIncome"),
        to_decimal("td_userdef05").alias("MonthlyNetIncome"),
        F.col("_type.t").alias("CustomerType"),
        F.col("SSNo").try_cast("bigint").alias("SSNo"),
        F.col("ssn"),
        F.lit("app").alias("lead_app"),
    )
    return snap.distinct() if distinct else snap


def app_workbook(snapshot: DataFrame, rules: R.FunnelRules) -> DataFrame:
    """The apps table as a weekly program reads it (hand-off, B3/B10).

    Missing text is spelled the way the file it reads spells it
    (``rules.null_text``: 'NULL' in the database export, 'None' in the
    daily snapshot); a missing decline reason reads as ``rules.not_declined``;
    the funded date arrives as MM/DD/YYYY text where ``funded_date_text``.
    """
    nt = rules.null_text
    s = snapshot
    out = s.select(
        *[c for c in s.columns if c not in ("LoanNumber", "ReasonDeclined", "FundedDate", "TaskStatus")],
        text_coercion("LoanNumber", nt).alias("LoanNumber"),
        text_coercion("TaskStatus", nt).alias("TaskStatus"),
        F.coalesce(F.col("ReasonDeclined"), F.lit(rules.not_declined)).alias("ReasonDeclined"),
        (F.coalesce(F.date_format("FundedDate", "MM/dd/yyyy"), F.lit(nt))
         if rules.funded_date_text else F.col("FundedDate")).alias("FundedDate"),
    )
    return out


# Types of the apps table's columns; the others are text.
_APP_TYPES = {
    "decimal(18,2)": ("FinalLoanAmount", "AmountRequested", "SmallApprovedAmount", "LargeApprovedAmount",
                      "FreeIncome", "MonthlyGrossIncome", "MonthlyNetIncome"),
    "decimal(18,0)": ("FinalTerm",),
    "double": ("InterestRate", "FinalAPR", "SmallAPR", "LargeAPR", "SmallTerm", "LargeTerm"),
    "bigint": ("task_refno", "Cifno", "SSNo"), "int": ("CreditScore",)}


def read_apps_file(spark: SparkSession, paths, rules: R.FunnelRules) -> DataFrame:
    """A5: apps table of exported files (CSV with a header, any column order).

    Numbers that are none, the word for missing included, are missing;
    ``ApplicationEnterDate`` is a date in MM/DD/YYYY or ISO form; missing
    text keeps the file's spelling, and an empty one takes the profile's
    word for missing.  Columns the file lacks are missing."""
    files = read_delimited(spark, paths)
    have = {c.lower(): c for c in files.columns}
    kind = {c: t for t, cs in _APP_TYPES.items() for c in cs}
    dates = ("MM/dd/yyyy", "M/d/yyyy", "yyyy-MM-dd")

    def column(name: str):
        src = F.col(f"`{have[name.lower()]}`") if name.lower() in have else F.lit(None).cast("string")
        if name in kind:
            return F.trim(src).try_cast(kind[name])
        if name == "ApplicationEnterDate" or (name == "FundedDate" and not rules.funded_date_text):
            return F.to_date(parse_dates(src, dates))
        if name in ("LoanNumber", "TaskStatus", "FundedDate"):
            return F.coalesce(src, F.lit(rules.null_text))
        return F.coalesce(src, F.lit(rules.not_declined)) if name == "ReasonDeclined" else src

    return files.select(*[column(c).alias(c) for c in SNAPSHOT_COLUMNS])
