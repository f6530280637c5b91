"""Per-task and per-loan lookups computed in one pass each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow import rules as R
from leadflow.functions import customer_type
from leadflow.operators.keys import broadcast_small, text_key


def history_pivot(history: DataFrame, actions: DataFrame, results: DataFrame,
                  last_by_time: bool = False) -> DataFrame:
    """Every correlated history lookup of a task in one aggregation.

    Replaces five correlated reads of the history table (credit pulled?,
    latest funded date, earliest application date, "last" action, customer
    types) by one ``groupBy(task_refno)`` with partial aggregation.  The
    action/result code tables are left-joined by broadcast while they are
    small (``broadcast_small``), so the history is not shuffled by a code.  Texts
    are compared without their trailing blanks.

    * ``WasCreditReportPulled``: 'Yes' if a PULL CREDIT REPORT row has result
      'yes', else 'No' (C8).
    * ``FundedDate``: date of the latest BOOK LOAN / yes row (C9).
    * ``ApplicationEnterDate``: date of the earliest ENTER APPLICATION DATA
      row; a row with no time sorts first in the reference, so any such row
      makes the result null (C10).
    * ``LastAction``/``LastResult``: top row by action text descending - the
      alphabetically last action, as written (C12); ties on the action take
      the greatest result.  ``last_by_time`` picks the latest row instead.
    * ``_types``: distinct customer types of the BOOK LOAN rows (C6), as an
      array of one-field structs so an unmapped (null) type survives.
    """
    h = (history.join(broadcast_small(actions), "workflow_action_id", "left")
         .join(broadcast_small(results), "workflow_result_id", "left"))
    action, result, created = text_key(F.col("action")), text_key(F.col("result")), F.col("created_date")
    is_enter = action == R.ACTION_ENTER_APPLICATION
    booked = (action == R.ACTION_BOOK_LOAN) & (result == R.RESULT_YES)
    pulled = (action == R.ACTION_PULL_CREDIT) & (result == R.RESULT_YES)
    if last_by_time:
        last = F.max_by(F.struct(action.alias("a"), result.alias("r")),
                        F.struct(created, action, result))
    else:
        last = F.max(F.struct(action.alias("a"), result.alias("r")))
    typed = F.when(F.col("workflow_action_id") == R.CUSTOMER_TYPE_ACTION_ID,
                   F.struct(customer_type(F.col("workflow_result_id")).alias("t")))
    out = h.groupBy("task_refno").agg(
        F.max(pulled.cast("int")).alias("_pulled"),
        F.max(F.when(booked, F.to_date(created))).alias("FundedDate"),
        F.min(F.when(is_enter, F.to_date(created))).alias("_enter"),
        F.max((is_enter & created.isNull()).cast("int")).alias("_enter_null"),
        last.alias("_last"),
        F.collect_set(typed).alias("_types"))
    return out.select(
        "task_refno",
        F.when(F.col("_pulled") == 1, F.lit("Yes")).otherwise(F.lit("No")).alias("WasCreditReportPulled"),
        "FundedDate",
        F.when(F.col("_enter_null") == 1, F.lit(None).cast("date"))
         .otherwise(F.col("_enter")).alias("ApplicationEnterDate"),
        F.col("_last.a").alias("LastAction"),
        F.col("_last.r").alias("LastResult"),
        "_types")


def status_codes(statuses: DataFrame, codes: DataFrame,
                 accounts: DataFrame | None = None) -> DataFrame:
    """Comma-joined status codes per loan, blanks dropped, duplicates kept.

    The reference's order is undefined; ours is ascending.  ``accounts``
    (optional) keeps only loans present there (the reference's inner join
    with the loan table); when the result is only ever left-joined back to
    that table the restriction is implied and can be skipped.
    """
    s = statuses.join(broadcast_small(codes), "status_code_no", "inner")
    s = s.filter(F.col("status_code").isNotNull() & (text_key(F.col("status_code")) != ""))
    if accounts is not None:
        s = s.join(accounts.select("acctrefno"), "acctrefno", "left_semi")
    return s.groupBy("acctrefno").agg(
        F.array_join(F.array_sort(F.collect_list("status_code")), ",").alias("statflags"))


def earliest_balance(balances: DataFrame) -> DataFrame:
    """Balance of the earliest run date per loan number (numbers that
    differ in trailing blanks are one, shown without them).

    The reference sorts ascending with nulls first, so a row with no run
    date wins; equal dates take the smaller balance (our tiebreak).
    """
    key = F.struct(F.col("rundate").isNotNull(), F.col("rundate"), F.col("netbalance"))
    return balances.groupBy(text_key(F.col("loannumber")).alias("loannumber")).agg(
        F.min_by("netbalance", key).alias("netbalance"))
