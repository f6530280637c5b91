"""Registered queries: one per operator key of SURVEY section 2.

Each query takes (spark, sf_dir), reads the driver tables (or data Spark
derives from them: drop folders of lead files written from ``orders``) and
returns a DataFrame over the whole tables.  ``ORACLES`` holds the DuckDB
twin of each key (see ``leadflow.oracles``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow import rules as R
from leadflow.functions import (canonical_id, canonical_id_numeric, cents,
                                cost_tier, fallback_offer, int_fill,
                                int_strict, money, money_text, parse_dates,
                                row_max, score_parse, sentinel_to_null,
                                text_coercion, to_decimal, to_double)
from leadflow.functions.dates import date_evidence, guess_dates
from leadflow.operators import (coalesced_key_join, earliest_balance,
                                history_pivot, left_join_left_pred,
                                match_merge, stage, status_codes)
from leadflow.plans.applications import borrowers_for
from leadflow.plans.funnel import (best_outcome, funnel_daily, latest_apps,
                                   weekly_rows)
from leadflow.plans.leads import best_leads, partner_filter, typed_leads
from leadflow.plans.profile_run import Run
from leadflow.plans.sinks import feed_for_csv
from leadflow.plans.reports import (corrected_summary, daily_summary,
                                    daily_summary_total,
                                    funnel_frequency, funnel_gaps,
                                    partner_feed, summary_changes,
                                    weekly_summary)
from leadflow.session import scratch_path
from leadflow.sources import standins as S
from leadflow.sources.dropfolder import csv_line, write_batched_files
from leadflow.sources.files import (list_files, newest_and_oldest,
                                    normalise_headers, read_lead_files,
                                    read_lenient_csv, union_by_name)
from leadflow.sources.tables import Tables
from leadflow.streaming import BestLeads, ingest_lead_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def run(spark: SparkSession, d: str, profile: str = "daily", mode: str = "faithful") -> Run:
    """One profile's run over the stand-ins of ``d``; nothing is kept between
    queries, so a rewritten table is seen by the next one."""
    return Run(spark, d, profile, mode)


# --------------------------------------------------------------------------
# Sources (A1-A4, A10, A11)
# --------------------------------------------------------------------------
def lead_drop_folder(spark: SparkSession, d: str) -> str:
    """A partner drop folder: one lead file per month of ``orders``."""
    lines = Tables(spark, d).orders.select(F.trunc("o_orderdate", "month").alias("batch"),
                     csv_line(S.lead_file_columns()).alias("value"))
    folder = scratch_path(spark, "fixtures", "lead_drop", unique=True)
    return write_batched_files(lines, folder, ",".join(S.LEAD_FILE_HEADER))


@query("src_newest_oldest")
def q_src_newest_oldest(spark, d):
    folder = lead_drop_folder(spark, d)
    picked = newest_and_oldest(list_files(spark, folder))
    df = normalise_headers(read_lenient_csv(spark, picked, S.LEAD_FILE_HEADER))
    return df.select("irmpname", "applicant_ssn", "sub_id", "application_date",
                     "applicant_credit_score", "decision_status")


@query("src_lenient_csv")
def q_src_lenient_csv(spark, d):
    o = Tables(spark, d).orders
    p, s = F.col("o_totalprice"), F.col("o_orderstatus")
    base = list(S.LEAD_FILE_HEADER)
    exprs = dict(zip(base, S.lead_file_columns()))
    exprs["Loan Type"] = F.when((s == "F") & (p > 450000), F.lit('Personal\nLoan "Plus"')) \
        .when((s == "O") & (p > 450000), F.lit("Pr\u00eat personnel")) \
        .otherwise(F.lit("Personal")).alias("Loan Type")
    fields = [exprs[c] for c in base]
    line = (F.when((s == "P") & (p > 450000), F.concat(csv_line(fields), F.lit(',"surplus"')))
            .when((s == "P") & (p > 400000), F.concat(csv_line(fields), F.lit(",")))
            .when((s == "P") & (p > 350000), F.concat(csv_line(fields), F.lit(",,")))
            .when(p < 20000, csv_line(fields[:-2]))
            .otherwise(csv_line(fields)))
    folder = scratch_path(spark, "fixtures", "ragged_drop", unique=True)
    write_batched_files(o.select(F.trunc("o_orderdate", "month").alias("batch"), line.alias("value")),
                      folder, ",".join(S.LEAD_FILE_HEADER))
    df = normalise_headers(read_lenient_csv(spark, folder, S.LEAD_FILE_HEADER))
    return df.select("sub_id", "irmpname", "loan_type", "applicant_credit_score", "`amt._fin.`")


@query("union_by_name")
def q_union_by_name(spark, d):
    rows = normalise_headers(Tables(spark, d).orders.selectExpr(*S.lead_file_exprs()))
    a = rows.filter(F.col("decision_status") == "Auto Approved").select("sub_id", "applicant_ssn", "decision_status")
    b = rows.filter(F.col("decision_status") != "Auto Approved").select("decision_status", "sub_id")
    return union_by_name([a, b])


@query("normalise_headers")
def q_normalise_headers(spark, d):
    return normalise_headers(Tables(spark, d).orders.selectExpr(*S.lead_file_exprs()))


@query("ingest_stream")
def q_ingest_stream(spark, d):
    month = F.trunc("o_orderdate", "month")
    names, cols = list(S.LEAD_FILE_HEADER), S.lead_file_columns()
    folder = scratch_path(spark, "fixtures", "mixed_drop", unique=True)
    for odd, step in ((0, 1), (1, -1)):          # every other month has its columns the other way round
        lines = Tables(spark, d).orders.filter(F.month("o_orderdate") % 2 == odd).select(
            month.alias("batch"), csv_line(cols[::step]).alias("value"))
        write_batched_files(lines, folder, ",".join(names[::step]))
    work = scratch_path(spark, "stream", unique=True)
    hist = ingest_lead_files(spark, folder, f"{work}/history", f"{work}/checkpoint")
    return hist.select("irmpname", "applicant_ssn", "sub_id", "application_date")


def _lead_deliveries(spark, d, per_batch: int):
    """The lead rows as monthly files, taken in ``per_batch`` files at a time;
    the table of best leads after the last one."""
    lines = S.lead_orders(Tables(spark, d)).select(F.trunc("o_orderdate", "month").alias("batch"),
                                                   csv_line(S.lead_file_columns()).alias("value"))
    folder = scratch_path(spark, "fixtures", "lead_deliveries", unique=True)
    write_batched_files(lines, folder, ",".join(S.LEAD_FILE_HEADER))
    work = scratch_path(spark, "stream", unique=True)
    best = BestLeads(spark, f"{work}/best", R.PROFILES["daily"], buckets=8)
    ingest_lead_files(spark, folder, f"{work}/history", f"{work}/checkpoint", max_files_per_trigger=per_batch,
                      missing_text=R.PANDAS_MISSING_TEXT, on_batch=best.update)
    return best


@query("best_lead_incremental")
def q_best_lead_incremental(spark, d):
    return _lead_deliveries(spark, d, 17).read().select("ssn", "CK_TRACKING_ID", "LEADDATE", "LEAD_SCORE",
                                                        "AMT_APPLIED", "PQ_DECISION")


@query("daily_summary_corrected")
def q_daily_summary_corrected(spark, d):
    """D3 from signed changes: each delivery's replaced and new best leads
    against the same application rows, of all deliveries in one join a side."""
    best = _lead_deliveries(spark, d, 17)
    apps = stage(latest_apps(run(spark, d).snapshot_rows), "latest_apps")
    sides = zip(*[[side.withColumn("delivery", F.lit(batch)) for side in best.changes(batch)]
                  for batch in best.log.batches()])
    before, after = (funnel_daily(union_by_name(side), apps, keep=["delivery"]) for side in sides)
    return corrected_summary(summary_changes(before, after, by=["delivery"]))


@query("partner_filter")
def q_partner_filter(spark, d):
    raw = S.normalised_lead_rows(Tables(spark, d))
    return partner_filter(raw, S.PARTNER).select("irmpname", "sub_id", "applicant_ssn")


# --------------------------------------------------------------------------
# Scalars (B2-B27)
# --------------------------------------------------------------------------
def _edge_rows(spark, d):
    """Every order with a number as a careless file has it: one kind per
    residue of the order key."""
    k, c = F.col("o_orderkey") % 11, F.col("o_custkey").cast("string")
    texts = {0: F.lit("NaN"), 1: F.lit("Infinity"), 2: F.lit("123456789012345678901234567890"),
             3: F.concat(c, F.lit(".0")), 4: F.concat(F.lit("  "), c, F.lit(" ")), 5: F.lit(""),
             6: F.lit("99999999999"), 7: F.lit("-17.9"), 8: F.lit(None).cast("string"), 9: F.concat(c, F.lit("X"))}
    text = c
    for r, t in texts.items():
        text = F.when(k == r, t).otherwise(text)
    return Tables(spark, d).orders.select("o_orderkey", text.alias("edge_text"))


@query("canonical_id")
def q_canonical_id(spark, d):
    return _edge_rows(spark, d).select(
        "o_orderkey", F.col("edge_text").alias("key_text"), canonical_id("edge_text").alias("ssn"))


@query("canonical_id_numeric")
def q_canonical_id_numeric(spark, d):
    number = canonical_id_numeric("edge_text")
    return _edge_rows(spark, d).select(
        "o_orderkey", F.col("edge_text").alias("key_text"), number.alias("ssn"), canonical_id(number).alias("ssn_text"))


@query("text_coercion")
def q_text_coercion(spark, d):
    td = S.task_detail(Tables(spark, d))
    return td.select("task_refno",
                     text_coercion("userdef100", "None").alias("LoanNumber"),
                     to_decimal("userdef34").alias("AmountRequested"),
                     to_double("userdef14").alias("SmallAPR"),
                     to_decimal("userdef54", 18, 0).alias("FinalTerm"),
                     to_double("userdef55").alias("InterestRate"))


@query("parse_dates")
def q_parse_dates(spark, d):
    o = Tables(spark, d).orders
    s, p = F.col("o_orderstatus"), F.col("o_totalprice")
    txt = (F.when(p < 5000, F.lit("not a date"))
           .when(s == "F", F.date_format("o_orderdate", "M/d/yyyy H:mm"))
           .when(s == "O", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
           .otherwise(F.date_format("o_orderdate", "M/d/yyyy")))
    return o.select(F.col("o_orderkey"), txt.alias("date_text"), parse_dates(txt).alias("LEADDATE"))


def _date_texts(spark, d):
    """Every order's date as files of different origin write it."""
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    kinds = (F.when(key % 5 == 0, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
             .when(key % 5 == 1, F.date_format(day, "d MMM yyyy")).when(key % 5 == 2, F.date_format(day, "MMMM d, yyyy"))
             .when(key % 5 == 3, F.date_format(day, "yyyyMMdd")).otherwise(F.lit("not a date")))
    early = F.make_date(F.year(day), F.month(day), (1 + key % 12).cast("int"))
    return Tables(spark, d).orders.select(
        "o_orderkey", F.date_format(day, "M/d/yyyy h:mm a").alias("month_first"),
        F.date_format(day, "dd/MM/yyyy H:mm").alias("day_first"), F.date_format(day, "d.M.yyyy").alias("dotted"),
        kinds.alias("many"), F.date_format(early, "M/d/yy").alias("open"),
        F.when(F.col("o_totalprice") < 50000, F.date_format(day, "MM-dd-yyyy"))
        .otherwise(F.date_format(day, "dd-MM-yyyy")).alias("two_kinds"))


_DATE_TEXTS = ("month_first", "day_first", "dotted", "many", "open", "two_kinds")


@query("guess_dates")
def q_guess_dates(spark, d):
    rows = _date_texts(spark, d)
    guesses = guess_dates(rows, _DATE_TEXTS)
    return rows.select("o_orderkey", *[guesses[c].parse().alias(c) for c in _DATE_TEXTS])


@query("date_evidence")
def q_date_evidence(spark, d):
    return date_evidence(_date_texts(spark, d), _DATE_TEXTS)


@query("int_fill")
def q_int_fill(spark, d):
    return _edge_rows(spark, d).select("o_orderkey", "edge_text", int_fill("edge_text").alias("LEAD_SCORE"))


@query("int_strict")
def q_int_strict(spark, d):
    return _edge_rows(spark, d).select("o_orderkey", "edge_text", int_strict("edge_text").alias("AMT_APPLIED"))


@query("lead_projection")
def q_lead_projection(spark, d):
    leads = run(spark, d).leads
    return leads.select("ssn", "PQ_DECISION", "LEAD_TYPE", "LEAD_STATE", "CK_TRACKING_ID",
                        "LEADDATE", F.to_date("LEADDATE").alias("LEAD_DAY"), "lead_app",
                        F.lit(1).alias("ISPQAPP"))


@query("sentinel_to_null")
def q_sentinel_to_null(spark, d):
    td = S.task_detail(Tables(spark, d))
    rendered = F.when(F.col("userdef11").isNotNull(), text_coercion("userdef100", "NULL")) \
        .otherwise(text_coercion("userdef100", "None"))
    return td.select("task_refno", rendered.alias("LoanNumber_text"),
                     sentinel_to_null(rendered, ["None", "NULL"], trim=False).alias("LoanNumber"))


@query("final_amount")
def q_final_amount(spark, d):
    return run(spark, d).snapshot.select("task_refno", "LoanNumber", "FinalLoanAmount").distinct()


@query("customer_type")
def q_customer_type(spark, d):
    return run(spark, d).snapshot.select("task_refno", "CustomerType").distinct()


@query("score_parse")
def q_score_parse(spark, d):
    h = S.cif_detail(Tables(spark, d))
    return h.select("cifno", "userdef05", score_parse(F.col("userdef05")).alias("CreditScore"))


def _offers(spark, d):
    td = S.task_detail(Tables(spark, d))
    return td.select("task_refno",
                     to_decimal("userdef10").alias("SmallApprovedAmount"),
                     to_decimal("userdef19").alias("LargeApprovedAmount"),
                     to_double("userdef12").alias("SmallTerm"), to_double("userdef20").alias("LargeTerm"),
                     to_double("userdef14").alias("SmallAPR"), to_double("userdef21").alias("LargeAPR"))


@query("row_max")
def q_row_max(spark, d):
    return _offers(spark, d).select(
        "task_refno", row_max("SmallApprovedAmount", "LargeApprovedAmount").alias("AMT_APPROVED"))


@query("fallback_offer")
def q_fallback_offer(spark, d):
    return _offers(spark, d).select(
        "task_refno",
        fallback_offer("LargeTerm", "SmallTerm", False).alias("TERM_DAILY"),
        fallback_offer("LargeTerm", "SmallTerm", True).alias("TERM_WEEKLY"),
        fallback_offer("LargeAPR", "SmallAPR", False).alias("RATE_DAILY"),
        fallback_offer("LargeAPR", "SmallAPR", True).alias("RATE_WEEKLY"))


@query("cost_tier")
def q_cost_tier(spark, d):
    o = Tables(spark, d).orders
    c, p, s = cents(F.col("o_totalprice")), F.col("o_totalprice"), F.col("o_orderstatus")
    amount = (F.when(p < 30000, money(F.lit(0)))
              .when((s == "O") & (p > 450000), F.lit(None).cast("decimal(18,2)"))
              .when(s == "P", money((c / 100).cast("bigint") - 250000))
              .otherwise(money((c / 20).cast("bigint"))))
    return o.select(F.col("o_orderkey"), amount.alias("AMOUNT_FUNDED")).select(
        "o_orderkey", "AMOUNT_FUNDED",
        cost_tier("AMOUNT_FUNDED", R.COST_LOW).alias("COST_DAILY"),
        cost_tier("AMOUNT_FUNDED", 0).alias("COST_WEEKLY"))


@query("date_floor")
def q_date_floor(spark, d):
    return run(spark, d, "weekly").apps.select("ssn", "task_refno", "ApplicationEnterDate")


# --------------------------------------------------------------------------
# Funnel (B18-B24, 2.8)
# --------------------------------------------------------------------------
FUNNEL_DAILY_COLS = ("ssn", "CK_TRACKING_ID", "LEADDATE", "LEAD_SCORE", "PQ_DECISION",
                     "ApplicationEnterDate", "FundedDate", *R.FUNNEL_FLAGS, "AMT_APPLIED",
                     "AMT_APPROVED", "TERM_APPROVED", "RATE_APPROVED", "AMOUNT_FUNDED",
                     "TERM_FUNDED", "RATE_FUNDED", "APP_BEFORE_LEAD", "COST")
FUNNEL_WEEKLY_COLS = FUNNEL_DAILY_COLS + ("task_refno",)


@query("funnel_daily")
def q_funnel_daily(spark, d):
    return run(spark, d).funnel.select(*FUNNEL_DAILY_COLS)


@query("funnel_daily_intended")
def q_funnel_daily_intended(spark, d):
    return run(spark, d, "daily", "intended").funnel.select(*FUNNEL_DAILY_COLS)


@query("funnel_weekly")
def q_funnel_weekly(spark, d):
    return run(spark, d, "weekly").funnel.select(*FUNNEL_WEEKLY_COLS)


@query("funnel_weekly_v2")
def q_funnel_weekly_v2(spark, d):
    return run(spark, d, "weekly_v2").funnel.select(*FUNNEL_WEEKLY_COLS)


def _weekly_intended(profile: str):
    def q(spark, d):
        return run(spark, d, profile, "intended").funnel.select(*FUNNEL_WEEKLY_COLS)
    return q


for _p in ("weekly", "weekly_v2"):
    QUERIES[f"funnel_{_p}_intended"] = _weekly_intended(_p)


@query("before_lead_reset")
def q_before_lead_reset(spark, d):
    return run(spark, d).funnel.select(
        "ssn", F.col("_pre").alias("APP_BEFORE"), "ApplicationEnterDate", "FundedDate",
        "AMT_APPROVED", "TERM_APPROVED", "AMOUNT_FUNDED")


@query("funded_terms")
def q_funded_terms(spark, d):
    return run(spark, d).funnel.select("ssn", "IS_FUNDED", "TERM_FUNDED", "RATE_FUNDED")


# --------------------------------------------------------------------------
# Joins and lookups
# --------------------------------------------------------------------------
@query("application_snapshot")
def q_application_snapshot(spark, d):
    return run(spark, d).snapshot


@query("application_snapshot_intended")
def q_application_snapshot_intended(spark, d):
    return run(spark, d, "daily", "intended").snapshot


@query("borrower_semi_join")
def q_borrower_semi_join(spark, d):
    r = run(spark, d)
    return borrowers_for(r.srv, r.persons).select("SSNo", "Cifno", "ssn")


def _app_tasks(srv):
    return (srv.tmr.filter(F.col("tmr_code_id") == 1)
            .join(srv.task, F.col("parent_refno") == F.col("task_refno"), "inner"))


@query("left_join_left_pred")
def q_left_join_left_pred(spark, d):
    srv = S.stand_in_servicing(Tables(spark, d))
    td = srv.task_detail.select(F.col("task_refno").alias("td_task_refno"), "userdef100")
    out = left_join_left_pred(_app_tasks(srv), td, F.col("task_refno") == F.col("td_task_refno"),
                              F.col("task_template_no") == 1)
    return out.select("task_refno", "task_template_no", "td_task_refno", "userdef100")


@query("coalesced_key_join")
def q_coalesced_key_join(spark, d):
    t = Tables(spark, d)
    srv = S.stand_in_servicing(t)
    left = (_app_tasks(srv).select("task_refno")
            .join(srv.task_detail.select("task_refno", "userdef100"), "task_refno", "inner"))
    blank_loans = t.region.select(
        (F.lit(-1) - F.col("r_regionkey")).cast("bigint").alias("acctrefno"),
        F.when(F.col("r_regionkey") % 2 == 0, F.lit("")).otherwise(F.lit(None).cast("string")).alias("loan_number"))
    right = srv.loanacct.select("acctrefno", "loan_number").unionByName(blank_loans)
    return coalesced_key_join(left, right, "userdef100", "loan_number", "left") \
        .select("task_refno", "userdef100", "acctrefno")


@query("blank_key_join")
def q_blank_key_join(spark, d):
    """C7 where keys carry trailing blanks, as fixed-width columns do, and
    only the distinct rows matter."""
    t = Tables(spark, d)
    k = F.col("o_orderkey")
    number = F.concat(F.lit("LN"), (k % 5000).cast("string"))
    left = t.orders.filter(F.col("o_orderpriority").isin(*S.APP_PRIORITIES)).select(
        k.alias("task_refno"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 7 == 1, F.lit("")).when(k % 7 == 2, F.lit("   "))
        .when(k % 7 == 3, F.concat(number, F.lit("  "))).otherwise(number).alias("userdef100"))
    right = t.orders.filter(F.col("o_orderstatus") == "F").select(
        F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 11 == 1, F.lit(" "))
        .when(k % 11 == 2, F.concat(number, F.lit(" "))).otherwise(number).alias("loan_number"),
        F.when(k % 11 < 2, (k % 3).cast("int")).otherwise((k % 100).cast("int")).alias("loan_group_no"))
    return coalesced_key_join(left, right, "userdef100", "loan_number", "left", needed=["loan_group_no"]).distinct()


def _pivot(spark, d, by_time=False):
    srv = S.stand_in_servicing(Tables(spark, d))
    return history_pivot(srv.task_routing_history, srv.workflow_action, srv.workflow_result,
                         last_by_time=by_time)


@query("history_pivot")
def q_history_pivot(spark, d):
    return _pivot(spark, d).drop("_types")


@query("last_action_top1")
def q_last_action_top1(spark, d):
    return _pivot(spark, d).select("task_refno", "LastAction", "LastResult")


@query("earliest_balance")
def q_earliest_balance(spark, d):
    return earliest_balance(S.aged_balance(Tables(spark, d)))


@query("earliest_balance_all")
def q_earliest_balance_all(spark, d):
    """The earliest balance over every ``lineitem`` row."""
    return earliest_balance(S.all_balances(Tables(spark, d)))


@query("status_codes")
def q_status_codes(spark, d):
    srv = S.stand_in_servicing(Tables(spark, d))
    return status_codes(srv.loanacct_statuses, srv.loan_status_codes, accounts=srv.loanacct)


@query("lead_app_join")
def q_lead_app_join(spark, d):
    r = run(spark, d)
    apps = latest_apps(r.snapshot).select("ssn", "task_refno", "ApplicationEnterDate")
    return r.best_leads.select("ssn", "CK_TRACKING_ID").join(apps, "ssn", "left")


@query("match_merge")
def q_match_merge(spark, d):
    r = run(spark, d, "weekly")
    return weekly_rows(r.best_leads, r.apps, r.rules).select(
        "ssn", "CK_TRACKING_ID", "task_refno", "CustomerType")


@query("match_merge_positional")
def q_match_merge_positional(spark, d):
    """C17 with several leads and several applications per person: every lead
    order and every application order; each fiftieth customer has no key."""
    o = Tables(spark, d).orders.withColumn("ssn", F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")))
    leads = o.filter(F.col("o_orderpriority").isin(*S.LEAD_PRIORITIES)).select(
        "ssn", F.col("o_orderkey").alias("lead_key"), F.col("o_orderdate").alias("seen"))
    apps = o.filter(F.col("o_orderpriority").isin(*S.APP_PRIORITIES)).select(
        "ssn", F.col("o_orderkey").alias("app_key"), F.col("o_orderdate").alias("seen"))
    return match_merge(leads, apps, "ssn", [F.col("lead_key")], [F.col("seen"), F.col("app_key")])


# --------------------------------------------------------------------------
# Windows (E1-E6)
# --------------------------------------------------------------------------
@query("best_lead_daily")
def q_best_lead_daily(spark, d):
    return run(spark, d).best_leads.select("ssn", "CK_TRACKING_ID", "LEADDATE", "LEAD_SCORE",
                                           "AMT_APPLIED", "PQ_DECISION")


@query("best_lead_weekly")
def q_best_lead_weekly(spark, d):
    return run(spark, d, "weekly").best_leads.select("ssn", "CK_TRACKING_ID", "LEADDATE", "LEAD_SCORE",
                                                     "AMT_APPLIED", "LEAD_PREQUAL")


@query("best_lead_weekly_file_order")
def q_best_lead_weekly_file_order(spark, d):
    """E2 on files: one per month of ``orders``, newest order first; ties of
    the score go to the earlier file and line."""
    names = list(S.LEAD_FILE_HEADER)
    score = names.index("Applicant Credit Score")
    cols = S.lead_file_columns()
    cols[score] = (600 + F.col("o_orderkey") % 3).cast("string")       # many ties
    lines = Tables(spark, d).orders.select(F.trunc("o_orderdate", "month").alias("batch"), csv_line(cols).alias("value"),
                                           "o_orderkey")
    folder = scratch_path(spark, "fixtures", "ordered_drop", unique=True)
    write_batched_files(lines, folder, ",".join(names), [-F.col("o_orderkey")])
    files = sorted(path for path, _ in list_files(spark, folder))
    raw = read_lead_files(spark, files, with_order=True)
    rules = R.PROFILES["weekly"]
    return best_leads(typed_leads(raw, rules), rules).select("ssn", "CK_TRACKING_ID", "LEAD_SCORE")


@query("latest_app")
def q_latest_app(spark, d):
    return latest_apps(run(spark, d).snapshot).select("ssn", "task_refno", "ApplicationEnterDate",
                                                      "CustomerType")


@query("sticky_prequal")
def q_sticky_prequal(spark, d):
    r = run(spark, d, "weekly")
    return weekly_rows(r.best_leads, r.apps, r.rules).select(
        "ssn", "task_refno", "CustomerType", "LoanStatus", "StatusCodes", "IS_APPL", "IS_PREQUAL")


@query("best_outcome")
def q_best_outcome(spark, d):
    return run(spark, d, "weekly").funnel.select(
        "ssn", "task_refno", "APP_BEFORE_LEAD", "IS_FUNDED", "IS_APPROVE", "ApplicationEnterDate")


@query("best_outcome_intended")
def q_best_outcome_intended(spark, d):
    r = run(spark, d, "weekly")
    rules = r.rules.with_mode("intended")
    return best_outcome(weekly_rows(r.best_leads, r.apps, rules), rules).select(
        "ssn", "task_refno", "APP_BEFORE_LEAD", "IS_FUNDED", "IS_APPROVE", "ApplicationEnterDate")


# --------------------------------------------------------------------------
# Reports (A8, A9, D3-D6, D8, E5)
# --------------------------------------------------------------------------
@query("partner_feed")
def q_partner_feed(spark, d):
    return partner_feed(run(spark, d).funnel)


def _feed_text(profile: str):
    def q(spark, d):
        r = run(spark, d, profile)
        return feed_for_csv(partner_feed(r.funnel), r.rules)
    return q


for _p in ("daily", "weekly", "weekly_v2"):
    QUERIES[f"feed_text_{_p}"] = _feed_text(_p)


@query("daily_summary")
def q_daily_summary(spark, d):
    return daily_summary(run(spark, d, "weekly").funnel)


@query("daily_summary_total")
def q_daily_summary_total(spark, d):
    return daily_summary_total(run(spark, d, "weekly").funnel)


@query("weekly_summary")
def q_weekly_summary(spark, d):
    return weekly_summary(run(spark, d, "weekly").funnel)


@query("funnel_frequency")
def q_funnel_frequency(spark, d):
    return funnel_frequency(run(spark, d).funnel)


@query("funnel_frequency_weekly")
def q_funnel_frequency_weekly(spark, d):
    return funnel_frequency(run(spark, d, "weekly").funnel)


@query("funnel_gaps")
def q_funnel_gaps(spark, d):
    return funnel_gaps(run(spark, d).funnel)
