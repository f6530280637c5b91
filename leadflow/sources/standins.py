"""Stand-in inputs derived from the driver's TPC-H-ish tables.

The reference reads a partner lead file and ~15 loan-servicing relations.
The driver supplies ``orders``, ``lineitem`` and ``customer`` instead, so
every input relation is *derived* from them by column expressions (no
sampling, no id subsets): work grows with the tables.

Role mapping:

* lead file rows      - orders of priority 1/2 (one lead per order)
* application tasks   - orders of priority 4/5 (``tmr`` link code 1)
* task history        - lineitem (action by return flag, result by status)
* loan accounts       - orders with status F
* borrower map, cif   - customer
* balances, statuses  - lineitem

Code tables (task status, workflow action/result, loan status) are fixed
rows here; the plans join them like any other relation.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.sources.servicing import Servicing
from leadflow.sources.tables import Tables

# Fixed values of the stand-in data set.
LEAD_PRIORITIES = ("1-URGENT", "2-HIGH")
# The weekly programs drop applications dated before 1 Jan 2018; the
# stand-in dates span 1995-2001, so on stand-in data the floor sits at the
# same relative place near the start of the range instead.
APP_DATE_FLOOR = _dt.date(1996, 1, 1)
APP_PRIORITIES = ("4-NOT SPECIFIED", "5-LOW")
PARTNER = "CreditPartner"
OTHER_PARTNER = "OtherPartner"
TASK_STATUS_CODES = ((1, "FUNDED"), (2, "ELIGIBLE"), (3, "PENDING"))
WORKFLOW_ACTIONS = ((1, "ENTER APPLICATION DATA"), (2, "BOOK LOAN"),
                    (3, "PULL CREDIT REPORT"))
WORKFLOW_RESULTS = ((2, "yes"), (3, "no"), (28, "pending"), (32, "review"))
LOAN_STATUS_CODES = ((1, "CURRENT"), (2, "PAID OFF"), (3, "LATE"),
                     (4, "CHARGED OFF"), (5, "BANKRUPT"), (6, ""))
LEAD_FILE_HEADER = ("IRMPName", "Applicant SSN", "IRPID", "Application Number",
                    "Applicant Address Zip", "App. Cell Phone",
                    "Decision Status", "Loan Type", "Applicant Address State",
                    "Sub ID", "Application Date", "Decision Date/Time",
                    "Applicant Credit Score", "Amt. Fin.")


def code_table(spark: SparkSession, rows, key: str, value: str) -> DataFrame:
    """A fixed lookup table of a few rows, inline in the plan, so that the
    planner knows its size."""
    listed = ", ".join("({}, '{}')".format(k, v.replace("\\", "\\\\").replace("'", "\\'")) for k, v in rows)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS codes({key}, {value})")


# SQL snippets shared by the stand-in definitions (exact integer cents).
CENTS = "CAST(round({x} * 100) AS BIGINT)"


def _money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2))"


def _money_text(x: str) -> str:
    return f"concat(CAST(({x}) div 100 AS STRING), '.', lpad(CAST(({x}) % 100 AS STRING), 2, '0'))"


C = CENTS.format(x="o_totalprice")
_APP = "('" + "', '".join(APP_PRIORITIES) + "')"
_LEAD = "('" + "', '".join(LEAD_PRIORITIES) + "')"


# --------------------------------------------------------------------------
# Lead file
# --------------------------------------------------------------------------
def lead_file_exprs() -> list[str]:
    """The partner file's columns (text, raw header names) over an
    ``orders`` row, as SQL expressions."""
    date_txt = "date_format(o_orderdate, 'M/d/yyyy H:mm')"
    exprs = [
        f"CASE WHEN o_orderstatus = 'P' THEN '{OTHER_PARTNER}' ELSE '{PARTNER}' END",
        "CAST(o_custkey AS STRING)",
        "concat('IR', CAST(o_orderkey AS STRING))",
        "CAST(o_orderkey AS STRING)",
        "lpad(CAST(o_custkey % 100000 AS STRING), 5, '0')",
        "CAST(NULL AS STRING)",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Auto Approved' ELSE 'Declined' END",
        "'Personal'",
        "'SC'",
        "CAST(o_orderkey AS STRING)",
        date_txt,
        date_txt,
        "CASE WHEN o_totalprice < 20000 THEN CAST(NULL AS STRING) "
        "ELSE CAST(floor(o_totalprice / 1000) AS STRING) END",
        _money_text(C),
    ]
    return [f"{e} AS `{n}`" for e, n in zip(exprs, LEAD_FILE_HEADER)]


def lead_file_columns() -> list[Column]:
    return [F.expr(e) for e in lead_file_exprs()]


def lead_orders(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderpriority").isin(*LEAD_PRIORITIES))


def lead_file_rows(t: Tables) -> DataFrame:
    """Lead rows as a partner file carries them: text columns, raw headers."""
    return lead_orders(t).selectExpr(*lead_file_exprs())


def normalised_lead_rows(t: Tables) -> DataFrame:
    """Lead rows with headers normalised as the readers do (A4)."""
    from leadflow.sources.files import normalise_headers
    return normalise_headers(lead_file_rows(t))


# --------------------------------------------------------------------------
# Servicing relations (each one projection of a driver table)
# --------------------------------------------------------------------------
def cif(t: Tables) -> DataFrame:
    return t.customer.selectExpr("c_custkey AS cifno", "c_mktsegment AS firstname1",
                                 "c_name AS lastname1")


def borrower(t: Tables) -> DataFrame:
    """Person key <-> customer number view."""
    return t.customer.selectExpr("CAST(c_custkey AS STRING) AS SSNo", "c_custkey AS Cifno")


def cif_detail(t: Tables) -> DataFrame:
    return t.customer.selectExpr("c_custkey AS cifno", """
        CASE WHEN c_acctbal < 0 THEN CAST(NULL AS STRING)
             WHEN c_acctbal < 1000 THEN 'NO SCORE'
             WHEN c_mktsegment = 'AUTOMOBILE' THEN concat('Score ', lower(c_mktsegment), '.01')
             ELSE concat('FICO08-', lpad(CAST(300 + CAST(floor(c_acctbal) AS BIGINT) % 550 AS STRING), 4, '0'),
                         '.', CAST(c_nationkey AS STRING), 'X') END AS userdef05""")


def tmr(t: Tables) -> DataFrame:
    """Customer -> task link; code 1 marks application tasks."""
    return t.orders.selectExpr(
        f"CASE WHEN o_orderpriority IN {_APP} THEN 1 ELSE 2 END AS tmr_code_id",
        "o_custkey AS child_refno", "o_orderkey AS parent_refno")


def task(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey AS task_refno",
        "CASE WHEN o_totalprice < 20000 THEN 2 ELSE 1 END AS task_template_no",
        "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS status_code_id")


def task_detail(t: Tables) -> DataFrame:
    """Application details as text fields (money, terms, rates, loan number)."""
    return t.orders.selectExpr("*", f"{C} AS c").selectExpr(
        "o_orderkey AS task_refno",
        """CASE WHEN o_orderstatus = 'F' THEN concat('LN', CAST(o_orderkey AS STRING))
                WHEN o_orderstatus = 'O' AND o_totalprice >= 400000 THEN 'CLOSE BRANCH'
                WHEN o_orderstatus = 'O' AND o_totalprice >= 300000 THEN ''
                WHEN o_orderstatus = 'P' AND o_totalprice >= 450000 THEN ''
                ELSE CAST(NULL AS STRING) END AS userdef100""",
        f"{_money_text('c div 20')} AS userdef34",
        f"""CASE WHEN o_orderstatus = 'P' AND o_totalprice < 100000 THEN CAST(NULL AS STRING)
                 ELSE {_money_text('c div 40')} END AS userdef10""",
        f"""CASE WHEN o_orderstatus = 'P' THEN CAST(NULL AS STRING) WHEN o_totalprice < 50000 THEN '0.00'
                 ELSE {_money_text('c div 20')} END AS userdef19""",
        "CAST(12 + (c % 4) * 6 AS STRING) AS userdef12",
        """CASE WHEN o_orderstatus = 'P' THEN CAST(NULL AS STRING) WHEN o_totalprice < 150000 THEN '0'
                ELSE CAST(24 + (c % 3) * 12 AS STRING) END AS userdef20""",
        "concat(CAST(20 + c % 10 AS STRING), '.99') AS userdef14",
        """CASE WHEN o_orderstatus = 'P' THEN CAST(NULL AS STRING) WHEN o_totalprice < 150000 THEN '0'
                ELSE concat(CAST(15 + c % 10 AS STRING), '.49') END AS userdef21""",
        """CASE WHEN o_orderstatus = 'P' AND o_totalprice >= 250000 THEN 'DTI TOO HIGH'
                WHEN o_orderstatus = 'O' AND o_totalprice < 60000 THEN 'INSUFFICIENT INCOME'
                ELSE CAST(NULL AS STRING) END AS userdef11""",
        """CASE WHEN o_orderstatus = 'F' THEN CAST(12 * (1 + c % 5) AS STRING)
                ELSE CAST(NULL AS STRING) END AS userdef54""",
        "concat(CAST(5 + c % 20 AS STRING), '.5') AS userdef55",
        """CASE WHEN o_orderstatus = 'F' THEN concat(CAST(10 + c % 25 AS STRING), '.99')
                ELSE CAST(NULL AS STRING) END AS userdef57""",
        f"{_money_text('c div 50')} AS userdef04",
        f"{_money_text('c div 60')} AS userdef05",
        f"{_money_text('c div 200')} AS userdef07")


def _loan_orders(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderstatus") == "F").selectExpr("*", f"{C} AS c")


def loanacct(t: Tables) -> DataFrame:
    return _loan_orders(t).selectExpr(
        "o_orderkey AS acctrefno",
        "concat('LN', CAST(o_orderkey AS STRING)) AS loan_number",
        """CASE WHEN o_totalprice >= 480000 THEN 6 WHEN o_totalprice < 30000 THEN CAST(NULL AS INT)
                ELSE CAST(1 + c % 5 AS INT) END AS loan_group_no""",
        "CAST(1 + c % 6 AS INT) AS status_code_no",
        f"{_money('CASE WHEN o_totalprice > 490000 THEN c * 3 ELSE c div 20 END')} AS original_note_amount",
        f"CASE WHEN c % 3 = 0 THEN CAST(NULL AS DECIMAL(18,2)) ELSE {_money('c div 200')} END AS addonint_total")


def loanacct_detail(t: Tables) -> DataFrame:
    """Payoff amount as text with thousands separators."""
    return _loan_orders(t).selectExpr(
        "o_orderkey AS acctrefno",
        f"CASE WHEN c % 2 = 0 THEN format_number({_money('c div 20 + 12345')}, 2) "
        "ELSE CAST(NULL AS STRING) END AS userdef11")


def loanacct_setup(t: Tables) -> DataFrame:
    return _loan_orders(t).selectExpr(
        "o_orderkey AS acctrefno",
        "CASE c % 4 WHEN 0 THEN 'SI' WHEN 1 THEN '78' WHEN 2 THEN 'FA' ELSE 'AC' END AS interest_method")


def loanacct_statuses(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_orderkey AS acctrefno",
        """CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END
                + CASE WHEN l_linestatus = 'F' THEN 3 ELSE 0 END AS INT) AS status_code_no""")


def task_routing_history(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_orderkey AS task_refno",
        "CASE l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS workflow_action_id",
        """CASE WHEN l_linestatus = 'F' THEN 2 WHEN l_tax = 0 THEN 9 WHEN l_discount >= 0.08 THEN 28
                WHEN l_discount >= 0.05 THEN 32 ELSE 3 END AS workflow_result_id""",
        "l_shipdate AS created_date")


def _balances(lines: DataFrame) -> DataFrame:
    return lines.selectExpr(
        "concat('LN', CAST(l_orderkey AS STRING)) AS loannumber",
        f"{_money(CENTS.format(x='l_extendedprice'))} AS netbalance",
        "to_date(l_shipdate) AS rundate")


def aged_balance(t: Tables) -> DataFrame:
    return _balances(t.lineitem.filter(F.col("l_returnflag") == "R"))


def all_balances(t: Tables) -> DataFrame:
    """A balance for every ``lineitem`` row, whatever its return flag."""
    return _balances(t.lineitem)


def task_status_codes(spark: SparkSession) -> DataFrame:
    return code_table(spark, TASK_STATUS_CODES, "status_code_id", "status_code")


def workflow_action(spark: SparkSession) -> DataFrame:
    return code_table(spark, WORKFLOW_ACTIONS, "workflow_action_id", "action")


def workflow_result(spark: SparkSession) -> DataFrame:
    return code_table(spark, WORKFLOW_RESULTS, "workflow_result_id", "result")


def loan_status_codes(spark: SparkSession) -> DataFrame:
    return code_table(spark, LOAN_STATUS_CODES, "status_code_no", "status_code")


def stand_in_servicing(t: Tables) -> Servicing:
    """All servicing relations of one data set, derived from the driver's
    tables; one plan references one DataFrame per relation."""
    data = {f.__name__: f(t) for f in (
        cif, borrower, cif_detail, tmr, task, task_detail, loanacct, loanacct_detail, loanacct_setup,
        loanacct_statuses, task_routing_history, aged_balance)}
    codes = {f.__name__: f(t.spark) for f in (task_status_codes, workflow_action, workflow_result, loan_status_codes)}
    return Servicing(**data, **codes)
