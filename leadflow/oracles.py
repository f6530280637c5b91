"""DuckDB SQL twins of the registered queries (the correctness gate).

Written independently of the Spark code: every top-1 lookup of the
servicing query is its own row_number() CTE (the Spark plan folds them into
one aggregation), status codes use string_agg, and the funnel rules are
encoded as "last write wins" CASE chains of the ordered assignments instead
of our closed forms.  Tables are the driver's views.
"""

from __future__ import annotations

# --- helpers -------------------------------------------------------------
CENTS = "CAST(round({x} * 100) AS BIGINT)"


def money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2))"


def pad(x: str) -> str:
    return f"(CASE WHEN length({x}) < 9 THEN lpad({x}, 9, '0') ELSE {x} END)"


def money_text(x: str) -> str:
    return f"(CAST(({x}) // 100 AS VARCHAR) || '.' || lpad(CAST(({x}) % 100 AS VARCHAR), 2, '0'))"


LEAD_PRIORITIES = "('1-URGENT', '2-HIGH')"
APP_PRIORITIES = "('4-NOT SPECIFIED', '5-LOW')"
FLOOR = "DATE '1996-01-01'"

CTES: dict[str, str] = {}

# --- lead file -----------------------------------------------------------
CTES["file_rows"] = f"""
  SELECT CASE WHEN o_orderstatus = 'P' THEN 'OtherPartner' ELSE 'CreditPartner' END AS irmpname,
         CAST(o_custkey AS VARCHAR) AS applicant_ssn,
         o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'Auto Approved' ELSE 'Declined' END AS decision_status,
         CAST(o_orderkey AS VARCHAR) AS sub_id,
         strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS application_date,
         CASE WHEN o_totalprice < 20000 THEN NULL ELSE CAST(floor(o_totalprice / 1000) AS BIGINT) END AS score_num,
         {money_text(CENTS.format(x='o_totalprice'))} AS amt_text
  FROM orders"""

CTES["lead_rows"] = f"SELECT * FROM file_rows WHERE o_orderpriority IN {LEAD_PRIORITIES}"

# numbers as a careless file has them, one kind per residue of the order key
CTES["edge_rows"] = """
  SELECT o_orderkey, CASE o_orderkey % 11 WHEN 0 THEN 'NaN' WHEN 1 THEN 'Infinity'
         WHEN 2 THEN '123456789012345678901234567890' WHEN 3 THEN CAST(o_custkey AS VARCHAR) || '.0'
         WHEN 4 THEN '  ' || CAST(o_custkey AS VARCHAR) || ' ' WHEN 5 THEN '' WHEN 6 THEN '99999999999'
         WHEN 7 THEN '-17.9' WHEN 8 THEN NULL WHEN 9 THEN CAST(o_custkey AS VARCHAR) || 'X'
         ELSE CAST(o_custkey AS VARCHAR) END AS edge_text FROM orders"""

CTES["date_texts"] = """
  SELECT o_orderkey, o_orderdate,
         strftime(o_orderdate, '%-m/%-d/%Y %-I:%M %p') AS month_first,
         strftime(o_orderdate, '%d/%m/%Y %-H:%M') AS day_first,
         strftime(o_orderdate, '%-d.%-m.%Y') AS dotted,
         CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
              WHEN 1 THEN strftime(o_orderdate, '%-d %b %Y') WHEN 2 THEN strftime(o_orderdate, '%B %-d, %Y')
              WHEN 3 THEN strftime(o_orderdate, '%Y%m%d') ELSE 'not a date' END AS many,
         strftime(make_date(year(o_orderdate), month(o_orderdate), 1 + o_orderkey % 12), '%-m/%-d/%y') AS open,
         CASE WHEN o_totalprice < 50000 THEN strftime(o_orderdate, '%m-%d-%Y')
              ELSE strftime(o_orderdate, '%d-%m-%Y') END AS two_kinds
  FROM orders"""

# the numbers with the year last, read either way
_DATE_READINGS = (("month_first", "/", "%m/%d/%Y %I:%M %p", "%d/%m/%Y %I:%M %p"),
                  ("day_first", "/", "%m/%d/%Y %H:%M", "%d/%m/%Y %H:%M"), ("dotted", ".", "%m.%d.%Y", "%d.%m.%Y"),
                  ("open", "/", "%m/%d/%y", "%d/%m/%y"), ("two_kinds", "-", "%m-%d-%Y", "%d-%m-%Y"))
CTES["date_long"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{sep}' AS separator, o_orderkey,
         try_strptime({c}, '{mdy}') AS m, try_strptime({c}, '{dmy}') AS d FROM date_texts"""
    for c, sep, mdy, dmy in _DATE_READINGS)

CTES["date_counts"] = """
  SELECT c."column", s.separator, (SELECT count(*) FROM orders) AS n_text,
         CASE WHEN c."column" = 'many' THEN (SELECT count(*) FROM orders WHERE o_orderkey % 5 = 4) ELSE 0 END AS n_unparsed,
         count(*) FILTER (WHERE m IS NOT NULL AND d IS NULL) AS n_month_first,
         count(*) FILTER (WHERE m IS NULL AND d IS NOT NULL) AS n_day_first,
         count(*) FILTER (WHERE m = d) AS n_same, count(*) FILTER (WHERE m <> d) AS n_open
  FROM (SELECT unnest(['month_first', 'day_first', 'dotted', 'many', 'open', 'two_kinds']) AS "column") c
  CROSS JOIN (SELECT unnest(['/', '-', '.']) AS separator) s
  LEFT JOIN date_long l ON l."column" = c."column" AND l.separator = s.separator
  GROUP BY c."column", s.separator"""

CTES["leads_daily"] = f"""
  SELECT {pad('applicant_ssn')} AS ssn, decision_status AS PQ_DECISION, 'Personal' AS LEAD_TYPE,
         'SC' AS LEAD_STATE, sub_id AS CK_TRACKING_ID, o_orderdate AS LEADDATE,
         CAST(COALESCE(score_num, 0) AS INTEGER) AS LEAD_SCORE,
         CAST(trunc(o_totalprice) AS INTEGER) AS AMT_APPLIED
  FROM lead_rows WHERE irmpname = 'CreditPartner'"""

CTES["best_daily"] = """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ssn ORDER BY LEADDATE DESC NULLS LAST,
           LEAD_SCORE DESC NULLS LAST, AMT_APPLIED DESC NULLS LAST, CK_TRACKING_ID ASC NULLS LAST) AS rn
    FROM leads_daily) WHERE rn = 1"""

CTES["leads_weekly"] = """
  SELECT o_custkey AS ssn, decision_status AS PQ_DECISION, sub_id AS CK_TRACKING_ID,
         CAST(o_orderdate AS DATE) AS LEADDATE, CAST(score_num AS INTEGER) AS LEAD_SCORE,
         CAST(amt_text AS DOUBLE) AS AMT_APPLIED,
         CASE WHEN decision_status = 'Auto Approved' THEN 1 ELSE 0 END AS LEAD_PREQUAL
  FROM lead_rows"""

CTES["leads_weekly_v2"] = f"""
  SELECT {pad("CAST(TRY_CAST(trunc(TRY_CAST(trim(applicant_ssn) AS DOUBLE)) AS BIGINT) AS VARCHAR)")} AS ssn,
         decision_status AS PQ_DECISION, sub_id AS CK_TRACKING_ID,
         CAST(o_orderdate AS DATE) AS LEADDATE, CAST(score_num AS INTEGER) AS LEAD_SCORE,
         CAST(amt_text AS DOUBLE) AS AMT_APPLIED,
         CASE WHEN decision_status = 'Auto Approved' THEN 1 ELSE 0 END AS LEAD_PREQUAL
  FROM lead_rows WHERE irmpname = 'CreditPartner'"""

for _n in ("weekly", "weekly_v2"):
    CTES[f"best_{_n}"] = f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ssn ORDER BY LEAD_SCORE DESC NULLS LAST,
           CK_TRACKING_ID ASC NULLS LAST) AS rn
    FROM leads_{_n}) WHERE rn = 1"""

# --- servicing relations -------------------------------------------------
CTES["ord"] = f"""
  SELECT o.*, {CENTS.format(x='o_totalprice')} AS c FROM orders o"""

CTES["cif"] = """SELECT c_custkey AS cifno, c_mktsegment AS firstname1, c_name AS lastname1 FROM customer"""

CTES["cif_detail"] = """
  SELECT c_custkey AS cifno,
    CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 1000 THEN 'NO SCORE'
         WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Score ' || lower(c_mktsegment) || '.01'
         ELSE 'FICO08-' || lpad(CAST(300 + CAST(floor(c_acctbal) AS BIGINT) % 550 AS VARCHAR), 4, '0')
              || '.' || CAST(c_nationkey AS VARCHAR) || 'X' END AS userdef05
  FROM customer"""

CTES["borrower"] = """SELECT CAST(c_custkey AS VARCHAR) AS SSNo, c_custkey AS Cifno FROM customer"""

CTES["tmr"] = f"""
  SELECT CASE WHEN o_orderpriority IN {APP_PRIORITIES} THEN 1 ELSE 2 END AS tmr_code_id,
         o_custkey AS child_refno, o_orderkey AS parent_refno FROM orders"""

CTES["task"] = """
  SELECT o_orderkey AS task_refno, CASE WHEN o_totalprice < 20000 THEN 2 ELSE 1 END AS task_template_no,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS status_code_id FROM orders"""

CTES["task_detail"] = f"""
  SELECT o_orderkey AS task_refno,
    CASE WHEN o_orderstatus = 'F' THEN 'LN' || CAST(o_orderkey AS VARCHAR)
         WHEN o_orderstatus = 'O' AND o_totalprice >= 400000 THEN 'CLOSE BRANCH'
         WHEN o_orderstatus = 'O' AND o_totalprice >= 300000 THEN ''
         WHEN o_orderstatus = 'P' AND o_totalprice >= 450000 THEN '' END AS userdef100,
    {money('c // 20')} AS AmountRequested,
    CASE WHEN o_orderstatus = 'P' AND o_totalprice < 100000 THEN NULL ELSE {money('c // 40')} END AS SmallApprovedAmount,
    CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_totalprice < 50000 THEN CAST(0 AS DECIMAL(18,2))
         ELSE {money('c // 20')} END AS LargeApprovedAmount,
    CAST(12 + (c % 4) * 6 AS DOUBLE) AS SmallTerm,
    CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_totalprice < 150000 THEN 0.0
         ELSE CAST(24 + (c % 3) * 12 AS DOUBLE) END AS LargeTerm,
    CAST(CAST(20 + c % 10 AS VARCHAR) || '.99' AS DOUBLE) AS SmallAPR,
    CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_totalprice < 150000 THEN 0.0
         ELSE CAST(CAST(15 + c % 10 AS VARCHAR) || '.49' AS DOUBLE) END AS LargeAPR,
    CASE WHEN o_orderstatus = 'P' AND o_totalprice >= 250000 THEN 'DTI TOO HIGH'
         WHEN o_orderstatus = 'O' AND o_totalprice < 60000 THEN 'INSUFFICIENT INCOME' END AS ReasonDeclined,
    CASE WHEN o_orderstatus = 'F' THEN CAST(12 * (1 + c % 5) AS DECIMAL(18,0)) END AS FinalTerm,
    CAST(CAST(5 + c % 20 AS VARCHAR) || '.5' AS DOUBLE) AS InterestRate,
    CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(10 + c % 25 AS VARCHAR) || '.99' AS DOUBLE) END AS FinalAPR,
    {money('c // 50')} AS MonthlyGrossIncome,
    {money('c // 60')} AS MonthlyNetIncome,
    {money('c // 200')} AS FreeIncome
  FROM ord"""

CTES["loanacct"] = f"""
  SELECT o_orderkey AS acctrefno, 'LN' || CAST(o_orderkey AS VARCHAR) AS loan_number,
    CASE WHEN o_totalprice >= 480000 THEN 6 WHEN o_totalprice < 30000 THEN NULL ELSE CAST(1 + c % 5 AS INTEGER) END AS loan_group_no,
    CAST(1 + c % 6 AS INTEGER) AS status_code_no,
    {money('CASE WHEN o_totalprice > 490000 THEN c * 3 ELSE c // 20 END')} AS original_note_amount,
    CASE WHEN c % 3 = 0 THEN NULL ELSE {money('c // 200')} END AS addonint_total
  FROM ord WHERE o_orderstatus = 'F'"""

CTES["loanacct_detail"] = f"""
  SELECT o_orderkey AS acctrefno,
         CASE WHEN c % 2 = 0 THEN CAST({money('c // 20 + 12345')} AS VARCHAR) END AS userdef11
  FROM ord WHERE o_orderstatus = 'F'"""

CTES["loanacct_setup"] = """
  SELECT o_orderkey AS acctrefno,
         CASE c % 4 WHEN 0 THEN 'SI' WHEN 1 THEN '78' WHEN 2 THEN 'FA' ELSE 'AC' END AS interest_method
  FROM ord WHERE o_orderstatus = 'F'"""

CTES["loanacct_statuses"] = """
  SELECT l_orderkey AS acctrefno,
         CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END
              + CASE WHEN l_linestatus = 'F' THEN 3 ELSE 0 END AS INTEGER) AS status_code_no
  FROM lineitem"""

CTES["loan_status_codes"] = """
  SELECT * FROM (VALUES (1, 'CURRENT'), (2, 'PAID OFF'), (3, 'LATE'), (4, 'CHARGED OFF'),
                        (5, 'BANKRUPT'), (6, '')) AS t(status_code_no, status_code)"""

CTES["task_status_codes"] = """
  SELECT * FROM (VALUES (1, 'FUNDED'), (2, 'ELIGIBLE'), (3, 'PENDING')) AS t(status_code_id, status_code)"""

CTES["workflow_action"] = """
  SELECT * FROM (VALUES (1, 'ENTER APPLICATION DATA'), (2, 'BOOK LOAN'), (3, 'PULL CREDIT REPORT'))
    AS t(workflow_action_id, action)"""

CTES["workflow_result"] = """
  SELECT * FROM (VALUES (2, 'yes'), (3, 'no'), (28, 'pending'), (32, 'review')) AS t(workflow_result_id, result)"""

CTES["trh"] = """
  SELECT l_orderkey AS task_refno,
         CASE l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS workflow_action_id,
         CASE WHEN l_linestatus = 'F' THEN 2 WHEN l_tax = 0 THEN 9 WHEN l_discount >= 0.08 THEN 28
              WHEN l_discount >= 0.05 THEN 32 ELSE 3 END AS workflow_result_id,
         l_shipdate AS created_date
  FROM lineitem"""

CTES["hist"] = """
  SELECT h.*, wa.action, wr.result FROM trh h
    LEFT JOIN workflow_action wa ON h.workflow_action_id = wa.workflow_action_id
    LEFT JOIN workflow_result wr ON wr.workflow_result_id = h.workflow_result_id"""

CTES["aged_balance"] = f"""
  SELECT 'LN' || CAST(l_orderkey AS VARCHAR) AS loannumber,
         {money(CENTS.format(x='l_extendedprice'))} AS netbalance,
         CAST(l_shipdate AS DATE) AS rundate
  FROM lineitem WHERE l_returnflag = 'R'"""

CTES["statflags"] = """
  SELECT s.acctrefno, string_agg(lsc.status_code, ',' ORDER BY lsc.status_code) AS statflags
  FROM loanacct l JOIN loanacct_statuses s ON l.acctrefno = s.acctrefno
       JOIN loan_status_codes lsc ON lsc.status_code_no = s.status_code_no
  WHERE lsc.status_code <> ''
  GROUP BY s.acctrefno"""


def _lookup_ctes(sfx: str, intended: bool) -> dict[str, str]:
    """Per-task and per-loan top-1 lookups as row_number() over the history
    and balance relations (one CTE per lookup)."""
    last_order = ("created_date DESC NULLS LAST, action DESC NULLS LAST, result DESC NULLS LAST"
                  if intended else "action DESC NULLS LAST, result DESC NULLS LAST")
    total = "CAST(acct.original_note_amount + COALESCE(acct.addonint_total, CAST(0.00 AS DECIMAL(18,2))) AS VARCHAR)"
    total_txt = total if intended else f"left({total}, 9)"
    return {
        f"enter_first{sfx}": """
  SELECT task_refno, CAST(created_date AS DATE) AS enter_day FROM (
    SELECT task_refno, created_date,
           row_number() OVER (PARTITION BY task_refno ORDER BY created_date NULLS FIRST) AS k
    FROM hist WHERE action = 'ENTER APPLICATION DATA') WHERE k = 1""",
        f"booked_last{sfx}": """
  SELECT task_refno, CAST(created_date AS DATE) AS booked_day FROM (
    SELECT task_refno, created_date,
           row_number() OVER (PARTITION BY task_refno ORDER BY created_date DESC NULLS LAST) AS k
    FROM hist WHERE action = 'BOOK LOAN' AND result = 'yes') WHERE k = 1""",
        f"pulled{sfx}": """
  SELECT DISTINCT task_refno FROM hist WHERE action = 'PULL CREDIT REPORT' AND result = 'yes'""",
        f"top_action{sfx}": f"""
  SELECT task_refno, action AS top_action, result AS top_result FROM (
    SELECT task_refno, action, result,
           row_number() OVER (PARTITION BY task_refno ORDER BY {last_order}) AS k FROM hist) WHERE k = 1""",
        f"types{sfx}": """
  SELECT task_refno, CASE workflow_result_id WHEN 2 THEN 'FB' WHEN 3 THEN 'NB'
                          WHEN 28 THEN 'PB' WHEN 32 THEN 'PB' END AS ctype
  FROM trh WHERE workflow_action_id = 2""",
        f"first_balance{sfx}": """
  SELECT loannumber, netbalance FROM (
    SELECT loannumber, netbalance,
           row_number() OVER (PARTITION BY loannumber ORDER BY rundate NULLS FIRST, netbalance) AS k
    FROM aged_balance) WHERE k = 1""",
        f"loan_side{sfx}": f"""
  SELECT acct.loan_number, acct.loan_group_no, codes.status_code AS acct_status, sf.statflags,
    bal.netbalance,
    CASE WHEN setup.interest_method = 'SI' THEN {total_txt}
         ELSE COALESCE(replace(det.userdef11, ',', ''), {total_txt}) END AS amount_txt
  FROM loanacct acct
    LEFT JOIN loanacct_detail det USING (acctrefno)
    LEFT JOIN loanacct_setup setup USING (acctrefno)
    LEFT JOIN statflags sf USING (acctrefno)
    LEFT JOIN loan_status_codes codes ON codes.status_code_no = acct.status_code_no
    LEFT JOIN first_balance{sfx} bal ON bal.loannumber = acct.loan_number""",
    }


def _app_table(sfx: str = "") -> str:
    """All application rows: every customer's code-1 tasks with detail,
    lookups and loan side; DISTINCT over the output columns."""
    return f"""
  SELECT DISTINCT
    cust.firstname1 AS firstname, cust.lastname1 AS lastname, tk.task_refno,
    det.userdef100 AS LoanNumber, ln.statflags AS StatusCodes, tsc.status_code AS TaskStatus,
    CASE WHEN det.userdef100 IS NOT NULL THEN ln.acct_status END AS LoanStatus,
    CASE WHEN pc.task_refno IS NULL THEN 'No' ELSE 'Yes' END AS WasCreditReportPulled,
    bk.booked_day AS FundedDate,
    CASE WHEN cd.userdef05 IS NULL OR length(rtrim(cd.userdef05)) < 13
              OR regexp_matches(cd.userdef05, ' [a-zA-Z]') THEN 0
         WHEN strpos(cd.userdef05, '.') > 0 THEN TRY_CAST(right(split_part(cd.userdef05, '.', 1), 4) AS INTEGER)
    END AS CreditScore,
    CAST(CASE WHEN ln.netbalance IS NOT NULL THEN ln.netbalance
              WHEN det.userdef100 IS NULL THEN CAST(0 AS DECIMAL(18,2))
              ELSE TRY_CAST(ln.amount_txt AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS FinalLoanAmount,
    ef.enter_day AS ApplicationEnterDate,
    det.FinalTerm, det.InterestRate, det.FinalAPR,
    ta.top_action AS LastAction, ta.top_result AS LastResult,
    det.AmountRequested, det.SmallApprovedAmount, det.LargeApprovedAmount,
    det.SmallAPR, det.LargeAPR, det.SmallTerm, det.LargeTerm,
    cust.cifno AS Cifno, det.ReasonDeclined, det.FreeIncome, det.MonthlyGrossIncome, det.MonthlyNetIncome,
    ty.ctype AS CustomerType
  FROM tmr link
    JOIN cif cust ON cust.cifno = link.child_refno
    JOIN task tk ON tk.task_refno = link.parent_refno
    JOIN task_status_codes tsc ON tsc.status_code_id = tk.status_code_id
    LEFT JOIN task_detail det ON det.task_refno = tk.task_refno AND tk.task_template_no = 1
    LEFT JOIN cif_detail cd ON cd.cifno = cust.cifno
    LEFT JOIN loan_side{sfx} ln ON COALESCE(ln.loan_number, '') = COALESCE(det.userdef100, '')
    LEFT JOIN pulled{sfx} pc ON pc.task_refno = det.task_refno
    LEFT JOIN booked_last{sfx} bk ON bk.task_refno = det.task_refno
    LEFT JOIN enter_first{sfx} ef ON ef.task_refno = det.task_refno
    LEFT JOIN top_action{sfx} ta ON ta.task_refno = tk.task_refno
    LEFT JOIN types{sfx} ty ON ty.task_refno = tk.task_refno
  WHERE link.tmr_code_id = 1
    AND ef.enter_day IS NOT NULL
    AND COALESCE(det.userdef100, '') <> 'CLOSE BRANCH'
    AND COALESCE(ln.loan_group_no, 1) <> 6"""


CTES.update(_lookup_ctes("", intended=False))
CTES.update(_lookup_ctes("_i", intended=True))
CTES["app_table"] = _app_table()


def _snapshot(persons: str, app_table: str = "app_table") -> str:
    return f"""
  SELECT DISTINCT a.*, CAST(b.SSNo AS BIGINT) AS SSNo, {pad('b.SSNo')} AS ssn, 'app' AS lead_app
  FROM {app_table} a JOIN borrower b ON a.Cifno = b.Cifno
  WHERE {pad('b.SSNo')} IN (SELECT ssn FROM {persons} WHERE ssn IS NOT NULL)"""


CTES["persons_daily"] = "SELECT ssn FROM best_daily"
CTES["persons_weekly"] = f"SELECT {pad('CAST(ssn AS VARCHAR)')} AS ssn FROM best_weekly"
CTES["persons_weekly_v2"] = "SELECT ssn FROM best_weekly_v2"
CTES["snapshot"] = _snapshot("persons_daily")
CTES["snapshot_weekly"] = _snapshot("persons_weekly")
CTES["snapshot_weekly_v2"] = _snapshot("persons_weekly_v2")

APP_TIE = ("CustomerType ASC NULLS FIRST, LoanStatus ASC NULLS FIRST, StatusCodes ASC NULLS FIRST, "
           "FinalLoanAmount ASC NULLS FIRST, SSNo ASC NULLS FIRST")

def _daily(sfx: str = "", intended: bool = False) -> dict[str, str]:
    """The daily program's chain; ``intended`` compares days and zeroes all
    amounts of before-lead rows."""
    out = {}
    lead_cmp = "CAST(l.LEADDATE AS DATE)" if intended else "l.LEADDATE"
    out[f"apps_daily{sfx}"] = f"""
  SELECT * EXCLUDE (rn, lead_app) FROM (
    SELECT *, row_number() OVER (PARTITION BY ssn ORDER BY ApplicationEnterDate DESC NULLS LAST,
           task_refno DESC NULLS LAST, {APP_TIE}) AS rn FROM snapshot{sfx}) WHERE rn = 1"""
    out[f"joined_daily{sfx}"] = f"""
  SELECT l.*, a.* EXCLUDE (ssn), a.ApplicationEnterDate AS A0,
         COALESCE(a.ApplicationEnterDate < {lead_cmp}, FALSE) AS pre0
  FROM best_daily l LEFT JOIN apps_daily{sfx} a ON l.ssn = a.ssn"""
    # Ordered pandas assignments, encoded as "last write wins" CASE chains.
    out[f"funnel_daily_s1{sfx}"] = f"""
  SELECT *,
    CASE WHEN pre0 THEN NULL ELSE A0 END AS A2,
    CASE WHEN pre0 THEN NULL ELSE FundedDate END AS F2,
    CASE WHEN pre0 THEN CAST(0 AS DECIMAL(18,2))
         ELSE COALESCE(greatest(SmallApprovedAmount, LargeApprovedAmount), CAST(0 AS DECIMAL(18,2))) END AS AMT_APPROVED
  FROM joined_daily{sfx}"""
    out[f"funnel_daily_s2{sfx}"] = f"""
  SELECT *,
    CASE WHEN A2 IS NULL THEN 0 WHEN A2 < LEADDATE THEN 0
         WHEN AMT_APPROVED > 0 AND ReasonDeclined IS NULL THEN 1
         WHEN TaskStatus = 'FUNDED' OR TaskStatus = 'ELIGIBLE' THEN 1 ELSE 0 END AS IS_APPROVE,
    CASE WHEN A2 IS NULL THEN 0 WHEN A2 < LEADDATE THEN 0
         WHEN NULLIF(LoanNumber, 'None') IS NOT NULL THEN 1
         WHEN TaskStatus = 'FUNDED' THEN 1 ELSE 0 END AS IS_FUNDED
  FROM funnel_daily_s1{sfx}"""
    if intended:
        # a before-lead app on the lead's day is not before under day compare;
        # A2 < LEADDATE above would then wrongly reset it, so compare days.
        out[f"funnel_daily_s2{sfx}"] = out[f"funnel_daily_s2{sfx}"].replace(
            "A2 < LEADDATE", "A2 < CAST(LEADDATE AS DATE)")
    out[f"funnel_daily_s3{sfx}"] = f"""
  SELECT *,
    CASE WHEN IS_APPROVE = 1 THEN 1 WHEN A2 IS NULL THEN 0 WHEN A2 < {'CAST(LEADDATE AS DATE)' if intended else 'LEADDATE'} THEN 0
         WHEN trunc(COALESCE(AmountRequested, 0)) > 0 THEN 1 WHEN A2 IS NOT NULL THEN 1 ELSE 0 END AS IS_APPL
  FROM funnel_daily_s2{sfx}"""
    term = ("CASE WHEN pre0 THEN 0.0 WHEN LargeTerm <= 0 THEN SmallTerm WHEN LargeTerm > 0 THEN LargeTerm END"
            if intended else
            "CASE WHEN LargeTerm <= 0 THEN SmallTerm WHEN LargeTerm > 0 THEN LargeTerm WHEN pre0 THEN 0.0 END")
    rate = term.replace("LargeTerm", "LargeAPR").replace("SmallTerm", "SmallAPR")
    amount = ("CASE WHEN pre0 THEN CAST(0 AS DECIMAL(18,2)) ELSE FinalLoanAmount END"
              if intended else "FinalLoanAmount")
    out[f"funnel_daily{sfx}"] = f"""
  SELECT ssn, CK_TRACKING_ID, LEADDATE, LEAD_SCORE, PQ_DECISION,
    A2 AS ApplicationEnterDate, F2 AS FundedDate, 1 AS ISPQAPP,
    CASE WHEN IS_APPL = 1 THEN 1 WHEN IS_APPROVE = 1 THEN 1
         WHEN PQ_DECISION = 'Auto Approved' THEN 1 ELSE 0 END AS IS_PREQUAL,
    IS_APPL, IS_APPROVE, IS_FUNDED, AMT_APPLIED, AMT_APPROVED,
    {term} AS TERM_APPROVED,
    {rate} AS RATE_APPROVED,
    CAST({amount} AS DECIMAL(18,2)) AS AMOUNT_FUNDED,
    CAST(CASE WHEN IS_FUNDED = 1 THEN FinalTerm ELSE 0 END AS DECIMAL(18,0)) AS TERM_FUNDED,
    CAST(CASE WHEN IS_FUNDED = 1 THEN FinalAPR ELSE 0 END AS DOUBLE) AS RATE_FUNDED,
    0 AS APP_BEFORE_LEAD,
    CASE WHEN pre0 THEN 1 ELSE 0 END AS _pre,
    CASE WHEN {amount} > 2500 THEN 200 WHEN {amount} = 0 THEN 0
         WHEN {amount} <= 2500 THEN 125 ELSE 0 END AS COST
  FROM funnel_daily_s3{sfx}"""
    return out


CTES["app_table_intended"] = _app_table("_i")
CTES["snapshot_intended"] = _snapshot("persons_daily", "app_table_intended")
CTES.update(_daily())
CTES.update(_daily("_intended", intended=True))


def _weekly(profile: str, snapshot: str | None = None, suffix: str = "") -> dict[str, str]:
    v1 = profile == "weekly"
    null_text = "'NULL'" if v1 else "'None'"
    not_declined = "'NULL'" if v1 else "''"
    none_list = "('NULL', '')" if v1 else "('None', '')"
    key = "SSNo" if v1 else pad("CAST(SSNo AS VARCHAR)")
    snap = snapshot or ("snapshot_weekly" if v1 else "snapshot_weekly_v2")
    leads, p = f"best_{profile}", profile + suffix
    out = {}
    out[f"apps_{p}"] = f"""
  SELECT * EXCLUDE (ssn, LoanNumber, TaskStatus, ReasonDeclined, lead_app),
         {key} AS ssn,
         COALESCE(LoanNumber, {null_text}) AS LoanNumber,
         COALESCE(TaskStatus, {null_text}) AS TaskStatus,
         COALESCE(ReasonDeclined, {not_declined}) AS ReasonDeclined
  FROM {snap}
  WHERE ApplicationEnterDate IS NOT NULL AND ApplicationEnterDate >= {FLOOR}"""
    out[f"merged_{p}"] = f"""
  SELECT l.*, a.* EXCLUDE (ssn),
         (a.ApplicationEnterDate IS NULL AND l.LEADDATE IS NOT NULL)
           OR COALESCE(a.ApplicationEnterDate < l.LEADDATE, FALSE) AS pre
  FROM {leads} l LEFT JOIN apps_{p} a ON l.ssn IS NOT DISTINCT FROM a.ssn"""
    # SAS DATA step, statement by statement (last write wins).
    out[f"rows_{p}"] = f"""
  SELECT *,
    CASE WHEN pre THEN 0
         WHEN greatest(SmallApprovedAmount, LargeApprovedAmount) > 0
              AND COALESCE(rtrim(ReasonDeclined), '') = {not_declined} THEN 1
         WHEN COALESCE(rtrim(TaskStatus), '') IN ('FUNDED', 'ELIGIBLE') THEN 1 ELSE 0 END AS IS_APPROVE,
    CASE WHEN pre THEN 0
         WHEN COALESCE(rtrim(LoanNumber), '') NOT IN {none_list} THEN 1
         WHEN COALESCE(rtrim(TaskStatus), '') = 'FUNDED' THEN 1 ELSE 0 END AS IS_FUNDED,
    CASE WHEN pre THEN 0 WHEN AmountRequested > 0 THEN 1 ELSE 0 END AS IS_APPL0
  FROM merged_{p}"""
    out[f"rows2_{p}"] = f"""
  SELECT *,
    CASE WHEN IS_APPROVE = 1 THEN 1 ELSE IS_APPL0 END AS IS_APPL
  FROM rows_{p}"""
    out[f"rows3_{p}"] = f"""
  SELECT *,
    GREATEST(LEAD_PREQUAL, max(IS_APPL) OVER (PARTITION BY ssn ORDER BY ApplicationEnterDate ASC NULLS FIRST,
             task_refno ASC NULLS FIRST, {APP_TIE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS IS_PREQUAL,
    CASE WHEN pre THEN 1 ELSE 0 END AS APP_BEFORE_LEAD,
    CAST(CASE WHEN pre THEN 0 ELSE FinalLoanAmount END AS DECIMAL(18,2)) AS AMOUNT_FUNDED
  FROM rows2_{p}"""
    out[f"funnel_rows_{p}"] = f"""
  SELECT ssn, CK_TRACKING_ID, LEADDATE, LEAD_SCORE, PQ_DECISION, task_refno,
    CustomerType, LoanStatus, StatusCodes, FinalLoanAmount, SSNo,
    CASE WHEN pre THEN NULL ELSE ApplicationEnterDate END AS ApplicationEnterDate,
    CASE WHEN pre THEN NULL ELSE FundedDate END AS FundedDate,
    1 AS ISPQAPP, IS_PREQUAL, IS_APPL, IS_APPROVE, IS_FUNDED, AMT_APPLIED,
    CAST(CASE WHEN pre THEN 0 ELSE greatest(SmallApprovedAmount, LargeApprovedAmount) END AS DECIMAL(18,2)) AS AMT_APPROVED,
    CASE WHEN pre THEN 0.0 WHEN LargeTerm > 0 THEN LargeTerm ELSE SmallTerm END AS TERM_APPROVED,
    CASE WHEN pre THEN 0.0 WHEN LargeAPR > 0 THEN LargeAPR ELSE SmallAPR END AS RATE_APPROVED,
    AMOUNT_FUNDED,
    CAST(CASE WHEN pre THEN 0 WHEN IS_FUNDED = 1 THEN FinalTerm ELSE 0 END AS DECIMAL(18,0)) AS TERM_FUNDED,
    CAST(CASE WHEN pre THEN 0 WHEN IS_FUNDED = 1 THEN FinalAPR ELSE 0 END AS DOUBLE) AS RATE_FUNDED,
    APP_BEFORE_LEAD,
    CASE WHEN AMOUNT_FUNDED > 0 AND AMOUNT_FUNDED <= 2500 THEN 125
         WHEN AMOUNT_FUNDED > 2500 THEN 200 ELSE 0 END AS COST
  FROM rows3_{p}"""
    for suffix, before in (("", "DESC"), ("_intended", "ASC")):
        out[f"funnel_{p}{suffix}"] = f"""
  SELECT * EXCLUDE (rn, CustomerType, LoanStatus, StatusCodes, FinalLoanAmount, SSNo) FROM (
    SELECT *, row_number() OVER (PARTITION BY ssn ORDER BY APP_BEFORE_LEAD {before}, IS_FUNDED DESC,
           IS_APPROVE DESC, ApplicationEnterDate ASC NULLS FIRST, task_refno ASC NULLS FIRST, {APP_TIE}) AS rn
    FROM funnel_rows_{p}) WHERE rn = 1"""
    return out


CTES.update(_weekly("weekly"))
CTES.update(_weekly("weekly_v2"))
# the intended rules from the tables on: snapshot, then best outcome
for _n in ("weekly", "weekly_v2"):
    CTES[f"snapshot_{_n}_i"] = _snapshot(f"persons_{_n}", "app_table_intended")
    CTES.update(_weekly(_n, f"snapshot_{_n}_i", "_i"))


def with_ctes(select: str) -> str:
    """Prefix a final SELECT with every CTE (DuckDB evaluates only the ones
    it references)."""
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in CTES.items())
    return f"WITH {body}\n{select}"


# --- per-key final SELECTs ----------------------------------------------
C = CENTS.format(x="o_totalprice")
FUNNEL_COLS = ("ssn, CK_TRACKING_ID, LEADDATE, LEAD_SCORE, PQ_DECISION, ApplicationEnterDate, FundedDate, "
               "ISPQAPP, IS_PREQUAL, IS_APPL, IS_APPROVE, IS_FUNDED, AMT_APPLIED, AMT_APPROVED, "
               "TERM_APPROVED, RATE_APPROVED, AMOUNT_FUNDED, TERM_FUNDED, RATE_FUNDED, APP_BEFORE_LEAD, COST")
FEED_COLS = ("CK_TRACKING_ID, LEADDATE, ApplicationEnterDate, FundedDate, ISPQAPP, IS_PREQUAL, IS_APPL, "
             "IS_APPROVE, IS_FUNDED, AMT_APPLIED, AMT_APPROVED, TERM_APPROVED, RATE_APPROVED, "
             "AMOUNT_FUNDED, TERM_FUNDED, RATE_FUNDED")
SUMMARY_AGGS = """count(IS_PREQUAL) AS NUM_LEADS, CAST(sum(IS_PREQUAL) AS BIGINT) AS NUM_PQ,
    CAST(sum(IS_APPL) AS BIGINT) AS NUM_APPS, CAST(sum(IS_APPROVE) AS BIGINT) AS NUM_APPR,
    CAST(sum(IS_FUNDED) AS BIGINT) AS NUM_BOOKED, CAST(sum(AMOUNT_FUNDED) AS DECIMAL(18,2)) AS DOLLARS_BOOKED,
    CAST(sum(COST) AS BIGINT) AS LEAD_COST"""
FLAGS = "ISPQAPP, IS_PREQUAL, IS_APPL, IS_APPROVE, IS_FUNDED"


def _ratio(n: str, d: str) -> str:
    return f"CASE WHEN {d} = 0 OR {d} IS NULL THEN NULL ELSE CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END"


def _feed_text(day: str, two_decimals: bool, clock: str) -> str:
    """The feed's columns as they are printed."""
    def amount(c: str) -> str:
        text = f"CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR)"
        return text if two_decimals else f"regexp_replace({text}, '\\.?0+$', '')"
    out = []
    for c in FEED_COLS.split(", "):
        if c == "LEADDATE":
            e = f"strftime({c}, '{day}{clock}')"
        elif c.endswith("Date"):
            e = f"strftime({c}, '{day}')"
        elif c.startswith(("AMOUNT_", "AMT_APPROVED", "TERM_", "RATE_")) or (c == "AMT_APPLIED" and not two_decimals):
            e = amount(c)
        else:
            e = f"CAST({c} AS VARCHAR)"
        out.append(f"{e} AS {c}")
    return ", ".join(out)


SELECTS: dict[str, str] = {
    "src_newest_oldest": """
  SELECT irmpname, applicant_ssn, sub_id, application_date,
         CAST(score_num AS VARCHAR) AS applicant_credit_score, decision_status
  FROM file_rows
  WHERE date_trunc('month', o_orderdate) IN ((SELECT min(date_trunc('month', o_orderdate)) FROM file_rows),
                                             (SELECT max(date_trunc('month', o_orderdate)) FROM file_rows))""",
    "src_lenient_csv": """
  SELECT sub_id, irmpname,
         CASE WHEN o_orderstatus = 'F' AND o_totalprice > 450000 THEN 'Personal' || chr(10) || 'Loan "Plus"'
              WHEN o_orderstatus = 'O' AND o_totalprice > 450000 THEN 'Pr\u00eat personnel'
              ELSE 'Personal' END AS loan_type,
         CASE WHEN o_totalprice < 20000 THEN NULL ELSE CAST(score_num AS VARCHAR) END AS applicant_credit_score,
         CASE WHEN o_totalprice < 20000 THEN NULL ELSE amt_text END AS "amt._fin."
  FROM file_rows WHERE NOT (o_orderstatus = 'P' AND o_totalprice > 350000)""",
    "union_by_name": """
  SELECT sub_id, applicant_ssn, decision_status FROM file_rows WHERE decision_status = 'Auto Approved'
  UNION ALL
  SELECT sub_id, NULL AS applicant_ssn, decision_status FROM file_rows WHERE decision_status <> 'Auto Approved'""",
    "normalise_headers": """
  SELECT irmpname, applicant_ssn, 'IR' || CAST(o_orderkey AS VARCHAR) AS irpid,
         CAST(o_orderkey AS VARCHAR) AS application_number,
         lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0') AS applicant_address_zip,
         CAST(NULL AS VARCHAR) AS "app._cell_phone", decision_status, 'Personal' AS loan_type,
         'SC' AS applicant_address_state, sub_id, application_date,
         application_date AS "decision_date/time", CAST(score_num AS VARCHAR) AS applicant_credit_score,
         amt_text AS "amt._fin."
  FROM file_rows""",
    "ingest_stream": "SELECT irmpname, applicant_ssn, sub_id, application_date FROM file_rows",
    "partner_filter": "SELECT irmpname, sub_id, applicant_ssn FROM lead_rows WHERE irmpname = 'CreditPartner'",
    "canonical_id": f"SELECT o_orderkey, edge_text AS key_text, {pad('edge_text')} AS ssn FROM edge_rows",
    "canonical_id_numeric": f"""
  SELECT o_orderkey, key_text, ssn, {pad('CAST(ssn AS VARCHAR)')} AS ssn_text FROM (
    SELECT o_orderkey, edge_text AS key_text,
           TRY_CAST(trunc(TRY_CAST(trim(edge_text) AS DOUBLE)) AS BIGINT) AS ssn FROM edge_rows)""",
    "text_coercion": """
  SELECT task_refno, COALESCE(userdef100, 'None') AS LoanNumber, AmountRequested, SmallAPR, FinalTerm, InterestRate
  FROM task_detail""",
    "parse_dates": """
  SELECT o_orderkey,
    CASE WHEN o_totalprice < 5000 THEN 'not a date'
         WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%-m/%-d/%Y %-H:%M')
         WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(o_orderdate, '%-m/%-d/%Y') END AS date_text,
    CASE WHEN o_totalprice < 5000 THEN NULL ELSE o_orderdate END AS LEADDATE
  FROM file_rows""",
    "guess_dates": f"""
  SELECT o_orderkey, {", ".join(f"max({c}) AS {c}" for c in ("month_first", "day_first", "dotted", "many", "open", "two_kinds"))}
  FROM (
    SELECT o_orderkey, {", ".join(f"CASE WHEN l.column = '{c}' THEN CASE WHEN n_day_first > n_month_first THEN COALESCE(d, m) ELSE COALESCE(m, d) END END AS {c}" for c in ("month_first", "day_first", "dotted", "open", "two_kinds"))},
           CAST(NULL AS TIMESTAMP) AS many
    FROM date_long l JOIN date_counts USING ("column", separator)
    UNION ALL BY NAME
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN date_trunc('second', o_orderdate)
                            WHEN o_orderkey % 5 < 4 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS many
    FROM orders)
  GROUP BY o_orderkey""",
    "date_evidence": """
  SELECT *, n_day_first > n_month_first AS day_first, n_day_first > 0 AND n_month_first > 0 AS mixed,
         n_open > 0 AND n_day_first = n_month_first AS ambiguous
  FROM date_counts""",
    "int_fill": """
  SELECT o_orderkey, edge_text,
         COALESCE(TRY_CAST(trunc(TRY_CAST(trim(edge_text) AS DOUBLE)) AS INTEGER), 0) AS LEAD_SCORE FROM edge_rows""",
    "int_strict": """
  SELECT o_orderkey, edge_text,
         TRY_CAST(trunc(TRY_CAST(trim(edge_text) AS DOUBLE)) AS INTEGER) AS AMT_APPLIED FROM edge_rows""",
    "lead_projection": """
  SELECT ssn, PQ_DECISION, LEAD_TYPE, LEAD_STATE, CK_TRACKING_ID, LEADDATE,
         CAST(LEADDATE AS DATE) AS LEAD_DAY, 'lead' AS lead_app, 1 AS ISPQAPP FROM leads_daily""",
    "sentinel_to_null": """
  SELECT task_refno,
         CASE WHEN ReasonDeclined IS NOT NULL THEN COALESCE(userdef100, 'NULL')
              ELSE COALESCE(userdef100, 'None') END AS LoanNumber_text,
         userdef100 AS LoanNumber
  FROM task_detail""",
    "final_amount": "SELECT DISTINCT task_refno, LoanNumber, FinalLoanAmount FROM snapshot",
    "customer_type": "SELECT DISTINCT task_refno, CustomerType FROM snapshot",
    "score_parse": """
  SELECT cifno, userdef05,
    CASE WHEN userdef05 IS NULL OR length(rtrim(userdef05)) < 13 OR regexp_matches(userdef05, ' [a-zA-Z]') THEN 0
         WHEN strpos(userdef05, '.') > 0 THEN TRY_CAST(right(split_part(userdef05, '.', 1), 4) AS INTEGER)
    END AS CreditScore
  FROM cif_detail""",
    "row_max": "SELECT task_refno, greatest(SmallApprovedAmount, LargeApprovedAmount) AS AMT_APPROVED FROM task_detail",
    "fallback_offer": """
  SELECT task_refno,
    CASE WHEN LargeTerm > 0 THEN LargeTerm WHEN LargeTerm <= 0 THEN SmallTerm END AS TERM_DAILY,
    CASE WHEN LargeTerm > 0 THEN LargeTerm ELSE SmallTerm END AS TERM_WEEKLY,
    CASE WHEN LargeAPR > 0 THEN LargeAPR WHEN LargeAPR <= 0 THEN SmallAPR END AS RATE_DAILY,
    CASE WHEN LargeAPR > 0 THEN LargeAPR ELSE SmallAPR END AS RATE_WEEKLY
  FROM task_detail""",
    "cost_tier": f"""
  SELECT o_orderkey, AMOUNT_FUNDED,
    CASE WHEN AMOUNT_FUNDED > 2500 THEN 200 WHEN AMOUNT_FUNDED = 0 THEN 0
         WHEN AMOUNT_FUNDED <= 2500 THEN 125 ELSE 0 END AS COST_DAILY,
    CASE WHEN AMOUNT_FUNDED > 0 AND AMOUNT_FUNDED <= 2500 THEN 125
         WHEN AMOUNT_FUNDED > 2500 THEN 200 ELSE 0 END AS COST_WEEKLY
  FROM (SELECT o_orderkey,
          CASE WHEN o_totalprice < 30000 THEN CAST(0 AS DECIMAL(18,2))
               WHEN o_orderstatus = 'O' AND o_totalprice > 450000 THEN NULL
               WHEN o_orderstatus = 'P' THEN {money('c // 100 - 250000')}
               ELSE {money('c // 20')} END AS AMOUNT_FUNDED
        FROM ord)""",
    "date_floor": "SELECT ssn, task_refno, ApplicationEnterDate FROM apps_weekly",
    "funnel_daily": f"SELECT {FUNNEL_COLS} FROM funnel_daily",
    "funnel_weekly": f"SELECT {FUNNEL_COLS}, task_refno FROM funnel_weekly",
    "funnel_weekly_v2": f"SELECT {FUNNEL_COLS}, task_refno FROM funnel_weekly_v2",
    "funnel_weekly_intended": f"SELECT {FUNNEL_COLS}, task_refno FROM funnel_weekly_i_intended",
    "funnel_weekly_v2_intended": f"SELECT {FUNNEL_COLS}, task_refno FROM funnel_weekly_v2_i_intended",
    "before_lead_reset": """
  SELECT ssn, _pre AS APP_BEFORE, ApplicationEnterDate, FundedDate, AMT_APPROVED, TERM_APPROVED, AMOUNT_FUNDED
  FROM funnel_daily""",
    "funded_terms": "SELECT ssn, IS_FUNDED, TERM_FUNDED, RATE_FUNDED FROM funnel_daily",
    "application_snapshot": "SELECT * FROM snapshot",
    "application_snapshot_intended": "SELECT * FROM snapshot_intended",
    "funnel_daily_intended": f"SELECT {FUNNEL_COLS} FROM funnel_daily_intended",
    "borrower_semi_join": f"""
  SELECT SSNo, Cifno, {pad('SSNo')} AS ssn FROM borrower
  WHERE {pad('SSNo')} IN (SELECT ssn FROM persons_daily WHERE ssn IS NOT NULL)""",
    "left_join_left_pred": """
  SELECT ta.task_refno, ta.task_template_no, td.task_refno AS td_task_refno, td.userdef100
  FROM tmr t JOIN task ta ON t.parent_refno = ta.task_refno
       LEFT JOIN task_detail td ON ta.task_refno = td.task_refno AND ta.task_template_no = 1
  WHERE t.tmr_code_id = 1""",
    "coalesced_key_join": """
  SELECT ta.task_refno, td.userdef100, l.acctrefno
  FROM tmr t JOIN task ta ON t.parent_refno = ta.task_refno
       JOIN task_detail td ON td.task_refno = ta.task_refno
       LEFT JOIN (SELECT acctrefno, loan_number FROM loanacct
                  UNION ALL
                  SELECT CAST(-1 - r_regionkey AS BIGINT), CASE WHEN r_regionkey % 2 = 0 THEN '' END FROM region) l
         ON COALESCE(l.loan_number, '') = COALESCE(td.userdef100, '')
  WHERE t.tmr_code_id = 1""",
    "history_pivot": """
  SELECT k.task_refno,
    CASE WHEN pc.task_refno IS NULL THEN 'No' ELSE 'Yes' END AS WasCreditReportPulled,
    bk.booked_day AS FundedDate, ef.enter_day AS ApplicationEnterDate,
    ta.top_action AS LastAction, ta.top_result AS LastResult
  FROM (SELECT DISTINCT task_refno FROM trh) k
    LEFT JOIN pulled pc ON pc.task_refno = k.task_refno
    LEFT JOIN booked_last bk ON bk.task_refno = k.task_refno
    LEFT JOIN enter_first ef ON ef.task_refno = k.task_refno
    LEFT JOIN top_action ta ON ta.task_refno = k.task_refno""",
    "last_action_top1": """
  SELECT task_refno, action AS LastAction, result AS LastResult FROM (
    SELECT task_refno, action, result, row_number() OVER (PARTITION BY task_refno
           ORDER BY action DESC NULLS LAST, result DESC NULLS LAST) AS rn FROM hist) WHERE rn = 1""",
    "earliest_balance": """
  SELECT loannumber, netbalance FROM (
    SELECT loannumber, netbalance, row_number() OVER (PARTITION BY loannumber
           ORDER BY rundate NULLS FIRST, netbalance) AS rn FROM aged_balance) WHERE rn = 1""",
    "earliest_balance_all": f"""
  SELECT loannumber, netbalance FROM (
    SELECT 'LN' || CAST(l_orderkey AS VARCHAR) AS loannumber, {money(CENTS.format(x='l_extendedprice'))} AS netbalance,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_shipdate AS DATE) NULLS FIRST,
                              {money(CENTS.format(x='l_extendedprice'))}) AS rn FROM lineitem) WHERE rn = 1""",
    "blank_key_join": f"""
  SELECT DISTINCT l.task_refno, l.userdef100, r.loan_group_no
  FROM (SELECT o_orderkey AS task_refno,
               CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   '
                    WHEN 3 THEN 'LN' || CAST(o_orderkey % 5000 AS VARCHAR) || '  '
                    ELSE 'LN' || CAST(o_orderkey % 5000 AS VARCHAR) END AS userdef100
        FROM orders WHERE o_orderpriority IN {APP_PRIORITIES}) l
  LEFT JOIN (SELECT CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN ' '
                         WHEN 2 THEN 'LN' || CAST(o_orderkey % 5000 AS VARCHAR) || ' '
                         ELSE 'LN' || CAST(o_orderkey % 5000 AS VARCHAR) END AS loan_number,
                    CAST(CASE WHEN o_orderkey % 11 < 2 THEN o_orderkey % 3 ELSE o_orderkey % 100 END AS INTEGER) AS loan_group_no
             FROM orders WHERE o_orderstatus = 'F') r
    ON rtrim(COALESCE(r.loan_number, ''), ' ') = rtrim(COALESCE(l.userdef100, ''), ' ')""",
    "match_merge_positional": f"""
  SELECT * FROM (WITH l AS (SELECT *, row_number() OVER (PARTITION BY ssn ORDER BY lead_key) AS i, count(*) OVER (PARTITION BY ssn) AS m
             FROM (SELECT CASE WHEN o_custkey % 50 <> 0 THEN o_custkey END AS ssn, o_orderkey AS lead_key, o_orderdate AS seen
                   FROM orders WHERE o_orderpriority IN {LEAD_PRIORITIES})),
       r AS (SELECT *, row_number() OVER (PARTITION BY ssn ORDER BY seen, app_key) AS i, count(*) OVER (PARTITION BY ssn) AS n
             FROM (SELECT CASE WHEN o_custkey % 50 <> 0 THEN o_custkey END AS ssn, o_orderkey AS app_key, o_orderdate AS seen
                   FROM orders WHERE o_orderpriority IN {APP_PRIORITIES})),
       g AS (SELECT a.ssn, a.m, COALESCE(b.n, 0) AS n FROM (SELECT DISTINCT ssn, m FROM l) a
             LEFT JOIN (SELECT DISTINCT ssn, n FROM r) b ON a.ssn IS NOT DISTINCT FROM b.ssn),
       p AS (SELECT ssn, m, n, unnest(range(1, CAST(greatest(m, n) AS BIGINT) + 1)) AS i FROM g)
  SELECT p.ssn, l.lead_key, CASE WHEN p.i <= p.n THEN r.seen ELSE l.seen END AS seen, r.app_key
  FROM p JOIN l ON l.ssn IS NOT DISTINCT FROM p.ssn AND l.i = least(p.i, p.m)
         LEFT JOIN r ON r.ssn IS NOT DISTINCT FROM p.ssn AND r.i = least(p.i, p.n))""",
    "best_lead_weekly_file_order": """
  SELECT ssn, CK_TRACKING_ID, LEAD_SCORE FROM (
    SELECT o_custkey AS ssn, sub_id AS CK_TRACKING_ID, CAST(600 + o_orderkey % 3 AS INTEGER) AS LEAD_SCORE,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 3 DESC,
                              date_trunc('month', o_orderdate), o_orderkey DESC) AS rn
    FROM file_rows) WHERE rn = 1""",
    "status_codes": "SELECT acctrefno, statflags FROM statflags",
    "lead_app_join": """
  SELECT l.ssn, l.CK_TRACKING_ID, a.task_refno, a.ApplicationEnterDate
  FROM best_daily l LEFT JOIN apps_daily a ON l.ssn = a.ssn""",
    "match_merge": "SELECT ssn, CK_TRACKING_ID, task_refno, CustomerType FROM merged_weekly",
    "best_lead_daily": "SELECT ssn, CK_TRACKING_ID, LEADDATE, LEAD_SCORE, AMT_APPLIED, PQ_DECISION FROM best_daily",
    "best_lead_weekly": "SELECT ssn, CK_TRACKING_ID, LEADDATE, LEAD_SCORE, AMT_APPLIED, LEAD_PREQUAL FROM best_weekly",
    "latest_app": "SELECT ssn, task_refno, ApplicationEnterDate, CustomerType FROM apps_daily",
    "sticky_prequal": """
  SELECT ssn, task_refno, CustomerType, LoanStatus, StatusCodes, IS_APPL, IS_PREQUAL FROM funnel_rows_weekly""",
    "best_outcome": """
  SELECT ssn, task_refno, APP_BEFORE_LEAD, IS_FUNDED, IS_APPROVE, ApplicationEnterDate FROM funnel_weekly""",
    "best_outcome_intended": """
  SELECT ssn, task_refno, APP_BEFORE_LEAD, IS_FUNDED, IS_APPROVE, ApplicationEnterDate
  FROM funnel_weekly_intended""",
    "partner_feed": f"SELECT {FEED_COLS} FROM funnel_daily",
    "feed_text_daily": f"SELECT {_feed_text('%Y-%m-%d', True, ' %H:%M:%S')} FROM funnel_daily",
    "feed_text_weekly": f"SELECT {_feed_text('%m/%d/%Y', False, '').replace('AS FundedDate', 'AS FUNDDATE')} FROM funnel_weekly",
    "feed_text_weekly_v2": f"SELECT {_feed_text('%m/%d/%Y', False, '')} FROM funnel_weekly_v2",
    "daily_summary": f"""
  SELECT CAST(LEADDATE AS DATE) AS LEADDATE, {SUMMARY_AGGS}
  FROM funnel_weekly WHERE LEADDATE IS NOT NULL GROUP BY CAST(LEADDATE AS DATE)""",
    "daily_summary_corrected": f"""
  SELECT CAST(LEADDATE AS DATE) AS LEADDATE, {SUMMARY_AGGS}
  FROM funnel_daily WHERE LEADDATE IS NOT NULL GROUP BY CAST(LEADDATE AS DATE)""",
    "best_lead_incremental": "SELECT ssn, CK_TRACKING_ID, LEADDATE, LEAD_SCORE, AMT_APPLIED, PQ_DECISION FROM best_daily",
    "daily_summary_total": f"""
  SELECT d AS LEADDATE, {SUMMARY_AGGS}, CAST(GROUPING(d) AS INTEGER) AS IS_TOTAL
  FROM (SELECT *, CAST(LEADDATE AS DATE) AS d FROM funnel_weekly WHERE LEADDATE IS NOT NULL)
  GROUP BY ROLLUP (d)""",
    "weekly_summary": f"""
  SELECT LEAD_WEEK, IS_TOTAL, NUM_LEADS, NUM_PQ, NUM_APPS, NUM_APPR, NUM_BOOKED, DOLLARS_BOOKED, LEAD_COST,
    {_ratio('NUM_PQ', 'NUM_LEADS')} AS PQ_RATE, {_ratio('NUM_APPS', 'NUM_PQ')} AS APP_RATE,
    {_ratio('NUM_APPR', 'NUM_APPS')} AS APPROVAL_RATE, {_ratio('NUM_BOOKED', 'NUM_APPR')} AS BOOKING_RATE,
    {_ratio('LEAD_COST', 'NUM_BOOKED')} AS COST_PER_BOOKED
  FROM (SELECT w AS LEAD_WEEK, CAST(GROUPING(w) AS INTEGER) AS IS_TOTAL, {SUMMARY_AGGS}
        FROM (SELECT *, CAST(date_trunc('week', LEADDATE) AS DATE) AS w FROM funnel_weekly WHERE LEADDATE IS NOT NULL)
        GROUP BY ROLLUP (w))""",
    "funnel_frequency": f"""
  SELECT {FLAGS}, Funnel, Funnel * 100.0 / total AS Percent, cum AS Cumulative_Frequency,
         cum * 100.0 / total AS Cumulative_Percent
  FROM (SELECT {FLAGS}, Funnel, sum(Funnel) OVER () AS total,
               sum(Funnel) OVER (ORDER BY {FLAGS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
        FROM (SELECT {FLAGS}, count(*) AS Funnel FROM funnel_daily GROUP BY ALL))""",
    "funnel_frequency_weekly": f"""
  SELECT {FLAGS}, Funnel, Funnel * 100.0 / total AS Percent, cum AS Cumulative_Frequency,
         cum * 100.0 / total AS Cumulative_Percent
  FROM (SELECT {FLAGS}, Funnel, sum(Funnel) OVER () AS total,
               sum(Funnel) OVER (ORDER BY {FLAGS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
        FROM (SELECT {FLAGS}, count(*) AS Funnel FROM funnel_weekly GROUP BY ALL))""",
    "funnel_gaps": f"""
  SELECT {FLAGS}, GAP, count(*) AS Funnel FROM (
    SELECT *, CASE WHEN ISPQAPP = 0 AND IS_PREQUAL = 1 THEN 'IS_PREQUAL without ISPQAPP'
                   WHEN IS_PREQUAL = 0 AND IS_APPL = 1 THEN 'IS_APPL without IS_PREQUAL'
                   WHEN IS_APPL = 0 AND IS_APPROVE = 1 THEN 'IS_APPROVE without IS_APPL'
                   WHEN IS_APPROVE = 0 AND IS_FUNDED = 1 THEN 'IS_FUNDED without IS_APPROVE' END AS GAP
    FROM funnel_daily) WHERE GAP IS NOT NULL GROUP BY ALL""",
}



def oracle_sql() -> dict[str, str]:
    return {k: with_ctes(v) for k, v in SELECTS.items()}
