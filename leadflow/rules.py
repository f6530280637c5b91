"""Funnel rule profiles and the fixed values the rules compare against."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's literals for the same results).
# ---------------------------------------------------------------------------
AUTO_APPROVED = "Auto Approved"
STATUS_FUNDED = "FUNDED"
STATUS_ELIGIBLE = "ELIGIBLE"
APPROVED_STATUSES = (STATUS_FUNDED, STATUS_ELIGIBLE)
ACTION_ENTER_APPLICATION = "ENTER APPLICATION DATA"
ACTION_BOOK_LOAN = "BOOK LOAN"
ACTION_PULL_CREDIT = "PULL CREDIT REPORT"
RESULT_YES = "yes"
LOAN_NUMBER_CLOSED_BRANCH = "CLOSE BRANCH"
EXCLUDED_LOAN_GROUP = 6
DEFAULT_LOAN_GROUP = 1
CUSTOMER_TYPE_ACTION_ID = 2
CUSTOMER_TYPE_BY_RESULT_ID = ((2, "FB"), (3, "NB"), (28, "PB"), (32, "PB"))
INTEREST_METHODS_PRECOMPUTED = ("7S", "78", "FA")
INTEREST_METHOD_SIMPLE = "SI"
AMOUNT_TEXT_KEEP_CHARS = 9
SCORE_MIN_LENGTH = 13
SCORE_DIGITS = 4
PERSON_KEY_WIDTH = 9
COST_BREAK = 2500
COST_LOW = 125
COST_HIGH = 200
WEEKLY_APP_DATE_FLOOR = _dt.date(2018, 1, 1)
# pandas read_csv's default missing-value strings (daily program's reader)
PANDAS_MISSING_TEXT = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN",
                       "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
                       "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
FEED_COLUMNS = ("CK_TRACKING_ID", "LEADDATE", "ApplicationEnterDate",
                "FundedDate", "ISPQAPP", "IS_PREQUAL", "IS_APPL",
                "IS_APPROVE", "IS_FUNDED", "AMT_APPLIED", "AMT_APPROVED",
                "TERM_APPROVED", "RATE_APPROVED", "AMOUNT_FUNDED",
                "TERM_FUNDED", "RATE_FUNDED")
FUNNEL_FLAGS = ("ISPQAPP", "IS_PREQUAL", "IS_APPL", "IS_APPROVE", "IS_FUNDED")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class FunnelRules:
    """Everything that differs between the three reference programs.

    ``mode='faithful'`` reproduces the programs as written; ``'intended'``
    changes exactly the five points documented in the README.
    """

    name: str
    partner: str | None            # lead partner filter; None = no filter
    person_key: str                # 'text' (9-char text), 'number', or
                                   # 'number_text' (a number written as 9-char text)
    lead_order: str                # 'latest' (daily) or 'score' (weekly)
    sas: bool                      # SAS data step: lead time cut to a day, missing
                                   # values smallest, apps merged one to many
    loan_number_none: tuple        # loan-number texts meaning "no loan"
    not_declined: str | None       # decline-reason text meaning "not declined"
    null_text: str | None          # how the app workbook spells a missing text
    funded_date_text: bool         # funded date arrives as MM/DD/YYYY text
    app_date_floor: _dt.date | None
    feed_date_format: str          # dates of the delivered feed
    feed_numbers: str              # 'two_decimals' or 'shortest'
    funded_date_name: str          # the feed's name of the funded date
    mode: str = "faithful"

    def with_mode(self, mode: str) -> "FunnelRules":
        if mode not in ("faithful", "intended"):
            raise ValueError(mode)
        return replace(self, mode=mode)

    def with_partner(self, partner: str | None) -> "FunnelRules":
        return replace(self, partner=partner)

    def with_floor(self, floor: _dt.date | None) -> "FunnelRules":
        return replace(self, app_date_floor=floor)


DAILY = FunnelRules(
    name="daily", partner="CreditPartner", person_key="text",
    lead_order="latest", sas=False,
    loan_number_none=(), not_declined=None, null_text="None",
    funded_date_text=False, app_date_floor=None, feed_date_format="yyyy-MM-dd",
    feed_numbers="two_decimals", funded_date_name="FundedDate")

WEEKLY = FunnelRules(
    name="weekly", partner=None, person_key="number",
    lead_order="score", sas=True,
    loan_number_none=("NULL", ""), not_declined="NULL", null_text="NULL",
    funded_date_text=True, app_date_floor=WEEKLY_APP_DATE_FLOOR,
    feed_date_format="MM/dd/yyyy", feed_numbers="shortest", funded_date_name="FUNDDATE")

WEEKLY_V2 = replace(
    WEEKLY, name="weekly_v2", partner="CreditPartner",
    person_key="number_text", loan_number_none=("None", ""), not_declined="",
    null_text="None", funded_date_text=False, funded_date_name="FundedDate")

PROFILES = {p.name: p for p in (DAILY, WEEKLY, WEEKLY_V2)}
