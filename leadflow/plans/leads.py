"""Lead typing and best-lead selection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow import rules as R
from leadflow.functions import (canonical_id, canonical_id_numeric, col_,
                                int_fill, int_strict, parse_dates, sas_text,
                                to_double)
from leadflow.functions.dates import DateGuess
from leadflow.operators import best_per_key
from leadflow.sources.files import ORDER_COL

TEXT_COLUMNS = ("irpid", "application_number", "applicant_ssn",
                "applicant_address_zip", "app._cell_phone")


def partner_filter(df: DataFrame, partner: str | None) -> DataFrame:
    """Keep one partner's rows (null partner drops); right after the
    scan so it is pushed into parquet sources."""
    return df if partner is None else df.filter(F.col("irmpname") == F.lit(partner))


def person_key(rules: R.FunnelRules) -> Column:
    """B2/B2n: the lead's person key as its profile reads it.  ``number_text``
    parses a number and writes it with 9 digits: text that is no number is a
    missing key, a number of more digits keeps them all."""
    number = canonical_id_numeric("applicant_ssn")
    return {"text": canonical_id("applicant_ssn"), "number": number,
            "number_text": canonical_id(number)}[rules.person_key]


DATE_COLUMNS = ("application_date", "decision_date/time")
Guesses = Mapping[str, DateGuess]


def _date(name: str, guesses: Guesses | None) -> Column:
    return guesses[name].parse() if guesses and name in guesses else parse_dates(name)


def lead_rejects(raw: DataFrame, rules: R.FunnelRules, guesses: Guesses | None = None) -> DataFrame:
    """The partner's lead rows that a profile cannot use as they are, with a
    ``reject_reason``: no person key, an amount that is no number, or a date
    that cannot be read."""
    df = partner_filter(raw, rules.partner)
    amount = col_("amt._fin.").cast("string")
    reason = F.when(person_key(rules).isNull(), F.lit("no person key")).when(
        (F.trim(amount) != "") & int_strict("amt._fin.").isNull(), F.lit("amount is not a number"))
    for name in DATE_COLUMNS:
        text = F.trim(col_(name).cast("string"))
        reason = reason.when((text != "") & _date(name, guesses).isNull(), F.lit(f"{name} is not a date"))
    return df.withColumn("reject_reason", reason).filter(F.col("reject_reason").isNotNull())


def typed_leads(raw: DataFrame, rules: R.FunnelRules, guesses: Guesses | None = None) -> DataFrame:
    """Normalised lead text columns -> typed lead rows of one profile.
    ``guesses``: how its date columns are read (``guess_dates``), else by the
    named formats."""
    df = partner_filter(raw, rules.partner)
    key = person_key(rules)
    lead_ts = _date("application_date", guesses)
    keep = [col_(c).cast("string").alias(c) for c in TEXT_COLUMNS if c in raw.columns]
    if not rules.sas:
        score = int_fill("applicant_credit_score")
        amount = int_strict("amt._fin.")
        lead_date = lead_ts
    else:
        score = int_strict("applicant_credit_score")
        amount = to_double("amt._fin.")
        lead_date = F.to_date(lead_ts)
    pq = F.col("decision_status")
    out = df.select(
        key.alias("ssn"),
        *keep,
        pq.alias("PQ_DECISION"),
        col_("loan_type").alias("LEAD_TYPE"),
        col_("applicant_address_state").alias("LEAD_STATE"),
        col_("sub_id").alias("CK_TRACKING_ID"),
        lead_date.alias("LEADDATE"),
        _date("decision_date/time", guesses).alias("DECISION_TS"),
        score.alias("LEAD_SCORE"),
        amount.alias("AMT_APPLIED"),
        F.lit("lead").alias("lead_app"),
        *[F.col(c) for c in (ORDER_COL,) if c in raw.columns],
    )
    if rules.sas:
        out = out.withColumn(
            "LEAD_PREQUAL", (sas_text("PQ_DECISION") == R.AUTO_APPROVED).cast("int"))
    return out


def lead_order(rules: R.FunnelRules, columns, batch: str | None = None) -> list[Column]:
    """E1 (daily): latest lead time, then highest score.
    E2 (weekly): highest score; ties keep the order of the input, the place by
    file and line (``read_lead_files(with_order=True)``, after ``batch`` where
    leads come in batches), or where leads have none the tracking id.  Missing
    values sort last in both (pandas na_position, SAS DESCENDING)."""
    tie = [F.col("AMT_APPLIED").desc_nulls_last(), F.col("CK_TRACKING_ID").asc_nulls_last()]
    if rules.lead_order == "latest":
        return [F.col("LEADDATE").desc_nulls_last(), F.col("LEAD_SCORE").desc_nulls_last(), *tie]
    score = F.col("LEAD_SCORE").desc_nulls_last()
    if ORDER_COL not in columns:
        return [score, F.col("CK_TRACKING_ID").asc_nulls_last()]
    return [score, *[F.col(c).asc() for c in (batch, ORDER_COL) if c in columns]]


def best_leads(leads: DataFrame, rules: R.FunnelRules) -> DataFrame:
    """The best lead of each person by ``lead_order``."""
    return best_per_key(leads, ["ssn"], lead_order(rules, leads.columns)).drop(ORDER_COL)


def lead_keys(best: DataFrame) -> DataFrame:
    """Distinct person keys of the chosen leads (null keys are quarantined)."""
    return best.select("ssn").filter(F.col("ssn").isNotNull())
