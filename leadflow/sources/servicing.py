"""The loan-servicing relations as one interface."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Servicing:
    """Twelve data relations and four code tables, each a DataFrame.

    Any source of DataFrames will do: tables of a catalog, Parquet folders
    (``from_folder``), Spark's JDBC reader, or the stand-ins derived from the
    driver's tables.  ``scope`` names the staging scope of the run that uses
    them."""

    cif: DataFrame                    # cifno, firstname1, lastname1
    borrower: DataFrame               # SSNo, Cifno
    cif_detail: DataFrame             # cifno, userdef05
    tmr: DataFrame                    # tmr_code_id, child_refno, parent_refno
    task: DataFrame                   # task_refno, task_template_no, status_code_id
    task_detail: DataFrame            # task_refno, userdef04 ... userdef100
    loanacct: DataFrame               # acctrefno, loan_number, loan_group_no, ...
    loanacct_detail: DataFrame        # acctrefno, userdef11
    loanacct_setup: DataFrame         # acctrefno, interest_method
    loanacct_statuses: DataFrame      # acctrefno, status_code_no
    task_routing_history: DataFrame   # task_refno, workflow_action_id, workflow_result_id, created_date
    aged_balance: DataFrame           # loannumber, netbalance, rundate
    task_status_codes: DataFrame      # status_code_id, status_code
    workflow_action: DataFrame        # workflow_action_id, action
    workflow_result: DataFrame        # workflow_result_id, result
    loan_status_codes: DataFrame      # status_code_no, status_code
    scope: str | None = None

    @classmethod
    def relations(cls) -> list[str]:
        return [f.name for f in fields(cls) if f.name != "scope"]

    @classmethod
    def from_folder(cls, spark: SparkSession, folder: str) -> Servicing:
        """One Parquet folder per relation, named like the fields."""
        return cls(**{n: spark.read.parquet(f"{folder.rstrip('/')}/{n}") for n in cls.relations()})

    def in_scope(self, scope: str | None) -> Servicing:
        return replace(self, scope=scope)
