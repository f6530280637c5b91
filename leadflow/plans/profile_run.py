"""One profile end to end: leads -> applications -> funnel.

Everything is lazy; each function returns a DataFrame whose plan Catalyst
optimises as a whole.  ``Run`` memoises the intermediate DataFrames (plans,
not data) so reports of one run share one lineage.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow import rules as R
from leadflow.functions import canonical_id
from leadflow.operators import stage
from leadflow.operators.stage import drop_scope
from leadflow.plans.applications import application_snapshot
from leadflow.plans.funnel import (funnel_daily, funnel_weekly, weekly_apps,
                                   weekly_apps_of)
from leadflow.plans.leads import (Guesses, best_leads, lead_keys,
                                  typed_leads)
from leadflow.sources.servicing import Servicing
from leadflow.sources.standins import (APP_DATE_FLOOR, normalised_lead_rows,
                                       stand_in_servicing)
from leadflow.sources.tables import Tables


class Run:
    def __init__(self, spark: SparkSession, sf_dir: str, profile: str = "daily",
                 mode: str = "faithful", raw_leads: DataFrame | None = None,
                 rules: R.FunnelRules | None = None, snapshot: DataFrame | None = None,
                 servicing: Servicing | None = None, apps: DataFrame | None = None,
                 guesses: Guesses | None = None):
        """``servicing``: the loan-servicing relations, by default the stand-ins
        of ``sf_dir``; ``snapshot``: application rows written earlier; ``apps``:
        application rows of an apps file (weekly profiles); ``guesses``: how
        the leads' dates are read."""
        self.spark, self.sf_dir = spark, sf_dir
        self.tables = Tables(spark, sf_dir)
        self.scope = uuid.uuid4().hex[:12]
        self.srv = (servicing or stand_in_servicing(self.tables)).in_scope(self.scope)
        base = rules or R.PROFILES[profile]
        if rules is None and raw_leads is None and base.app_date_floor is not None:
            base = base.with_floor(APP_DATE_FLOOR)   # stand-in data (see standins)
        self.rules = base.with_mode(mode)
        self._raw, self._guesses = raw_leads, guesses
        self._snapshot, self._apps = snapshot, apps

    @cached_property
    def raw_leads(self) -> DataFrame:
        return self._raw if self._raw is not None else normalised_lead_rows(self.tables)

    @cached_property
    def leads(self) -> DataFrame:
        return typed_leads(self.raw_leads, self.rules, self._guesses)

    @cached_property
    def best_leads(self) -> DataFrame:
        """One row per lead person, staged once: the person keys and the final
        join read it, the weekly match-merge in three parts."""
        best = best_leads(self.leads, self.rules)
        return stage(best, f"best_leads_{self.rules.name}", self.scope)

    @cached_property
    def persons(self) -> DataFrame:
        keys = lead_keys(self.best_leads)
        if self.rules.person_key == "number":
            keys = keys.select(canonical_id(F.col("ssn").cast("string")).alias("ssn"))
        return keys

    @cached_property
    def snapshot(self) -> DataFrame:
        if self._snapshot is not None:
            return self._snapshot
        return application_snapshot(self.srv, self.persons, self.rules.mode)

    @cached_property
    def snapshot_rows(self) -> DataFrame:
        """The snapshot without its whole-row DISTINCT: enough for the
        funnel, which keeps one row per person by a total order."""
        if self._snapshot is not None:
            return self._snapshot
        return application_snapshot(self.srv, self.persons, self.rules.mode, distinct=False)

    @cached_property
    def apps(self) -> DataFrame:
        """daily: the snapshot.  weekly: the apps table as the weekly program
        reads it, staged - the match-merge splits it by null key and the
        carry-over joins back to it, so it is read several times."""
        if not self.rules.sas:
            return self.snapshot
        if self._apps is not None:
            return stage(weekly_apps_of(self._apps, self.rules), f"apps_{self.rules.name}", self.scope)
        return stage(weekly_apps(self.snapshot, self.rules), f"apps_{self.rules.name}", self.scope)

    @cached_property
    def funnel(self) -> DataFrame:
        if not self.rules.sas:
            return funnel_daily(self.best_leads, self.snapshot_rows, self.rules.mode)
        return funnel_weekly(self.best_leads, self.apps, self.rules)

    @cached_property
    def staged_funnel(self) -> DataFrame:
        """The funnel written once, for several reports of it."""
        return stage(self.funnel, f"funnel_{self.rules.name}", self.scope)

    def with_snapshot(self, snapshot: DataFrame) -> Run:
        """This run on application rows written earlier: same leads, same
        staging scope."""
        other = Run(self.spark, self.sf_dir, mode=self.rules.mode, raw_leads=self.raw_leads, rules=self.rules,
                    snapshot=snapshot, servicing=self.srv, guesses=self._guesses)
        other.scope = self.scope
        other.best_leads = self.best_leads          # staged already
        return other

    def cleanup(self) -> None:
        """Delete this run's staged tables.  Call it only after every
        DataFrame of the run has been written or collected."""
        drop_scope(self.spark, self.scope)
