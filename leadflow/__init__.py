"""leadflow: lead-to-loan funnel analytics on Spark DataFrames.

Layers (each a function DataFrame -> DataFrame, composed lazily into one
Catalyst plan; only sinks trigger work):

* ``functions``  - pure Column expressions (key padding, sentinel handling,
  date parsing, amount/score parsing, funnel flag rules).
* ``sources``    - drop-folder and lenient CSV readers, table loading, and the
  stand-in servicing relations derived from the driver tables.
* ``operators``  - reusable relational building blocks (best-row-per-key,
  history pivot, coalesced-key join with hot-key split, carry-over flags).
* ``plans``      - the end-to-end plans: leads, application snapshot,
  funnel per profile, reports and sinks.
* ``streaming``  - incremental pick-up of new lead files.
"""

from leadflow.rules import PROFILES, FunnelRules

__all__ = ["PROFILES", "FunnelRules"]
