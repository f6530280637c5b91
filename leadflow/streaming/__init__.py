"""Incremental pick-up of new lead files (A10)."""

from leadflow.streaming.best import BestLeads
from leadflow.streaming.commits import CommitLog
from leadflow.streaming.ingest import best_leads_from_history, ingest_lead_files, read_history

__all__ = ["ingest_lead_files", "read_history", "best_leads_from_history", "BestLeads", "CommitLog"]
