"""Deskwright: service-desk ticket quality checks as Spark DataFrame operations."""

from deskwright.operators.classify import classify, evaluate
from deskwright.plans.batch import run_export
from deskwright.rules import QualityRules
from deskwright.sources.readers import read_tickets
from deskwright.streaming.ingest import run_stream

__all__ = ["QualityRules", "classify", "evaluate", "read_tickets", "run_export", "run_stream"]
