"""Batch ingestion and analysis of measurement tables on Spark DataFrames."""

from gaugeworks.plans.analysis import run_analysis
from gaugeworks.plans.ingest import run_ingest
from gaugeworks.session import build_session
from gaugeworks.sources.spec import RuleSet, SourceSpec

__all__ = ["RuleSet", "SourceSpec", "build_session", "run_analysis", "run_ingest"]
