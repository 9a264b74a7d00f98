"""Incident-report analytics on Spark DataFrames."""

from blotterflow.config import DEFAULT, PipelineConfig
from blotterflow.session import build_session, shared_dir

__all__ = ["DEFAULT", "PipelineConfig", "build_session", "shared_dir"]
