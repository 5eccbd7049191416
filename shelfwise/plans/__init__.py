"""Registered plans (queries with their SQL oracles)."""

from . import ingest_plans  # noqa: F401  (registers the ingest plans)
from .registry import PLANS

__all__ = ["PLANS"]
