"""All registered queries."""

from . import queries_factor, queries_features, queries_prepare, queries_recommend, queries_report, queries_sources  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
