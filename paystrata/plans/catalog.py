"""All registered queries."""

from paystrata.plans import insight_queries, load_queries, report_queries, text_queries  # noqa: F401
from paystrata.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
