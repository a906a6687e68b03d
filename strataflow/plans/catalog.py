"""All registered queries. Importing the query modules registers them."""

from strataflow.plans import queries_landing, queries_monitoring, queries_quality, queries_star  # noqa: F401
from strataflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
