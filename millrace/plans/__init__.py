"""Registered queries. Importing a module here adds its queries."""

from millrace.plans.registry import ORACLES, QUERIES
from millrace.plans import aggregation, analytic, documents, relational, storage, streams, text  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
