"""All registered queries: importing this module registers every query family."""

from __future__ import annotations

from marketlake.plans import queries_core  # noqa: F401  (silver, gold, marts)
from marketlake.plans import queries_ops  # noqa: F401  (filters, cleaning, DQ, joins, aggs, windows)
from marketlake.plans import queries_adhoc  # noqa: F401  (reports, notebook analytics)
from marketlake.plans import queries_sources  # noqa: F401  (sources, sinks, FIL-9, DQ-7)
from marketlake.plans import queries_ml  # noqa: F401  (ML jobs)
from marketlake.plans import queries_lake  # noqa: F401  (contracts, load metrics, incremental marts)
from marketlake.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
