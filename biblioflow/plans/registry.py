"""Registry of the bibliographic queries and their DuckDB twins."""

from biblioflow.plans import primitives  # noqa: F401  registers its queries
from biblioflow.plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
