"""Every operator run on the given tables, next to the SQL that gives the same rows."""

from marketlake.verification import (  # noqa: F401
    aggregates,
    joins,
    learning,
    products,
    projections,
    scalars,
    sources,
)
from marketlake.verification.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
