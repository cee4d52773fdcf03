"""Queries over the driver's tables, each with an equivalent SQL text.

The energy model is laid over the given tables: nation = state, customer =
county, order = building, market segment or priority = technology group,
return flag = end use, line status = fuel, ``events`` = hourly series.
"""

# Importing a module fills the registry.
from wattloom.registry import (  # noqa: F401
    annual,
    cascade,
    catalogue,
    checks,
    extracts,
    files,
    hourly,
    publication,
    scenarios,
    storage,
)
from wattloom.registry.core import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
