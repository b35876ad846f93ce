"""Queries over the driver's tables and the SQL each must agree with."""

from loomhouse.bindings import (  # noqa: F401  (register on import)
    dimensions,
    facts,
    graph,
    history,
    keys,
    scripts,
    staging,
)
from loomhouse.bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
