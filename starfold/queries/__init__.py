"""All registered queries. Importing the modules registers them."""

from starfold.queries import aggregates, builds, files, joins, scalars, tables  # noqa: F401
from starfold.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
