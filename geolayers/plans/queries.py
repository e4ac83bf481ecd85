"""All registered queries."""

from geolayers.plans import catalog, changes, columns, host, predicates, spatial, values  # noqa: F401
from geolayers.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
