"""All registered queries."""

from tidecast.plans import catalog_models, catalog_series, catalog_sources  # noqa: F401
from tidecast.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
