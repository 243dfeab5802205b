"""All registered queries."""

from plumbline.plans import (  # noqa: F401
    catalog_features,
    catalog_metrics,
    catalog_models,
    catalog_profile,
    catalog_runs,
    catalog_series,
    catalog_sources,
    catalog_streams,
)
from plumbline.plans.registry import QUERIES

__all__ = ["QUERIES"]
