"""All registered queries."""

from seriesloom.plans import ctes  # noqa: F401  (definitions come first)
from seriesloom.plans import cat_aggregate, cat_cluster, cat_models, cat_panel, cat_score, cat_sources, cat_window  # noqa: F401
from seriesloom.plans.registry import QUERIES, SQL  # noqa: I001

__all__ = ["QUERIES", "SQL"]
