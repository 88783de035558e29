"""All registered queries; importing the modules fills the registry."""

from tidewatch.plans import (  # noqa: F401
    feature_queries, model_queries, monitoring_queries, quality_queries, stream_queries,
)
from tidewatch.plans.registry import ORACLES, QUERIES  # noqa: F401
