"""fundlens: aid-funding analytics as lazy PySpark DataFrame operators.

Read and profile funding, needs, population and response-plan tables,
standardize them to common (country, cluster, year) keys, join them and
derive per-appeal features, with quality reports and table sinks.

Main entry points::

    from fundlens import build_features, feature_stages, ingest, feature_pipeline
"""

from fundlens.plans.features import build_features, build_features_from_raw, feature_stages
from fundlens.plans.workflows import feature_pipeline, ingest, profile_datasets

__version__ = "0.1.0"

__all__ = [
    "build_features",
    "build_features_from_raw",
    "feature_pipeline",
    "feature_stages",
    "ingest",
    "profile_datasets",
]
