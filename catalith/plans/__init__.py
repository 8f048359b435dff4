"""End-to-end jobs and the registered queries."""

from catalith.plans import (  # noqa: F401  (each import registers its queries)
    classifying, combining, enriching, extracting, loading, normalise, searching,
)
from catalith.plans.registry import QUERIES  # noqa: F401
