"""Derived session features."""

from __future__ import annotations

# The guard of the ratio denominators and the five derived features.
EPSILON = "1e-6D"

FEATURE_SQL = {
    "TotalPages": "Administrative + Informational + ProductRelated",
    "TotalDuration": "Administrative_Duration + Informational_Duration + ProductRelated_Duration",
    "AvgDurationPerPage": f"TotalDuration / (TotalPages + {EPSILON})",
    "ProductPageRatio": f"ProductRelated / (TotalPages + {EPSILON})",
    "BounceExitDelta": "ExitRates - BounceRates",
}

DERIVED_FROM = (
    "Administrative", "Administrative_Duration", "Informational", "Informational_Duration",
    "ProductRelated", "ProductRelated_Duration", "BounceRates", "ExitRates",
)


def feature_exprs() -> list[str]:
    """SELECT items adding the derived features (later ones use earlier ones)."""
    return ["*", *[f"CAST({sql} AS DOUBLE) AS {name}" for name, sql in FEATURE_SQL.items()]]
