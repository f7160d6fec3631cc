"""Decision and risk columns of a predicted probability."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decision cut and upper ends of the LOW and MEDIUM levels, in percent.
DECISION_CUT = 0.5
LOW_BELOW = 40
MEDIUM_BELOW = 60
RISK_LEVELS = ("LOW", "MEDIUM", "HIGH")


def percent(prob: Column) -> Column:
    return prob * 100


def risk_level(pct: Column) -> Column:
    """Risk level of an unrounded percentage."""
    return (
        F.when(pct < LOW_BELOW, "LOW").when(pct < MEDIUM_BELOW, "MEDIUM").otherwise("HIGH")
    )


def decision_columns(prob: Column) -> dict[str, Column]:
    """All output columns derived from the probability of leaving (a fraction 0-1)."""
    return {
        "will_leave": prob >= DECISION_CUT,
        "probability_leave": F.round(percent(prob), 2),
        "probability_stay": F.round(percent(1 - prob), 2),
        "risk_level": risk_level(percent(prob)),
    }
