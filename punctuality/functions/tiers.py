"""Departure-delay tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuality.schemas import HIGH_BOUND, LOW_BOUND

CANCELLED = "CANCELLED"
LOW, MEDIUM, HIGH = "LOW", "MEDIUM", "HIGH"


def is_cancelled(cancelled: str = "cancelled") -> Column:
    """A null ``cancelled`` counts as not cancelled."""
    return F.coalesce(F.col(cancelled), F.lit(0)) == 1


def delay_tier(
    dep_delay: str = "dep_delay",
    cancelled: str = "cancelled",
    low: float = LOW_BOUND,
    high: float = HIGH_BOUND,
) -> Column:
    """CANCELLED / LOW (0 < d < low) / MEDIUM (low <= d <= high) / HIGH (d > high).

    A departure that is null or not late (d <= 0) gets no tier (null); the
    row still belongs to its group and still contributes its causes.
    """
    d = F.col(dep_delay)
    return (
        F.when(is_cancelled(cancelled), F.lit(CANCELLED))
        .when((d > 0) & (d < low), F.lit(LOW))
        .when((d >= low) & (d <= high), F.lit(MEDIUM))
        .when(d > high, F.lit(HIGH))
    )


def with_delay_tier(df: DataFrame, name: str = "tier", **kw) -> DataFrame:
    return df.withColumn(name, delay_tier(**kw))
