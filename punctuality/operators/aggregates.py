"""Grouped profiles: carrier x airport and airport x month tiers.

Both are single hash aggregations whose buffers are fixed-width numbers,
so Spark runs them as code-generated partial + final aggregates: each map
task combines its rows first, and only one row per group and task crosses
the shuffle, however many rows one hot group holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuality.functions.numeric import percent_text, ratio_pct, round2
from punctuality.functions.text import months_text
from punctuality.functions.tiers import HIGH, LOW, MEDIUM, delay_tier
from punctuality.schemas import HIGH_BOUND, LOW_BOUND, TIERS

TIER_LABELS = {"low": LOW, "medium": MEDIUM, "high": HIGH}


def carrier_profile(
    df: DataFrame,
    keys: tuple[str, ...] = ("op_unique_carrier", "origin"),
    delay: str = "arr_delay",
    cancelled: str = "cancelled",
    month: str = "month",
    numeric_months: bool = False,
) -> DataFrame:
    """Per (carrier, origin): flights, min/max/avg delay, cancellation rate %, months.

    Nulls in ``delay`` are skipped (a group with none gets null min/max/avg);
    the rate is ``sum(cancelled) * 100 / count(*)`` with a null
    ``cancelled`` counted as 0; both rounded half-up to
    2 places. ``months_active`` lists the distinct months joined by ``-`` in
    text order (``1-10-2``), or numeric order with ``numeric_months``.
    """
    # Per month first, with fixed-width buffers; the second level then lists the few distinct months
    # of a group, whatever values they have.
    monthly = df.groupBy(*keys, month).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(delay).alias("_min"),
        F.max(delay).alias("_max"),
        F.sum(delay).alias("_sum"),
        F.count(delay).alias("_known"),
        F.sum(F.coalesce(F.col(cancelled), F.lit(0))).alias("_cancelled"),
    )
    agg = monthly.groupBy(*keys).agg(
        F.sum("_n").alias("total_flights"),
        F.min("_min").alias("min_delay"),
        F.max("_max").alias("max_delay"),
        F.try_divide(F.sum("_sum"), F.sum("_known")).alias("_avg"),
        F.sum("_cancelled").alias("_cancelled"),
        F.collect_list(month).alias("_months"),
    )
    return agg.select(
        *keys,
        "total_flights",
        "min_delay",
        "max_delay",
        round2("_avg").alias("avg_delay"),
        round2(ratio_pct("_cancelled", "total_flights")).alias("cancellation_rate"),
        months_text("_months", numeric=numeric_months).alias("months_active"),
    )


def carrier_profile_text(profile: DataFrame) -> DataFrame:
    """The profile with the rate as text, ``1.50%``."""
    return profile.withColumn("cancellation_rate", percent_text("cancellation_rate"))


def _in(tier: Column, label: str, value) -> Column:
    return F.when(tier == label, value)


def tier_stats(
    df: DataFrame,
    keys: tuple[str, ...] = ("origin", "month"),
    dep: str = "dep_delay",
    arr: str = "arr_delay",
    cancelled: str = "cancelled",
    low: float = LOW_BOUND,
    high: float = HIGH_BOUND,
) -> DataFrame:
    """Per (origin, month): flights and average dep/arr delay in each tier.

    Every row makes its group (also cancelled-only or on-time-only groups,
    whose tier counts are 0 and averages null); a null ``arr`` (diverted)
    is left out of the arrival average, not counted as 0.
    """
    rows = df.select(*keys, delay_tier(dep, cancelled, low, high).alias("_tier"), F.col(dep).alias("_dep"), F.col(arr).alias("_arr"))
    tier = F.col("_tier")
    aggs = []
    for t in TIERS:
        label = TIER_LABELS[t]
        aggs += [
            F.count(_in(tier, label, F.lit(1))).alias(f"count_{t}"),
            round2(F.avg(_in(tier, label, F.col("_dep")))).alias(f"avg_dep_{t}"),
            round2(F.avg(_in(tier, label, F.col("_arr")))).alias(f"avg_arr_{t}"),
        ]
    return rows.groupBy(*keys).agg(*aggs)
