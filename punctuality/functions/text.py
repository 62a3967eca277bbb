"""Text rendering of the typed reports (always the last step)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from punctuality.functions.numeric import dec_text
from punctuality.schemas import (
    CAUSES_CLOSE,
    CAUSES_OPEN,
    MONTHS_SEP,
    NO_CAUSE,
    TIER_ARR,
    TIER_FLIGHTS,
)


def format_tier(label: str, n, dep, arr) -> Column:
    """``Low:12 voli (DepAvg:8.50, ArrAvg:3.00)``; missing values print as 0 / 0.00."""
    return F.concat(
        F.lit(f"{label}:"),
        F.coalesce(F.col(n), F.lit(0)).cast("string"),
        F.lit(TIER_FLIGHTS),
        dec_text(F.coalesce(F.col(dep), F.lit(0.0))),
        F.lit(TIER_ARR),
        dec_text(F.coalesce(F.col(arr), F.lit(0.0))),
        F.lit(")"),
    )


def cause_label(cause, count) -> Column:
    """``Carrier_Delay(12)``; null when the cause is null."""
    return F.concat(F.col(cause), F.lit("("), F.col(count).cast("string"), F.lit(")"))


def format_causes(labels: Column) -> Column:
    """``Top3_Cause:[a(3), b(2)]`` from a text of joined labels, or the no-cause text."""
    body = F.when(labels.isNull() | (labels == ""), F.lit(NO_CAUSE)).otherwise(labels)
    return F.concat(F.lit(CAUSES_OPEN), body, F.lit(CAUSES_CLOSE))


def months_text(months: str = "months", numeric: bool = False) -> Column:
    """Distinct months of an array joined by ``-``, sorted as text (``1-10-2``) or as numbers."""
    as_text = lambda m: m.cast("string")
    if numeric:
        return F.array_join(F.transform(F.array_sort(F.col(months)), as_text), MONTHS_SEP)
    return F.array_join(F.array_sort(F.transform(F.col(months), as_text)), MONTHS_SEP)
