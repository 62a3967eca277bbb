"""Schemas, labels and bounds of the on-time-performance data model.

Every operator takes column names and bounds as parameters; the values
below are the defaults.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the original jobs' output text and bounds.
# ---------------------------------------------------------------------------
# Departure-delay tier bounds, in minutes: 0 < d < 15 low, 15 <= d <= 60
# medium, d > 60 high.
LOW_BOUND = 15
HIGH_BOUND = 60
# Delay-cause columns and the label each one gets in the top-k report.
CAUSE_LABELS = {
    "carrier_delay": "Carrier_Delay",
    "weather_delay": "Weather_Delay",
    "nas_delay": "NAS_Delay",
    "security_delay": "Security_Delay",
    "late_aircraft_delay": "Late_Aircraft_Delay",
}
# A cancelled flight with a valid code counts as cause "Cancellazione_<code>".
CANCEL_PREFIX = "Cancellazione_"
# Code that marks "no cancellation code"; it and '' are not valid causes.
NO_CODE = "N"
# Report text pieces.
TIER_TEXT = {"low": "Low", "medium": "Med", "high": "High"}
TIER_FLIGHTS = " voli (DepAvg:"
TIER_ARR = ", ArrAvg:"
CAUSES_OPEN = "Top3_Cause:["
CAUSES_CLOSE = "]"
NO_CAUSE = "Nessuna_Causa_Rilevata"
MONTHS_SEP = "-"
# ---------------------------------------------------------------------------

TIERS = ("low", "medium", "high")
CAUSE_COLUMNS = tuple(CAUSE_LABELS)

CARRIER_COLUMNS = ["op_unique_carrier", "origin", "arr_delay", "cancelled", "month"]
CAUSE_DATASET_COLUMNS = [
    "origin",
    "month",
    "dep_delay",
    "arr_delay",
    "cancelled",
    "cancellation_code",
    *CAUSE_COLUMNS,
]

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Carrier-profile input, in file column order.
FLIGHTS_CARRIER = _struct(
    [
        ("op_unique_carrier", _S),
        ("origin", _S),
        ("arr_delay", _D),
        ("cancelled", _I),
        ("month", _I),
    ]
)

# Delay-report input, in file column order.
FLIGHTS_CAUSES = _struct(
    [
        ("origin", _S),
        ("month", _I),
        ("dep_delay", _D),
        ("arr_delay", _D),
        ("cancelled", _D),
        ("cancellation_code", _S),
        *[(c, _D) for c in CAUSE_COLUMNS],
    ]
)

# Raw trips: the union of both plus `diverted`.
FLIGHTS_RAW = _struct(
    [
        ("op_unique_carrier", _S),
        ("origin", _S),
        ("month", _I),
        ("dep_delay", _D),
        ("arr_delay", _D),
        ("cancelled", _I),
        ("diverted", _I),
        ("cancellation_code", _S),
        *[(c, _D) for c in CAUSE_COLUMNS],
    ]
)
