"""Hand-made trips, one small group per decision, with expected results
worked out by hand (not by running the code)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("op_unique_carrier", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("dep_delay", T.DoubleType()),
        T.StructField("arr_delay", T.DoubleType()),
        T.StructField("cancelled", T.DoubleType()),
        T.StructField("cancellation_code", T.StringType()),
        T.StructField("carrier_delay", T.DoubleType()),
        T.StructField("weather_delay", T.DoubleType()),
        T.StructField("nas_delay", T.DoubleType()),
        T.StructField("security_delay", T.DoubleType()),
        T.StructField("late_aircraft_delay", T.DoubleType()),
    ]
)


def row(carrier, origin, month, dep, arr, cancelled=0.0, code="N", carrier_d=0.0, weather=0.0, nas=0.0, security=0.0, late=0.0):
    return (carrier, origin, month, dep, arr, cancelled, code, carrier_d, weather, nas, security, late)


ROWS = [
    # CAN: every flight cancelled, codes A and B, no delays
    row("XX", "CAN", 1, None, None, 1.0, "A"),
    row("XX", "CAN", 1, None, None, 1.0, "B"),
    # ONT: departures on time or early, no cause
    row("XX", "ONT", 1, -5.0, -7.0),
    row("XX", "ONT", 1, 0.0, 3.0),
    # OTC: early departure with cause minutes
    row("XX", "OTC", 1, -5.0, 20.0, nas=20.0),
    # DIV: diverted flight (null arrival) inside a tier
    row("XX", "DIV", 1, 30.0, None),
    row("XX", "DIV", 1, 40.0, 10.0),
    # TIE: carrier 2, weather 2, nas 2, security 1
    row("XX", "TIE", 1, 5.0, 5.0, carrier_d=5.0, weather=5.0),
    row("XX", "TIE", 1, 5.0, 5.0, carrier_d=5.0, nas=5.0),
    row("XX", "TIE", 1, 5.0, 5.0, weather=5.0, nas=5.0, security=5.0),
    # EDG: tier edges
    row("XX", "EDG", 1, 14.99, 1.0),
    row("XX", "EDG", 1, 15.0, 2.0),
    row("XX", "EDG", 1, 60.0, 3.0),
    row("XX", "EDG", 1, 60.01, 4.0),
    # MON: months 1, 2, 10 for one carrier/origin
    row("MM", "MON", 1, 1.0, 1.0),
    row("MM", "MON", 2, 1.0, 1.0),
    row("MM", "MON", 10, 1.0, 1.0),
    # NUL: null cancelled, late departure
    row("XX", "NUL", 1, 20.0, 25.0, None),
    # COD: cancelled with code N, null and '' (F6)
    row("XX", "COD", 1, None, None, 1.0, "N"),
    row("XX", "COD", 1, None, None, 1.0, None),
    row("XX", "COD", 1, None, None, 1.0, ""),
    # NCM: null cause minutes, not cancelled
    row("XX", "NCM", 1, 5.0, 6.0, carrier_d=None),
    # UND: carrier code with an underscore
    row("A_B", "UND", 3, 2.0, 2.0),
]
# RND: 200 low-tier flights whose arrival delays sum to 29: average 0.145
ROWS += [row("XX", "RND", 1, 1.0, 1.0 if i < 29 else 0.0) for i in range(200)]


def edge_flights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROWS, SCHEMA)


# Expected typed report rows, by (origin, month):
# (count_low, avg_dep_low, avg_arr_low, count_medium, avg_dep_medium, avg_arr_medium,
#  count_high, avg_dep_high, avg_arr_high, cause_1, count_1, cause_2, count_2, cause_3, count_3)
N = None
EXPECTED_REPORT = {
    ("CAN", 1): (0, N, N, 0, N, N, 0, N, N, "Cancellazione_A", 1, "Cancellazione_B", 1, N, N),
    ("ONT", 1): (0, N, N, 0, N, N, 0, N, N, N, N, N, N, N, N),
    ("OTC", 1): (0, N, N, 0, N, N, 0, N, N, "NAS_Delay", 1, N, N, N, N),
    ("DIV", 1): (0, N, N, 2, 35.0, 10.0, 0, N, N, N, N, N, N, N, N),
    ("TIE", 1): (3, 5.0, 5.0, 0, N, N, 0, N, N, "Carrier_Delay", 2, "NAS_Delay", 2, "Weather_Delay", 2),
    ("EDG", 1): (1, 14.99, 1.0, 2, 37.5, 2.5, 1, 60.01, 4.0, N, N, N, N, N, N),
    ("MON", 1): (1, 1.0, 1.0, 0, N, N, 0, N, N, N, N, N, N, N, N),
    ("MON", 2): (1, 1.0, 1.0, 0, N, N, 0, N, N, N, N, N, N, N, N),
    ("MON", 10): (1, 1.0, 1.0, 0, N, N, 0, N, N, N, N, N, N, N, N),
    ("NUL", 1): (0, N, N, 1, 20.0, 25.0, 0, N, N, N, N, N, N, N, N),
    ("COD", 1): (0, N, N, 0, N, N, 0, N, N, N, N, N, N, N, N),
    ("NCM", 1): (1, 5.0, 6.0, 0, N, N, 0, N, N, N, N, N, N, N, N),
    ("UND", 3): (1, 2.0, 2.0, 0, N, N, 0, N, N, N, N, N, N, N, N),
    ("RND", 1): (200, 1.0, 0.15, 0, N, N, 0, N, N, N, N, N, N, N, N),
}

EXPECTED_TEXT = {
    ("CAN", 1): (
        "Low:0 voli (DepAvg:0.00, ArrAvg:0.00)",
        "Med:0 voli (DepAvg:0.00, ArrAvg:0.00)",
        "High:0 voli (DepAvg:0.00, ArrAvg:0.00)",
        "Top3_Cause:[Cancellazione_A(1), Cancellazione_B(1)]",
    ),
    ("ONT", 1): (
        "Low:0 voli (DepAvg:0.00, ArrAvg:0.00)",
        "Med:0 voli (DepAvg:0.00, ArrAvg:0.00)",
        "High:0 voli (DepAvg:0.00, ArrAvg:0.00)",
        "Top3_Cause:[Nessuna_Causa_Rilevata]",
    ),
    ("EDG", 1): (
        "Low:1 voli (DepAvg:14.99, ArrAvg:1.00)",
        "Med:2 voli (DepAvg:37.50, ArrAvg:2.50)",
        "High:1 voli (DepAvg:60.01, ArrAvg:4.00)",
        "Top3_Cause:[Nessuna_Causa_Rilevata]",
    ),
    ("TIE", 1): (
        "Low:3 voli (DepAvg:5.00, ArrAvg:5.00)",
        "Med:0 voli (DepAvg:0.00, ArrAvg:0.00)",
        "High:0 voli (DepAvg:0.00, ArrAvg:0.00)",
        "Top3_Cause:[Carrier_Delay(2), NAS_Delay(2), Weather_Delay(2)]",
    ),
    ("RND", 1): (
        "Low:200 voli (DepAvg:1.00, ArrAvg:0.15)",
        "Med:0 voli (DepAvg:0.00, ArrAvg:0.00)",
        "High:0 voli (DepAvg:0.00, ArrAvg:0.00)",
        "Top3_Cause:[Nessuna_Causa_Rilevata]",
    ),
}

# Expected carrier profile rows, by (carrier, origin):
# (total_flights, min_delay, max_delay, avg_delay, cancellation_rate, months_active)
EXPECTED_PROFILE = {
    ("XX", "CAN"): (2, N, N, N, 100.0, "1"),
    ("XX", "DIV"): (2, 10.0, 10.0, 10.0, 0.0, "1"),
    ("MM", "MON"): (3, 1.0, 1.0, 1.0, 0.0, "1-10-2"),
    ("XX", "COD"): (3, N, N, N, 100.0, "1"),
    ("XX", "NUL"): (1, 25.0, 25.0, 25.0, 0.0, "1"),
    ("A_B", "UND"): (1, 2.0, 2.0, 2.0, 0.0, "3"),
    ("XX", "RND"): (200, 0.0, 1.0, 0.15, 0.0, "1"),
    ("XX", "EDG"): (4, 1.0, 4.0, 2.5, 0.0, "1"),
}
