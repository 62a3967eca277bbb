"""The ``flights`` test table, derived from the ``lineitem`` table.

No flight data ships with the tests, so trips are derived from
``lineitem`` with integer arithmetic only; the same SQL text runs in Spark
and in DuckDB, so both engines see the same rows. The derivation is a pure
projection: it stays inside the scan stage and grows with ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FLIGHT_COLUMNS = [
    "op_unique_carrier",
    "origin",
    "month",
    "dep_delay",
    "arr_delay",
    "cancelled",
    "diverted",
    "cancellation_code",
    "carrier_delay",
    "weather_delay",
    "nas_delay",
    "security_delay",
    "late_aircraft_delay",
]

# Stage 1: two mixing hashes of the line key.
_HASHES = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_shipdate",
    "(l_orderkey + 3 * l_partkey) % 47 AS h1",
    "(7 * l_orderkey + 13 * l_partkey + 29 * l_linenumber) % 150 AS h2",
]

_ARR = "CASE WHEN h1 IN (0, 1) THEN NULL ELSE CAST(h2 - 55 + (5 * l_suppkey + l_linenumber) % 31 AS DOUBLE) END"


def _cause(cond: str, minutes: str) -> str:
    return f"CAST(CASE WHEN ({_ARR}) >= 15 AND {cond} THEN {minutes} ELSE 0.0 END AS DOUBLE)"


# Stage 2: trip columns plus h2.
_TRIPS = [
    "concat('C', CAST(l_suppkey % 12 AS STRING)) AS op_unique_carrier",
    "concat('A', CAST(l_partkey % 40 AS STRING)) AS origin",
    "CAST(month(l_shipdate) AS INT) AS month",
    "CASE WHEN h1 = 0 THEN NULL ELSE CAST(h2 - 40 AS DOUBLE) END AS dep_delay",
    f"{_ARR} AS arr_delay",
    "CAST(CASE WHEN h1 = 0 THEN 1 ELSE 0 END AS INT) AS cancelled",
    "CAST(CASE WHEN h1 = 1 THEN 1 ELSE 0 END AS INT) AS diverted",
    "CASE WHEN h1 <> 0 THEN 'N' WHEN l_partkey % 4 = 0 THEN 'A' WHEN l_partkey % 4 = 1 THEN 'B' "
    "WHEN l_partkey % 4 = 2 THEN 'C' ELSE 'D' END AS cancellation_code",
    f"{_cause('h2 % 3 = 0', _ARR)} AS carrier_delay",
    f"{_cause('h2 % 11 = 0', '5.0')} AS weather_delay",
    f"{_cause('h2 % 2 = 0', '7.0')} AS nas_delay",
    f"{_cause('h2 % 50 = 0', '3.0')} AS security_delay",
    f"{_cause('h2 % 5 < 2', '9.0')} AS late_aircraft_delay",
    "h2",
]

# Raw form: codes and cause minutes missing instead of 'N' / 0.0, some origins missing.
_RAW_OVERRIDES = {
    "origin": "CASE WHEN h2 = 149 THEN NULL ELSE origin END AS origin",
    "cancellation_code": "nullif(cancellation_code, 'N') AS cancellation_code",
    **{c: f"nullif({c}, 0.0) AS {c}" for c in FLIGHT_COLUMNS[8:]},
}
_RAW = [_RAW_OVERRIDES.get(c, c) for c in FLIGHT_COLUMNS]


def _sql(outer: list[str], source: str) -> str:
    inner = f"SELECT {', '.join(_HASHES)} FROM {source}"
    return f"SELECT {', '.join(outer)} FROM (SELECT {', '.join(_TRIPS)} FROM ({inner}) t1) t2"


def flights_sql(source: str = "lineitem") -> str:
    """SQL text of the flights table over ``source`` (valid in Spark and DuckDB)."""
    return _sql(FLIGHT_COLUMNS, source)


def flights_raw_sql(source: str = "lineitem") -> str:
    return _sql(_RAW, source)


def read_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")


def _trips(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(*_HASHES).selectExpr(*_TRIPS)


def flights_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Clean trips: codes filled with 'N', cause minutes with 0.0."""
    return _trips(lineitem).select(*FLIGHT_COLUMNS)


def flights_raw_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Raw trips: missing codes, missing cause minutes, a few missing origins."""
    return _trips(lineitem).selectExpr(*_RAW)


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_from_lineitem(read_lineitem(spark, sf_dir))


def flights_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_raw_from_lineitem(read_lineitem(spark, sf_dir))
