"""Projection and cleaning of raw trips into the two analysis datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.schemas import CARRIER_COLUMNS, CAUSE_COLUMNS, CAUSE_DATASET_COLUMNS, NO_CODE


def select_existing(df: DataFrame, wanted) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have])


def drop_incomplete(df: DataFrame, subset) -> DataFrame:
    """Drop rows with a null in any of ``subset``.

    Written as ``c1 IS NOT NULL AND ...`` rather than ``na.drop``: Spark
    pushes that form into the file scan, ``na.drop``'s does not.
    """
    cols = [c for c in subset if c in df.columns]
    if not cols:
        return df
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def fill_causes(df: DataFrame, causes=CAUSE_COLUMNS, value: float = 0.0) -> DataFrame:
    """Missing cause minutes mean no such delay: fill with 0.0."""
    subset = [c for c in causes if c in df.columns]
    return df.na.fill(value, subset=subset) if subset else df


def fill_code(df: DataFrame, code: str = "cancellation_code", value: str = NO_CODE) -> DataFrame:
    """A missing cancellation code means not cancelled: fill with 'N'."""
    return df.na.fill(value, subset=[code]) if code in df.columns else df


def to_carrier_dataset(raw: DataFrame) -> DataFrame:
    """Carrier-profile input: carrier, origin, arr_delay, cancelled, month; rows
    without carrier, origin, month or cancelled dropped; null delays kept."""
    df = select_existing(raw, CARRIER_COLUMNS)
    return drop_incomplete(df, ["op_unique_carrier", "origin", "month", "cancelled"])


def to_cause_dataset(raw: DataFrame) -> DataFrame:
    """Delay-report input: cause minutes filled with 0.0, codes with 'N', rows
    without origin or month dropped; null dep/arr delays kept on purpose so
    that averages skip them."""
    df = fill_code(fill_causes(select_existing(raw, CAUSE_DATASET_COLUMNS)))
    return drop_incomplete(df, ["origin", "month"])
