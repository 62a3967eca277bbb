"""Output order: none, a total sort, or Hive-style CLUSTER BY."""

from __future__ import annotations

from pyspark.sql import DataFrame


def apply_order(df: DataFrame, keys, order: str | None) -> DataFrame:
    """``None``: any order; ``"global"``: total sort by ``keys`` (range
    partitioned, so the sort itself is spread over all tasks);
    ``"clustered"``: hash partitioned by ``keys`` and sorted within each
    partition."""
    keys = list(keys)
    if order is None:
        return df
    if order == "global":
        return df.orderBy(*keys)
    if order == "clustered":
        return df.repartition(*keys).sortWithinPartitions(*keys)
    raise ValueError(f"unknown order {order!r}")
