"""Top-k rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctuality.functions.text import cause_label


def top_k_per_group(
    df: DataFrame,
    keys: tuple[str, ...],
    order: list[Column],
    k: int = 3,
    rank_col: str = "rnk",
) -> DataFrame:
    """The first ``k`` rows of each group by ``order`` (ties broken by the
    caller's order; give a total order for deterministic output).

    ``row_number() <= k`` is planned as a WindowGroupLimit before the
    shuffle, so at most ``k`` rows per group and task are exchanged.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_cause_rows(counts: DataFrame, keys: tuple[str, ...] = ("origin", "month"), k: int = 3) -> DataFrame:
    """(keys..., rnk, cause, cause_count): most frequent first, ties by cause name."""
    ranked = top_k_per_group(counts, keys, [F.desc("cause_count"), F.asc("cause")], k)
    return ranked.select(*keys, "rnk", "cause", "cause_count")


def top_causes_text(top_rows: DataFrame, keys: tuple[str, ...] = ("origin", "month")) -> DataFrame:
    """(keys..., top3_str) = ``a(12), b(7), c(3)`` in rank order (at most k items per group)."""
    items = F.sort_array(F.collect_list(F.struct("rnk", cause_label("cause", "cause_count").alias("label"))))
    return top_rows.groupBy(*keys).agg(
        F.array_join(F.transform(items, lambda x: x["label"]), ", ").alias("top3_str")
    )
