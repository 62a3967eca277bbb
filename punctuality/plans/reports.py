"""The two reports: carrier x airport profile and airport x month delay report.

``delay_report`` reads its input once. The rows are first aggregated at
(origin, month, cancellation code) grain: tier sums and counts, delay-cause
counts and the flights per code, all fixed-width buffers in one
code-generated partial aggregation. Everything after that works on at most
a few rows per (origin, month), so the one shuffle that carries per-row
work is the partial aggregate's, and hot groups are combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctuality.functions.numeric import round2
from punctuality.functions.text import cause_label, format_causes, format_tier
from punctuality.functions.tiers import delay_tier
from punctuality.operators.aggregates import TIER_LABELS, carrier_profile, carrier_profile_text, tier_stats
from punctuality.operators.causes import CODE_COL, cause_counts_exploded, cause_inputs, cause_items, cause_tallies, explode_causes
from punctuality.operators.ordering import apply_order
from punctuality.operators.topk import top_cause_rows, top_k_per_group
from punctuality.schemas import (
    CAUSE_LABELS,
    HIGH_BOUND,
    LOW_BOUND,
    TIER_TEXT,
    TIERS,
)
from punctuality.sources.tables import Stages, current_database

REPORT_KEYS = ("origin", "month")
PROFILE_KEYS = ("op_unique_carrier", "origin")


def _flatten_top(top: DataFrame, keys, k: int) -> DataFrame:
    """(keys..., cause_1, count_1, ..., cause_k, count_k) from ranked rows."""
    cols = []
    for i in range(1, k + 1):
        cols += [
            F.max(F.when(F.col("rnk") == i, F.col("cause"))).alias(f"cause_{i}"),
            F.max(F.when(F.col("rnk") == i, F.col("cause_count"))).alias(f"count_{i}"),
        ]
    return top.groupBy(*keys).agg(*cols)


def delay_report(
    df: DataFrame,
    keys=REPORT_KEYS,
    k: int = 3,
    dep: str = "dep_delay",
    arr: str = "arr_delay",
    cancelled: str = "cancelled",
    code: str = "cancellation_code",
    causes: dict[str, str] = CAUSE_LABELS,
    low: float = LOW_BOUND,
    high: float = HIGH_BOUND,
    order: str | None = None,
) -> DataFrame:
    """Typed airport x month report, one row per (origin, month) present in ``df``:
    ``count_/avg_dep_/avg_arr_`` for low/medium/high, then ``cause_i, count_i``
    for the top ``k`` causes (count desc, cause asc; null when fewer)."""
    keys = list(keys)
    # Project the per-row inputs once, so the aggregate refers to plain columns.
    rows = df.select(
        *keys,
        delay_tier(dep, cancelled, low, high).alias("_tier"),
        F.col(dep).alias("_dep"),
        F.col(arr).alias("_arr"),
        *cause_inputs(causes, cancelled, code),
    )
    fine = cause_tallies(causes)
    for t in TIERS:
        in_t = F.col("_tier") == TIER_LABELS[t]
        fine += [
            F.count(F.when(in_t, F.lit(1))).alias(f"_n_{t}"),
            F.sum(F.when(in_t, F.col("_dep"))).alias(f"_sd_{t}"),
            F.sum(F.when(in_t, F.col("_arr"))).alias(f"_sa_{t}"),
            F.count(F.when(in_t, F.col("_arr"))).alias(f"_ca_{t}"),
        ]
    by_code = rows.groupBy(*keys, CODE_COL).agg(*fine)

    # Each fine row becomes entries: one "stats" entry (kind 0) holding its
    # tier sums as a struct, and one per cause (kind 1): its cancellation
    # code, if any, and each delay cause. Summing entries per (origin, month,
    # kind, cause) rolls the codes of a group together; repartitioning by
    # (origin, month) first lets that sum, the ranking window and the final
    # pivot share one exchange, whose input is a few rows per group.
    sums = [f"_{s}_{t}" for t in TIERS for s in ("n", "sd", "sa", "ca")]
    tier_sums = F.struct(*[F.col(c) for c in sums])
    no_sums = F.lit(None).cast(T.StructType([by_code.schema[c] for c in sums]))
    entry = lambda kind, cause, n, s: F.struct(
        F.lit(kind).alias("kind"), cause.cast("string").alias("cause"), n.cast("long").alias("cause_count"), s.alias("s")
    )
    items = F.array(entry(0, F.lit(None), F.lit(0), tier_sums), *[entry(1, c, n, no_sums) for c, n in cause_items(causes)])
    entries = by_code.select(*keys, F.explode(items).alias("e")).select(*keys, "e.*")
    entries = entries.filter((F.col("kind") == 0) | (F.col("cause").isNotNull() & (F.col("cause_count") > 0)))
    is_stats = F.col("kind") == 0
    merged = (
        entries.repartition(*keys)
        .groupBy(*keys, "kind", "cause")
        .agg(
            F.sum("cause_count").alias("cause_count"),
            F.when(is_stats, F.struct(*[F.sum(f"s.{c}").alias(c) for c in sums])).alias("s"),
        )
    )
    # The stats entry ranks first, then causes by count desc, name asc.
    ranked = top_k_per_group(merged, tuple(keys), [F.asc("kind"), F.desc("cause_count"), F.asc("cause")], k + 1)
    pivot = ranked.groupBy(*keys).agg(
        F.max("s").alias("s"),  # the one stats entry (null elsewhere)
        *[
            F.max(F.when(F.col("rnk") == i + 1, F.col(col))).alias(f"{name}_{i}")
            for i in range(1, k + 1)
            for col, name in (("cause", "cause"), ("cause_count", "count"))
        ],
    )
    stats_cols = []
    for t in TIERS:
        n, ca = F.col(f"s._n_{t}"), F.col(f"s._ca_{t}")
        stats_cols += [
            n.alias(f"count_{t}"),
            round2(F.when(n > 0, F.col(f"s._sd_{t}") / n)).alias(f"avg_dep_{t}"),
            round2(F.when(ca > 0, F.col(f"s._sa_{t}") / ca)).alias(f"avg_arr_{t}"),
        ]
    cause_cols = [c for i in range(1, k + 1) for c in (f"cause_{i}", f"count_{i}")]
    return apply_order(pivot.select(*keys, *stats_cols, *cause_cols), keys, order)


def delay_report_from_parts(df: DataFrame, keys=REPORT_KEYS, k: int = 3, order: str | None = None) -> DataFrame:
    """The same typed report in the original shape: :func:`tier_stats`
    left-joined with the top causes of :func:`cause_counts_exploded` (two
    scans of ``df``). Cross-check for :func:`delay_report`."""
    keys = list(keys)
    stats = tier_stats(df, tuple(keys))
    top = _flatten_top(top_cause_rows(cause_counts_exploded(df, tuple(keys)), tuple(keys), k), keys, k)
    return apply_order(stats.join(top, keys, "left"), keys, order)


def delay_report_staged(df: DataFrame, path: str, database: str = "punctuality_stages", keys=REPORT_KEYS, k: int = 3) -> DataFrame:
    """The same typed report by staged tables: tiers, cause rows and top causes are tables of ``database`` while it is
    computed, each read by the next step; the report is written to ``path`` and read back, and the tables are
    dropped. For inputs whose intermediate results shall not be kept or computed twice in one plan."""
    spark, keys = df.sparkSession, list(keys)
    with current_database(spark, database), Stages(spark) as stage:
        stats = stage.put("tiers", tier_stats(df, tuple(keys)))
        causes = stage.put("causes", explode_causes(df, tuple(keys)))
        counts = causes.groupBy(*keys, "cause").agg(F.count(F.lit(1)).alias("cause_count"))
        top = stage.put("top_causes", _flatten_top(top_cause_rows(counts, tuple(keys), k), keys, k))
        report = _null_safe_left(stats, top, keys)
        report.write.mode("overwrite").parquet(path)
        return spark.read.schema(report.schema).parquet(path)


def _null_safe_left(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be null."""
    renamed = right.select(*[F.col(c).alias(f"_{c}") for c in keys], *[c for c in right.columns if c not in keys])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return left.join(renamed, same, "left").drop(*[f"_{c}" for c in keys])


def delay_report_text(report: DataFrame, keys=REPORT_KEYS, k: int = 3, order: str | None = None) -> DataFrame:
    """(origin, month, low_str, med_str, high_str, cause_str) text lines."""
    keys = list(keys)
    labels = F.concat_ws(", ", *[cause_label(f"cause_{i}", f"count_{i}") for i in range(1, k + 1)])
    text = report.select(
        *keys,
        *[
            format_tier(TIER_TEXT[t], f"count_{t}", f"avg_dep_{t}", f"avg_arr_{t}").alias(f"{TIER_TEXT[t].lower()}_str")
            for t in TIERS
        ],
        format_causes(labels).alias("cause_str"),
    )
    return apply_order(text, keys, order)


def carrier_report(df: DataFrame, text: bool = False, order: str | None = None, **kw) -> DataFrame:
    """The carrier x airport profile, typed or with the rate as text."""
    prof = carrier_profile(df, **kw)
    if text:
        prof = carrier_profile_text(prof)
    return apply_order(prof, kw.get("keys", PROFILE_KEYS), order)
