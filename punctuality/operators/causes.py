"""Delay / cancellation causes: one row per (flight, cause), and their counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuality.functions.tiers import is_cancelled
from punctuality.schemas import CANCEL_PREFIX, CAUSE_LABELS, NO_CODE


def valid_code(code: str = "cancellation_code") -> Column:
    c = F.col(code)
    return c.isNotNull() & (c != F.lit(NO_CODE)) & (c != F.lit(""))


def cancellation_cause(cancelled: str = "cancelled", code: str = "cancellation_code") -> Column:
    """``Cancellazione_<code>`` for a cancelled flight with a valid code, else null."""
    return F.when(is_cancelled(cancelled) & valid_code(code), F.concat(F.lit(CANCEL_PREFIX), F.col(code)))


def cause_array(
    causes: dict[str, str] = CAUSE_LABELS,
    cancelled: str = "cancelled",
    code: str = "cancellation_code",
) -> Column:
    """The causes of one flight as an array (no nulls): its cancellation, then
    each delay cause whose minutes are > 0 (a null counts as none)."""
    items = [cancellation_cause(cancelled, code)] + [
        F.when(F.col(c) > 0, F.lit(label)) for c, label in causes.items()
    ]
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def explode_causes(
    df: DataFrame,
    keys: tuple[str, ...] = ("origin", "month"),
    causes: dict[str, str] = CAUSE_LABELS,
    cancelled: str = "cancelled",
    code: str = "cancellation_code",
) -> DataFrame:
    """(keys..., cause) rows, from one scan of ``df``."""
    return df.select(*keys, F.explode(cause_array(causes, cancelled, code)).alias("cause"))


def explode_causes_union(
    df: DataFrame,
    keys: tuple[str, ...] = ("origin", "month"),
    causes: dict[str, str] = CAUSE_LABELS,
    cancelled: str = "cancelled",
    code: str = "cancellation_code",
) -> DataFrame:
    """Same rows as :func:`explode_causes`, as a UNION ALL of one filtered
    projection per cause. Kept as a cross-check: it scans ``df`` six times."""
    parts = [
        df.filter(is_cancelled(cancelled) & valid_code(code)).select(
            *keys, F.concat(F.lit(CANCEL_PREFIX), F.col(code)).alias("cause")
        )
    ] + [df.filter(F.col(c) > 0).select(*keys, F.lit(label).alias("cause")) for c, label in causes.items()]
    return reduce(DataFrame.unionByName, parts)


# Cause tallies at (keys..., cancellation code) grain -------------------------
#
# A flight has at most one cancellation code, so grouping by (keys, code)
# counts each code exactly, while the delay causes are plain conditional
# counts. The aggregate has fixed-width buffers only: one code-generated
# partial + final HashAggregate per row, however many causes a row has.

CODE_COL = "_code"
ROWS_COL = "_n"


def cause_inputs(
    causes: dict[str, str] = CAUSE_LABELS,
    cancelled: str = "cancelled",
    code: str = "cancellation_code",
) -> list[Column]:
    """Per-row inputs: the valid cancellation code (else null) and one flag per delay cause."""
    return [
        F.when(is_cancelled(cancelled) & valid_code(code), F.col(code)).alias(CODE_COL),
        *[(F.col(c) > 0).alias(f"_has_{c}") for c in causes],
    ]


def cause_tallies(causes: dict[str, str] = CAUSE_LABELS) -> list[Column]:
    """Aggregates over the inputs: rows, and rows per delay cause."""
    return [F.count(F.lit(1)).alias(ROWS_COL)] + [
        F.count(F.when(F.col(f"_has_{c}"), F.lit(1))).alias(f"_k_{c}") for c in causes
    ]


def cause_items(causes: dict[str, str] = CAUSE_LABELS) -> list[tuple[Column, Column]]:
    """(cause, count) of one tally row: its code's cancellations, then each delay cause."""
    return [(F.concat(F.lit(CANCEL_PREFIX), F.col(CODE_COL)), F.col(ROWS_COL))] + [
        (F.lit(label), F.col(f"_k_{c}")) for c, label in causes.items()
    ]


def cause_counts(
    df: DataFrame,
    keys: tuple[str, ...] = ("origin", "month"),
    causes: dict[str, str] = CAUSE_LABELS,
    cancelled: str = "cancelled",
    code: str = "cancellation_code",
) -> DataFrame:
    """(keys..., cause, cause_count) for causes seen at least once."""
    keys = list(keys)
    tallies = df.select(*keys, *cause_inputs(causes, cancelled, code)).groupBy(*keys, CODE_COL).agg(*cause_tallies(causes))
    items = F.array(*[F.struct(c.alias("cause"), n.alias("cause_count")) for c, n in cause_items(causes)])
    seen = F.filter(items, lambda x: x["cause"].isNotNull() & (x["cause_count"] > 0))
    rows = tallies.select(*keys, F.explode(seen).alias("_i")).select(*keys, "_i.cause", "_i.cause_count")
    # A few rows per group here. Partitioning them by the group keys lets the
    # merge below and a later per-group ranking share one exchange.
    return rows.repartition(*keys).groupBy(*keys, "cause").agg(F.sum("cause_count").alias("cause_count"))


def cause_counts_exploded(df: DataFrame, keys: tuple[str, ...] = ("origin", "month"), **kw) -> DataFrame:
    """Same result by exploding one row per (flight, cause) first (the
    original shape; up to six rows per flight enter the aggregation)."""
    return explode_causes(df, keys, **kw).groupBy(*keys, "cause").agg(F.count(F.lit(1)).alias("cause_count"))
