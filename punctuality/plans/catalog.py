"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads ``lineitem`` from ``sf_dir`` and derives the trips from
it (see :mod:`punctuality.sources.fixtures`), so its work grows with the
table. Queries that exercise a reader first write their input, derived
from the same table, under the session's checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuality.functions.tiers import delay_tier
from punctuality.operators.aggregates import carrier_profile, tier_stats
from punctuality.operators.causes import cause_counts, cause_counts_exploded, explode_causes, explode_causes_union
from punctuality.operators.prep import to_carrier_dataset, to_cause_dataset
from punctuality.operators.profile import (
    cancelled_null_check,
    dataset_shape,
    distinct_profile,
    distinct_values,
    diverted_check,
    null_delay_by_status,
    null_profile,
    profile_all,
    value_counts,
)
from punctuality.operators.sampling import replicate, sample_exact
from punctuality.operators.topk import top_cause_rows, top_causes_text
from punctuality.plans import roundtrips
from punctuality.plans.reports import carrier_report, delay_report, delay_report_from_parts, delay_report_text
from punctuality.schemas import FLIGHTS_RAW
from punctuality.session import scratch_path
from punctuality.sources.files import read_flights, read_flights_text, register, rejected_summary
from punctuality.sources.fixtures import flights, flights_raw
from punctuality.sources.sinks import write_dataset

Query = Callable[[SparkSession, str], DataFrame]

# The carrier profile in SQL text, over a registered view; per month first, like the operator.
CARRIER_PROFILE_SQL = """
WITH monthly AS (
  SELECT op_unique_carrier, origin, month, count(*) AS n, min(arr_delay) AS least, max(arr_delay) AS most,
         sum(arr_delay) AS total, count(arr_delay) AS known, sum(coalesce(cancelled, 0)) AS n_cancelled
  FROM {view} GROUP BY op_unique_carrier, origin, month),
g AS (
  SELECT op_unique_carrier, origin, sum(n) AS total_flights, min(least) AS min_delay, max(most) AS max_delay,
         try_divide(sum(total), sum(known)) AS mean_delay, sum(n_cancelled) AS n_cancelled, collect_list(month) AS months
  FROM monthly GROUP BY op_unique_carrier, origin)
SELECT op_unique_carrier, origin, total_flights, min_delay, max_delay,
       CAST(round(CAST(mean_delay AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_delay,
       CAST(round(CAST(CAST(n_cancelled AS DOUBLE) * 100 / total_flights AS DECIMAL(38,6)), 2) AS DOUBLE)
         AS cancellation_rate,
       array_join(array_sort(transform(months, m -> CAST(m AS STRING))), '-') AS months_active
FROM g
"""

# Deliberately broken lines for the text reader, chosen by departure delay.
EXTRA_FIELD_DELAY, MISSING_FIELD_DELAY, BAD_MONTH_DELAY = 7.0, 8.0, 9.0


def _carrier_sql(spark: SparkSession, d: str) -> DataFrame:
    register(flights(spark, d), "punctuality_flights")
    return spark.sql(CARRIER_PROFILE_SQL.format(view="punctuality_flights"))


def _delay_tier(spark: SparkSession, d: str) -> DataFrame:
    f = flights(spark, d)
    return f.select("origin", "month", "dep_delay", "cancelled", delay_tier().alias("tier"))


def _derived_input(spark: SparkSession, kind: str, write) -> str:
    """Write a reader's input, derived from the tables, anew for this call."""
    path = scratch_path(spark, kind)
    write(path)
    return path


def _csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = _derived_input(spark, "csv", lambda p: write_dataset(flights_raw(spark, d), p, fmt="csv"))
    return read_flights(spark, path, FLIGHTS_RAW)


def _broken_lines(spark: SparkSession, d: str) -> str:
    """Trips as comma lines (plus a header), some of them broken."""
    return _derived_input(spark, "text", lambda p: _write_broken_lines(spark, d, p))


def _write_broken_lines(spark: SparkSession, d: str, path: str) -> None:
    raw = flights_raw(spark, d)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in FLIGHTS_RAW.fieldNames()]
    month_at = FLIGHTS_RAW.fieldNames().index("month")
    dep = F.col("dep_delay")
    broken_month = fields[:month_at] + [F.lit("m9")] + fields[month_at + 1 :]
    line = (
        F.when(dep == EXTRA_FIELD_DELAY, F.concat_ws(",", *fields, F.lit("extra")))
        .when(dep == MISSING_FIELD_DELAY, F.concat_ws(",", *fields[:-1]))
        .when(dep == BAD_MONTH_DELAY, F.concat_ws(",", *broken_month))
        .otherwise(F.concat_ws(",", *fields))
    )
    header = raw.limit(1).select(F.lit(",".join(FLIGHTS_RAW.fieldNames())).alias("value"))
    raw.select(line.alias("value")).unionByName(header).write.text(path)


def _text_good(spark: SparkSession, d: str) -> DataFrame:
    good, _ = read_flights_text(spark, _broken_lines(spark, d))
    return good


def _text_rejected(spark: SparkSession, d: str) -> DataFrame:
    _, rejected = read_flights_text(spark, _broken_lines(spark, d))
    return rejected_summary(rejected)


def _sample_check(spark: SparkSession, d: str) -> DataFrame:
    """Size of the default sample, and rows of it that the input does not hold as often."""
    rows = to_carrier_dataset(flights_raw(spark, d))
    count = F.count(F.lit(1))
    taken = sample_exact(rows, 0.01, seed=42).groupBy(*rows.columns).agg(count.alias("_taken"))
    there = rows.groupBy(*rows.columns).agg(count.alias("_there"))
    same = [taken[c].eqNullSafe(there[c]) for c in rows.columns]
    both = taken.join(there, same, "left").select("_taken", "_there")
    excess = F.when(F.coalesce("_there", F.lit(0)) < F.col("_taken"), 1).otherwise(0)
    return both.agg(F.sum("_taken").alias("n_rows"), F.sum(excess).cast("long").alias("not_in_input"))


def _report(spark: SparkSession, d: str) -> DataFrame:
    return delay_report(flights(spark, d))


QUERIES: dict[str, Query] = {
    # Carrier x airport profile
    "carrier_profile": lambda s, d: carrier_profile(flights(s, d)),
    "carrier_profile_sql": _carrier_sql,
    "carrier_profile_text": lambda s, d: carrier_report(flights(s, d), text=True),
    "carrier_profile_global": lambda s, d: carrier_report(flights(s, d), order="global"),
    # Pieces of the airport x month report
    "delay_tier": _delay_tier,
    "tier_stats": lambda s, d: tier_stats(flights(s, d)),
    "cause_rows": lambda s, d: explode_causes(flights(s, d)),
    "cause_rows_union": lambda s, d: explode_causes_union(flights(s, d)),
    "cause_counts": lambda s, d: cause_counts(flights(s, d)),
    "cause_counts_exploded": lambda s, d: cause_counts_exploded(flights(s, d)),
    "top_causes_rows": lambda s, d: top_cause_rows(cause_counts(flights(s, d))),
    "top_causes_text": lambda s, d: top_causes_text(top_cause_rows(cause_counts(flights(s, d)))),
    # Airport x month report
    "delay_report": _report,
    "delay_report_from_parts": lambda s, d: delay_report_from_parts(flights(s, d)),
    "delay_report_text": lambda s, d: delay_report_text(_report(s, d), order="global"),
    "delay_report_clustered": lambda s, d: delay_report_text(_report(s, d), order="clustered"),
    # Preparation
    "prep_carrier": lambda s, d: to_carrier_dataset(flights_raw(s, d)),
    "prep_causes": lambda s, d: to_cause_dataset(flights_raw(s, d)),
    "sample_exact": lambda s, d: sample_exact(to_carrier_dataset(flights_raw(s, d)), 0.01, seed=42, method="md5"),
    "sample_exact_check": _sample_check,
    "replicate": lambda s, d: replicate(to_carrier_dataset(flights_raw(s, d)), 10),
    # Profiling
    "null_profile": lambda s, d: null_profile(flights_raw(s, d)),
    "distinct_profile": lambda s, d: distinct_profile(flights_raw(s, d)),
    "value_counts": lambda s, d: value_counts(flights_raw(s, d), "cancellation_code"),
    "distinct_values": lambda s, d: distinct_values(flights_raw(s, d), "month"),
    "null_delay_by_status": lambda s, d: null_delay_by_status(flights_raw(s, d)),
    "cancelled_null_check": lambda s, d: cancelled_null_check(flights_raw(s, d)),
    "diverted_check": lambda s, d: diverted_check(flights_raw(s, d)),
    "dataset_shape": lambda s, d: dataset_shape(flights_raw(s, d)),
    "profile_all": lambda s, d: profile_all(flights_raw(s, d)),
    "first_rows": roundtrips.first_trips,
    "schema_rows": roundtrips.schema_listing,
    # Readers
    "csv_roundtrip": _csv_roundtrip,
    "text_good_rows": _text_good,
    "text_rejected_summary": _text_rejected,
    "text_wide_raw": roundtrips.text_wide_raw,
    "text_reordered_header": roundtrips.text_reordered_header,
    "text_mixed_headers": roundtrips.text_mixed_headers,
    "csv_mixed_headers": roundtrips.csv_mixed_headers,
    "text_mixed_rejected": roundtrips.text_mixed_rejected,
    "external_table_scan": roundtrips.external_table_scan,
    # Jobs and writers, read back
    "prep_from_wide_raw": roundtrips.prep_from_wide_raw,
    "tsv_roundtrip": roundtrips.tsv_roundtrip,
    "text_lines_roundtrip": roundtrips.text_lines_roundtrip,
    "table_roundtrip": roundtrips.table_roundtrip,
    "partitioned_report": roundtrips.partitioned_report,
    "single_file_report": roundtrips.single_file_report,
    "report_order_check": roundtrips.report_order_check,
    "distinct_approx_check": roundtrips.distinct_approx_check,
    "distinct_sketch_check": roundtrips.distinct_sketch_check,
    "delay_report_staged": roundtrips.staged_report,
    "job_profile": roundtrips.job_profile,
    "job_text_lines": roundtrips.job_text_lines,
    "job_separator": roundtrips.job_separator,
    "job_mixed_parquet": roundtrips.job_mixed_parquet,
    # Rare cases: odd and unknown months, unknown cancellation, codes that are no causes
    "carrier_profile_edge": lambda s, d: carrier_profile(roundtrips.edge_flights(s, d)),
    "delay_report_edge": lambda s, d: delay_report(roundtrips.edge_flights(s, d)),
    "delay_report_edge_text": lambda s, d: delay_report_text(delay_report(roundtrips.edge_flights(s, d))),
}
