"""punctuality: on-time-performance reports as lazy Spark DataFrame operators."""

from punctuality.operators.aggregates import carrier_profile, carrier_profile_text, tier_stats
from punctuality.operators.causes import cause_counts, explode_causes
from punctuality.operators.ordering import apply_order
from punctuality.operators.prep import drop_incomplete, fill_causes, fill_code, to_carrier_dataset, to_cause_dataset
from punctuality.operators.profile import (
    cancelled_null_check,
    dataset_shape,
    distinct_profile,
    distinct_values,
    diverted_check,
    null_delay_by_status,
    null_profile,
    value_counts,
)
from punctuality.operators.sampling import replicate, sample_exact
from punctuality.operators.topk import top_cause_rows, top_causes_text, top_k_per_group
from punctuality.plans.reports import carrier_report, delay_report, delay_report_text
from punctuality.session import get_session
from punctuality.sources.files import read_flights, read_flights_text
from punctuality.sources.sinks import ingest, write_dataset, write_report

__version__ = "0.1.0"

__all__ = [
    "apply_order",
    "cancelled_null_check",
    "carrier_profile",
    "carrier_profile_text",
    "carrier_report",
    "cause_counts",
    "dataset_shape",
    "delay_report",
    "delay_report_text",
    "distinct_profile",
    "distinct_values",
    "diverted_check",
    "drop_incomplete",
    "explode_causes",
    "fill_causes",
    "fill_code",
    "get_session",
    "ingest",
    "null_delay_by_status",
    "null_profile",
    "read_flights",
    "read_flights_text",
    "replicate",
    "sample_exact",
    "tier_stats",
    "to_carrier_dataset",
    "to_cause_dataset",
    "top_cause_rows",
    "top_causes_text",
    "top_k_per_group",
    "value_counts",
    "write_dataset",
    "write_report",
]
