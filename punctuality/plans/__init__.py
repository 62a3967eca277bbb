"""Report plans built from the operators, and the spark-submit job runner."""

from punctuality.plans.reports import (
    apply_order,
    carrier_report,
    delay_report,
    delay_report_from_parts,
    delay_report_text,
)

__all__ = ["apply_order", "carrier_report", "delay_report", "delay_report_from_parts", "delay_report_text"]
