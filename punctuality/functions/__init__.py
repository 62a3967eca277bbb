"""Column expressions (JVM-side, code-generated; no Python UDFs)."""

from punctuality.functions.numeric import dec_text, percent_text, ratio_pct, round2
from punctuality.functions.text import (
    cause_label,
    format_causes,
    format_tier,
    months_text,
)
from punctuality.functions.tiers import delay_tier, is_cancelled, with_delay_tier

__all__ = [
    "cause_label",
    "dec_text",
    "delay_tier",
    "format_causes",
    "format_tier",
    "is_cancelled",
    "months_text",
    "percent_text",
    "ratio_pct",
    "round2",
    "with_delay_tier",
]
