"""Rounding and number-to-text expressions that agree across engines.

Spark's ``round`` on a double rounds the decimal form half-up, Python and
DuckDB round the binary value, so ``round(0.145, 2)`` differs between them.
Going through ``decimal(38, 6)`` first fixes one answer (0.15) everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c, places: int = 2) -> Column:
    """``x`` rounded half-up to ``places`` decimals, as a double (null stays null)."""
    return F.round(_col(c).cast("decimal(38,6)"), places).cast("double")


def dec_text(c, places: int = 2) -> Column:
    """Plain text with exactly ``places`` decimals (``8.50``, never ``8.5E7``)."""
    return _col(c).cast(f"decimal(38,{places})").cast("string")


def percent_text(c) -> Column:
    """``1.5`` -> ``'1.50%'``."""
    return F.concat(dec_text(c), F.lit("%"))


def ratio_pct(numerator, denominator) -> Column:
    """``numerator * 100 / denominator`` in double arithmetic, in that order."""
    return _col(numerator).cast("double") * F.lit(100) / _col(denominator)
