"""Scan-cost expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: $5 per TiB scanned with a 10 MiB billing minimum.
PRICE_PER_TB = 5.0
BYTES_IN_TB = float(1024 ** 4)
BYTES_IN_MB = float(1024 ** 2)
MIN_BILLABLE_BYTES = 10 * 1024 ** 2


def scan_cost(bytes_scanned: Column) -> Column:
    """max(bytes, 10 MiB) / 2^40 * 5, in double arithmetic."""
    return (F.greatest(bytes_scanned, F.lit(MIN_BILLABLE_BYTES)).cast("double")
            / F.lit(BYTES_IN_TB) * F.lit(PRICE_PER_TB))


def dollars(c: Column) -> Column:
    return F.format_string("$%.6f", c)
