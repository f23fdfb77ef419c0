"""Hash buckets that any engine with md5 can recompute."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_bucket(text: Column, buckets: int) -> Column:
    """First 32 bits of md5 as an unsigned number, modulo ``buckets`` (bigint)."""
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets).cast("bigint"))
