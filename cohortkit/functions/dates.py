"""Date expressions with the reference's semantics, all built-in (whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ts(c: str | Column) -> Column:
    """Date as a time-zone-free timestamp at midnight."""
    return col(c).cast("timestamp_ntz")
