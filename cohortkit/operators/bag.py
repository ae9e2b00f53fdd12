"""Bags as weights.

The reference's extracts of drugs, deaths, procedures, conditions and devices are bags: a record stands in them
once per matching cohort row and registry ancestor. Here such a record is one row with the column TIMES, and
generalisation, de-identification, checks and profiles carry it along and count with it. The rows themselves are
made by :func:`expand_bag`, at a sink that asks for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIMES = "times_in_bag"


def times(df: DataFrame) -> Column:
    """How often a row of ``df`` counts: its weight, or once where the table has none."""
    return F.col(TIMES) if TIMES in df.columns else F.lit(1).cast("long")


def weight_columns(df: DataFrame) -> list[str]:
    """The columns a projection must carry along for the rows to keep their weight."""
    return [TIMES] if TIMES in df.columns else []


def expand_bag(df: DataFrame) -> DataFrame:
    """The bag itself: every record as many times as it counts, without the weight."""
    if TIMES not in df.columns:
        return df
    cols = [F.col(c) for c in df.columns if c != TIMES]
    each = F.explode(F.array_repeat(F.lit(True), F.col(TIMES).cast("int"))).alias("_each")
    return df.where(F.col(TIMES) > 0).select(*cols, each).drop("_each")
