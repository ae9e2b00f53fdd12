"""Ids that last over refreshes.

Both key maps (persons, visits) are append-only: a key that is mapped keeps its id and its other values for good, and
new keys are numbered, in the map's order, after the highest id ever given. That mark is published with a run, so an
id is not given anew either if the rows that held it have left the map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.operators.rownum import row_number_global


def append_ids(keys: DataFrame, key: str, order: list[Column], out: str, existing: DataFrame | None = None, watermark: int | None = None) -> DataFrame:
    """The rows of ``keys`` that ``existing`` (with ``key`` and ``out``) does not map, numbered as ``out`` after
    ``watermark``, or after the highest id of ``existing`` if that is higher. Keys are distinct and not null."""
    new, last = keys.where(F.col(key).isNotNull()), int(watermark or 0)
    if existing is not None:
        new = new.join(existing.select(key), key, "left_anti")
        last = max(last, int(existing.agg(F.max(out)).first()[0] or 0))
    return row_number_global(new, order, out, start=last + 1)


def high_watermark(mapping: DataFrame, out: str, watermark: int | None = None) -> int:
    """The highest id ever given: that of ``mapping``, or an earlier mark that is higher."""
    return max(int(watermark or 0), int(mapping.agg(F.max(out)).first()[0] or 0))
