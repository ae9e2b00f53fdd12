"""Small table builders for hand-made cases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cohortkit.sources.omop import SOURCE_COLUMNS

D = dt.date

_TYPES = {
    "date": "date", "datetime": "timestamp_ntz", "id": "bigint", "int": "int", "double": "double", "string": "string",
}


def _kind(col: str) -> str:
    if col.endswith("_datetime"):
        return "datetime"
    if col.endswith("_date"):
        return "date"
    if col in ("quantity", "value_as_number", "range_low", "range_high"):
        return "double"
    if col in ("unique_device_id", "production_id"):
        return "string"
    if col.endswith("_id") or col.endswith("_concept_id"):
        return "id"
    if col in ("year_of_birth", "month_of_birth", "day_of_birth", "refills", "days_supply"):
        return "int"
    return "string"


def table(spark, name: str, rows: list[dict]):
    """A source table with the full column list; unspecified columns are NULL."""
    cols = SOURCE_COLUMNS[name]
    schema = ", ".join(f"{c} {_TYPES[_kind(c)]}" for c in cols)
    data = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(data, schema)


def cohort_df(spark, rows):
    """rows: (person_id, visit_id, start, end)"""
    return spark.createDataFrame(
        [(p, v, s, e, None, None) for p, v, s, e in rows],
        "person_id bigint, visit_occurrence_id bigint, visit_start_date date, visit_end_date date, birth_date date, death_date date",
    )


def concept_set_df(spark, rows):
    """rows: (concept_id, name, domain, include_descendants)"""
    return spark.createDataFrame(
        [(c, str(c), n, d, "V", "S", inc) for c, n, d, inc in rows],
        "concept_id bigint, concept_code string, concept_name string, domain string, vocabulary string, "
        "is_standard string, include_descendants boolean",
    )


def ancestor_df(spark, rows):
    """rows: (ancestor, descendant, level)"""
    return spark.createDataFrame(rows, "ancestor_concept_id bigint, descendant_concept_id bigint, min_levels_of_separation int")


def concept_df(spark, rows):
    """rows: (concept_id, name, class, invalid_reason)"""
    return spark.createDataFrame(rows, "concept_id bigint, concept_name string, concept_class_id string, invalid_reason string")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def ids(df, col):
    return sorted(r[0] for r in df.select(col).collect())


def count_by(df, col):
    out = {}
    for r in df.groupBy(col).count().collect():
        out[r[0]] = r[1]
    return out


__all__ = ["D", "F", "table", "cohort_df", "concept_set_df", "ancestor_df", "concept_df", "plan_text", "ids", "count_by"]
