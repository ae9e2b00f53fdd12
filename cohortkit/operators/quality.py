"""Quality checks on the de-identified registry.

The reference prints result sets and states the expectation in comments ("should fall within
target range", "should not be older than 99"). ``quality_report`` turns those into rows with a
pass/fail flag. Every check is one aggregate per table (partial aggregation, no wide shuffle).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.operators.bag import times
from cohortkit.operators.distinct import count_persons, person_bitmaps

# Per-table date columns of the range checks; condition and device use
# coalesce(end, start) for the maximum, drug uses the end date.
RANGE_COLUMNS: dict[str, tuple[str, str]] = {
    "observation": ("observation_date", "observation_date"),
    "procedure_occurrence": ("procedure_date", "procedure_date"),
    "condition_occurrence": ("coalesce(condition_end_date, condition_start_date)", "condition_start_date"),
    "measurement": ("measurement_date", "measurement_date"),
    "device_exposure": ("coalesce(device_exposure_end_date, device_exposure_start_date)", "device_exposure_start_date"),
    "drug_exposure": ("drug_exposure_end_date", "drug_exposure_start_date"),
}
CONCEPT_COLUMNS: dict[str, str] = {
    "observation": "observation_concept_id",
    "procedure_occurrence": "procedure_concept_id",
    "condition_occurrence": "condition_concept_id",
    "measurement": "measurement_concept_id",
    "device_exposure": "device_concept_id",
    "drug_exposure": "drug_concept_id",
}


def qc_persons(person: DataFrame) -> DataFrame:
    """Distinct persons, latest and earliest birth."""
    return person.agg(
        F.countDistinct("person_id").alias("num_people"),
        F.max("birth_datetime").alias("max_birthday"),
        F.min("birth_datetime").alias("min_birthday"),
    )


def qc_deaths(death: DataFrame) -> DataFrame:
    """Distinct persons with a death record."""
    return death.agg(F.countDistinct("person_id").alias("num_people"))


def qc_concepts(fact: DataFrame, concept_col: str) -> DataFrame:
    """Per concept, distinct persons and records. Persons are bits of bitmaps per block of ids, so a concept
    held by most persons is a few rows of the shuffle."""
    bitmaps = person_bitmaps(fact, [concept_col], _n=times(fact))
    return count_persons(bitmaps, [concept_col], "num_people", num_records="_n")


def qc_range(fact: DataFrame, max_expr: str | Column, min_col: str) -> DataFrame:
    """(max_date, min_date) of one table."""
    mx = F.expr(max_expr) if isinstance(max_expr, str) else max_expr
    return fact.agg(F.max(mx).alias("max_date"), F.min(F.col(min_col)).alias("min_date"))


def qc_ranges(tables: dict[str, DataFrame]) -> DataFrame:
    """O44 for every table with a date range, one row each."""
    parts = [
        qc_range(tables[t], mx, mn).select(F.lit(t).alias("table_name"), "max_date", "min_date")
        for t, (mx, mn) in RANGE_COLUMNS.items()
        if t in tables
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_report(tables: dict[str, DataFrame], start: dt.date, end: dt.date, as_of: dt.date, max_age: int = 99) -> DataFrame:
    """Expectations of the reference's comments as rows: (table_name, check, value, passed)."""
    rows = []
    if "person" in tables:
        p = qc_persons(tables["person"])
        # time-zone-free bound: the birth datetimes are TIMESTAMP_NTZ
        oldest_ok = F.col("min_birthday") >= F.to_timestamp_ntz(F.lit(f"{as_of.year - max_age - 1:04d}-01-01 00:00:00"))
        rows.append(p.select(F.lit("person").alias("table_name"), F.lit("persons").alias("check"),
                             F.col("num_people").cast("string").alias("value"), (F.col("num_people") > 0).alias("passed")))
        rows.append(p.select(F.lit("person").alias("table_name"), F.lit(f"min_birth_within_{max_age}_years").alias("check"),
                             F.col("min_birthday").cast("string").alias("value"), oldest_ok.alias("passed")))
    if "death" in tables:
        rows.append(qc_deaths(tables["death"]).select(
            F.lit("death").alias("table_name"), F.lit("persons").alias("check"),
            F.col("num_people").cast("string").alias("value"), F.lit(True).alias("passed")))
    for t, (mx, mn) in RANGE_COLUMNS.items():
        if t not in tables:
            continue
        r = qc_range(tables[t], mx, mn)
        rows.append(r.select(F.lit(t).alias("table_name"), F.lit("max_date_in_window").alias("check"),
                             F.col("max_date").cast("string").alias("value"),
                             F.coalesce(F.col("max_date") <= F.lit(end), F.lit(True)).alias("passed")))
        rows.append(r.select(F.lit(t).alias("table_name"), F.lit("min_date_in_window").alias("check"),
                             F.col("min_date").cast("string").alias("value"),
                             F.coalesce(F.col("min_date") >= F.lit(start), F.lit(True)).alias("passed")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
