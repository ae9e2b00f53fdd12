"""Cohort building.

qualifying diagnoses -> index visits within a window after a diagnosis -> birth and death ->
cohort table. The cohort is a bag (Q1): a visit repeats once per qualifying diagnosis date.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.params import Params
from cohortkit.plans.broadcast import broadcast_checked

COHORT_COLUMNS = ["person_id", "visit_occurrence_id", "visit_start_date", "visit_end_date", "birth_date", "death_date"]


def qualifying_events(condition: DataFrame, concepts: DataFrame, start: dt.date) -> DataFrame:
    """Distinct (person_id, diagnosis_date) with a condition in ``concepts`` on or after start."""
    return (
        condition.where(F.col("condition_start_date") >= F.lit(start))
        .join(broadcast_checked(concepts.select(F.col("concept_id").alias("condition_concept_id"))), "condition_concept_id", "left_semi")
        .select("person_id", F.col("condition_start_date").alias("diagnosis_date"))
        .distinct()
    )


def index_visits(
    visits: DataFrame,
    events: DataFrame,
    types: Sequence[int],
    start: dt.date,
    lo: int = -7,
    hi: int = 21,
) -> DataFrame:
    """Visits of ``types`` from ``start`` whose start lies strictly between lo and hi days
    after a qualifying date; one row per (visit, qualifying date) pair (Q1, Q2).

    The window is an exact day range [dx+lo+1, dx+hi-1], so each event is expanded to its
    admissible visit start days and joined on (person_id, visit_start_date): an equi-join
    whose key carries the day, no person-wide pairing.
    """
    admissible = events.select(
        "person_id",
        "diagnosis_date",
        F.explode(F.sequence(F.date_add("diagnosis_date", lo + 1), F.date_add("diagnosis_date", hi - 1))).alias("visit_start_date"),
    )
    v = visits.where(F.col("visit_concept_id").isin([int(t) for t in types]) & (F.col("visit_start_date") >= F.lit(start))).select(
        "person_id", "visit_occurrence_id", "visit_start_date", "visit_end_date"
    )
    return v.join(admissible, ["person_id", "visit_start_date"], "inner").select(
        "person_id", "visit_occurrence_id", "visit_start_date", "visit_end_date", "diagnosis_date"
    )


def attach_vitals(index: DataFrame, person: DataFrame, death: DataFrame) -> DataFrame:
    """Inner join person for birth, left join death (Q3: the datetime column is used)."""
    return index.join(person.select("person_id", "birth_datetime"), "person_id", "inner").join(
        death.select("person_id", "death_datetime"), "person_id", "left"
    )


def build_cohort(
    condition: DataFrame,
    visits: DataFrame,
    person: DataFrame,
    death: DataFrame,
    concept: DataFrame,
    concept_ancestor: DataFrame,
    params: Params,
    distinct: bool = False,
    coalesce_death: bool = False,
) -> DataFrame:
    """The cohort table (6 columns), datetimes narrowed to dates."""
    from cohortkit.operators.concepts import descendants

    dx = descendants(params.diagnosis_roots, concept, concept_ancestor)
    ev = qualifying_events(condition, dx, params.study_start)
    iv = index_visits(visits, ev, params.visit_types, params.study_start, params.window_lo, params.window_hi)
    death_in = death
    if coalesce_death:
        death_in = death.withColumn("death_datetime", F.coalesce("death_datetime", F.col("death_date").cast("timestamp_ntz")))
    vo = attach_vitals(iv, person, death_in)
    out = vo.select(
        "person_id",
        "visit_occurrence_id",
        "visit_start_date",
        "visit_end_date",
        F.to_date("birth_datetime").alias("birth_date"),
        F.to_date("death_datetime").alias("death_date"),
    )
    return out.distinct() if distinct else out


def cohort_attrition(events: DataFrame, index: DataFrame, cohort: DataFrame) -> DataFrame:
    """One row per step: (step, persons, visits, records)."""

    def step(name: str, df: DataFrame, visits: bool) -> DataFrame:
        return df.agg(
            F.lit(name).alias("step"),
            F.countDistinct("person_id").alias("persons"),
            (F.countDistinct("visit_occurrence_id") if visits else F.lit(None).cast("long")).alias("visits"),
            F.count(F.lit(1)).alias("records"),
        )

    return (
        step("qualifying_events", events, False)
        .unionByName(step("index_visits", index, True))
        .unionByName(step("cohort", cohort, True))
    )


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    """The first n rows in the order of all columns (person, visit, dates)."""
    return df.orderBy(*df.columns).limit(n)
