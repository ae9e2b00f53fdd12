"""De-identification (O30-O40): key maps, then one generic ``deidentify`` with a spec per table.

* person map: new id by (gender desc, person_id desc); date shift uniform in [-max_shift,
  max_shift] and a replacement birth year for the very old, both keyed on a secret salt (see
  ``functions.keyed``), so a retry or a re-run never shifts two tables of one person apart.
* visit map: new id by visit id for visits whose shifted interval lies in [START, END].
* both maps are append-only over refreshes: mapped keys keep their ids (Q20), new ones are numbered after
  the highest id ever given (``key_map``).
* every date moves by the person's shift; datetimes are shifted (visit, condition) or rebuilt
  from the shifted date (others, Q18); provider and site ids become 1; a window filter keeps
  rows inside [START, END] - inclusive for visits, exclusive elsewhere (Q16); the visit id is
  replaced through a left join, so facts of unmapped visits keep a null visit (O34).

The maps are joined by key: the person map is one row per cohort person, the visit map one row
per cohort visit. They are broadcast when their measured size allows, else split by heavy persons.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.dates import to_ts
from cohortkit.functions.keyed import date_shift, replacement_birth_year
from cohortkit.operators.bag import weight_columns
from cohortkit.operators.key_map import append_ids
from cohortkit.plans.broadcast import join_lookup
from cohortkit.schemas import conform


def person_map(person: DataFrame, salt: str, as_of: dt.date, max_shift: int = 183, over_age: int = 89,
               existing: DataFrame | None = None, watermark: int | None = None) -> DataFrame:
    """(source_key, id, date_shift, over_89_birth_year).

    Persons of ``existing``, the map of the last run, keep their id, shift and birth year, also under another
    ``as_of``; new ones are numbered after ``watermark`` (``key_map.append_ids``)."""
    if not salt or as_of is None:
        raise ValueError("de-identification needs a secret salt and an as-of date")
    keys = person.select(F.col("person_id").alias("source_key"), "gender_concept_id").distinct()
    numbered = append_ids(keys, "source_key", [F.col("gender_concept_id").desc(), F.col("source_key").desc()], "id", existing, watermark)
    new = numbered.select(
        "source_key",
        "id",
        date_shift(salt, F.col("source_key"), max_shift).alias("date_shift"),
        replacement_birth_year(salt, F.col("source_key"), as_of.year, over_age).alias("over_89_birth_year"),
    )
    return new if existing is None else existing.select(*new.columns).unionByName(new)


def visit_map(
    visits: DataFrame, pmap: DataFrame, start: dt.date, end: dt.date, existing: DataFrame | None = None, watermark: int | None = None
) -> DataFrame:
    """(source_key, new_id) for visits inside the window after shifting; mapped visits keep their id (Q20)."""
    s = pmap.select(F.col("source_key").alias("_pkey"), "date_shift")
    cand = join_lookup(visits, s, "person_id", "_pkey").where(
        (F.date_add("visit_start_date", F.col("date_shift")) >= F.lit(start))
        & (F.date_add("visit_end_date", F.col("date_shift")) <= F.lit(end))
    ).select(F.col("visit_occurrence_id").alias("source_key"))
    new = append_ids(cand, "source_key", [F.col("source_key").asc()], "new_id", existing, watermark).select("source_key", "new_id")
    return new if existing is None else existing.select("source_key", "new_id").unionByName(new)


# ---- generic spec ------------------------------------------------------------------------
# Column rules: "keep" | "shift" (date + shift) | "shift_ts" (datetime + shift days) |
# ("from_date", date_col) (datetime rebuilt from the shifted date) | "pid" | "vid" | ("const", v)


@dataclass(frozen=True)
class DeidSpec:
    table: str
    rules: dict = field(default_factory=dict)   # output column -> rule; default "keep"
    window: tuple[str, str | None] | None = None  # (start_col, end_col or None = same as start)
    inclusive: bool = False                       # visit table: start >= START and end <= END
    coalesce_end: bool = False                    # end falls back to start (condition, device)
    uses_visit_map: bool = True


# Per-table rules of the reference's de-identification script.
DEID_SPECS: dict[str, DeidSpec] = {
    "visit_occurrence": DeidSpec(
        "visit_occurrence",
        {"visit_occurrence_id": "vid", "person_id": "pid", "visit_start_date": "shift", "visit_start_datetime": "shift_ts",
         "visit_end_date": "shift", "visit_end_datetime": "shift_ts", "provider_id": ("const", 1), "care_site_id": ("const", 1),
         "visit_source_value": ("const", None), "admitted_from_source_value": ("const", None),
         "discharged_to_source_value": ("const", None)},
        window=("visit_start_date", "visit_end_date"), inclusive=True,
    ),
    "condition_occurrence": DeidSpec(
        "condition_occurrence",
        {"person_id": "pid", "condition_start_date": "shift", "condition_start_datetime": "shift_ts",
         "condition_end_date": "shift", "condition_end_datetime": "shift_ts", "provider_id": ("const", 1),
         "visit_occurrence_id": "vid"},
        window=("condition_start_date", "condition_end_date"), coalesce_end=True,
    ),
    "procedure_occurrence": DeidSpec(
        "procedure_occurrence",
        {"person_id": "pid", "procedure_date": "shift", "procedure_datetime": ("from_date", "procedure_date"),
         "provider_id": ("const", 1), "visit_occurrence_id": "vid"},
        window=("procedure_date", None),
    ),
    "drug_exposure": DeidSpec(
        "drug_exposure",
        {"person_id": "pid", "drug_exposure_start_date": "shift",
         "drug_exposure_start_datetime": ("from_date", "drug_exposure_start_date"),
         "drug_exposure_end_date": "shift", "drug_exposure_end_datetime": ("from_date", "drug_exposure_end_date"),
         "verbatim_end_date": "shift", "provider_id": ("const", 1), "visit_occurrence_id": "vid"},
        window=("drug_exposure_start_date", "drug_exposure_end_date"),
    ),
    "observation": DeidSpec(
        "observation",
        {"person_id": "pid", "observation_date": "shift", "observation_datetime": ("from_date", "observation_date"),
         "provider_id": ("const", 1), "visit_occurrence_id": "vid"},
        window=("observation_date", None),
    ),
    "death": DeidSpec(
        "death",
        {"person_id": "pid", "death_date": "shift", "death_datetime": ("from_date", "death_date")},
        window=None, uses_visit_map=False,
    ),
    "device_exposure": DeidSpec(
        "device_exposure",
        {"person_id": "pid", "device_exposure_start_date": "shift",
         "device_exposure_start_datetime": ("from_date", "device_exposure_start_date"),
         "device_exposure_end_date": "shift", "device_exposure_end_datetime": ("from_date", "device_exposure_end_date"),
         "provider_id": ("const", 1), "visit_occurrence_id": "vid"},
        window=("device_exposure_start_date", "device_exposure_end_date"), coalesce_end=True,
    ),
    "measurement": DeidSpec(
        "measurement",
        {"person_id": "pid", "measurement_date": "shift", "measurement_datetime": ("from_date", "measurement_date"),
         "provider_id": ("const", 1), "visit_occurrence_id": "vid"},
        window=("measurement_date", None),
    ),
}


def _shift(c: str) -> Column:
    return F.date_add(F.col(c), F.col("_shift"))


# Columns the reference passes unchanged although they can link back to the source
# (Q19); ``strict=True`` blanks them. Record ids are primary keys of the contract and stay.
LINKABLE_COLUMNS = ("visit_detail_id", "preceding_visit_occurrence_id", "lot_number", "sig", "unique_device_id",
                    "value_as_string")


def deidentify(fact: DataFrame, pmap: DataFrame, vmap: DataFrame | None, spec: DeidSpec, start: dt.date, end: dt.date,
               strict: bool = False, limit_bytes: int | None = None) -> DataFrame:
    """One de-identified table in the target contract's column order. Maps above ``limit_bytes`` are joined
    by a split join (``broadcast.join_lookup``), records without a visit staying where they are."""
    s = pmap.select(F.col("source_key").alias("_pkey"), F.col("id").alias("_new_pid"), F.col("date_shift").alias("_shift"))
    j = join_lookup(fact, s, "person_id", "_pkey", limit_bytes=limit_bytes)
    if spec.uses_visit_map and vmap is not None:
        v = vmap.select(F.col("source_key").alias("_vkey"), F.col("new_id").alias("_new_vid"))
        j = join_lookup(j, v, "visit_occurrence_id", "_vkey", "left", limit_bytes)
    if spec.window is not None:
        sc, ec = spec.window
        s_shift = _shift(sc)
        e_src = F.col(ec if ec else sc)
        if spec.coalesce_end:
            e_src = F.coalesce(F.col(ec), F.col(sc))
        e_shift = F.date_add(e_src, F.col("_shift"))
        if spec.inclusive:
            cond = (s_shift >= F.lit(start)) & (e_shift <= F.lit(end))
        else:
            cond = (s_shift < F.lit(end)) & (e_shift > F.lit(start))
        j = j.where(cond)

    out = []
    for c in fact.columns:
        rule = spec.rules.get(c, "keep")
        if rule == "keep":
            e = F.col(c)
        elif rule == "shift":
            e = _shift(c)
        elif rule == "shift_ts":
            e = F.col(c) + F.make_dt_interval(F.col("_shift"))
        elif rule == "pid":
            e = F.col("_new_pid")
        elif rule == "vid":
            # without a visit map no visit can be mapped: the id is null, as for unmapped visits
            e = F.col("_new_vid") if "_new_vid" in j.columns else F.lit(None).cast("long")
        elif rule[0] == "from_date":
            e = to_ts(_shift(rule[1]))
        elif rule[0] == "const":
            e = F.lit(rule[1])
        else:
            raise ValueError(rule)
        if strict and c in LINKABLE_COLUMNS:
            e = F.lit(None)
        out.append(e.alias(c))
    return conform(j.select(*out), spec.table, along=weight_columns(fact))


def deid_person(person: DataFrame, pmap: DataFrame, as_of: dt.date, over_age: int = 89) -> DataFrame:
    """New id, shifted birth year and month (day 1), replacement year above ``over_age``
    (age from the unshifted birth and ``as_of``, /365.25 as the reference, Q15), site ids 1,
    source values '0' and source concepts 0."""
    s = pmap.select(F.col("source_key").alias("person_id"), "id", "date_shift", "over_89_birth_year")
    j = person.join(s, "person_id")
    shifted_birth = F.date_add(F.to_date("birth_datetime"), F.col("date_shift"))
    old = (F.datediff(F.lit(as_of), F.to_date("birth_datetime")) / F.lit(365.25)) > over_age
    year = F.when(old, F.col("over_89_birth_year")).otherwise(F.year(shifted_birth))
    month = F.month(shifted_birth)
    out = j.select(
        F.col("id").alias("person_id"),
        "gender_concept_id",
        year.alias("year_of_birth"),
        month.alias("month_of_birth"),
        F.lit(1).alias("day_of_birth"),
        to_ts(F.make_date(year, month, F.lit(1))).alias("birth_datetime"),
        "race_concept_id",
        "ethnicity_concept_id",
        F.lit(1).alias("location_id"),
        F.lit(1).alias("provider_id"),
        F.lit(1).alias("care_site_id"),
        F.lit("0").alias("person_source_value"),
        F.lit("0").alias("gender_source_value"),
        F.lit(0).alias("gender_source_concept_id"),
        F.lit("0").alias("race_source_value"),
        F.lit(0).alias("race_source_concept_id"),
        F.lit("0").alias("ethnicity_source_value"),
        F.lit(0).alias("ethnicity_source_concept_id"),
    )
    return conform(out, "person")
