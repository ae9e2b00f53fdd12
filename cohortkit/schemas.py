"""Target contract of the de-identified registry (O29): column order, types, NOT NULL and
VARCHAR(n) limits of the key maps and the nine ``deid_*`` tables.

Spark does not enforce NOT NULL or string lengths on a DataFrame, so ``conform`` casts to the
contract, ``violations`` counts what would fail an insert into the reference's DDL (Q4, Q17:
an open visit or a drug with no end date), in one aggregate per table, and ``broken_rules`` names, row by
row, the rules that a row breaks, by which a run keeps such rows out of the tables it publishes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.operators.bag import times

_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "date": T.DateType(), "ts": T.TimestampNTZType(),
          "double": T.DoubleType(), "string": T.StringType()}

# The target DDL. Each entry "name type[!][:maxlen]"; '!' marks NOT NULL.
# Ids and concept ids are long (the source keys are int64); small codes are int.
_SPEC = {
    "cohort": (
        "person_id long!, visit_occurrence_id long!, visit_start_date date!, visit_end_date date!, birth_date date, "
        "death_date date"
    ),
    "person_map": "source_key long!, id long!, date_shift int, over_89_birth_year int",
    "visit_map": "source_key long!, new_id long!",
    "person": (
        "person_id long!, gender_concept_id int!, year_of_birth int!, month_of_birth int, day_of_birth int, "
        "birth_datetime ts, race_concept_id int!, ethnicity_concept_id int!, location_id long, provider_id long, "
        "care_site_id long, person_source_value string:50, gender_source_value string:50, gender_source_concept_id int, "
        "race_source_value string:50, race_source_concept_id int, ethnicity_source_value string:50, "
        "ethnicity_source_concept_id int"
    ),
    "death": (
        "person_id long!, death_date date!, death_datetime ts, death_type_concept_id int!, cause_concept_id long, "
        "cause_source_value string:50, cause_source_concept_id int"
    ),
    "visit_occurrence": (
        "visit_occurrence_id long!, person_id long!, visit_concept_id int!, visit_start_date date!, "
        "visit_start_datetime ts, visit_end_date date!, visit_end_datetime ts, visit_type_concept_id int!, "
        "provider_id long, care_site_id long, visit_source_value string:50, visit_source_concept_id int, "
        "admitted_from_concept_id int, admitted_from_source_value string:50, discharged_to_concept_id int, "
        "discharged_to_source_value string:50, preceding_visit_occurrence_id long"
    ),
    "procedure_occurrence": (
        "procedure_occurrence_id long!, person_id long!, procedure_concept_id long!, procedure_date date!, "
        "procedure_datetime ts, procedure_type_concept_id int!, modifier_concept_id int, quantity int, "
        "provider_id long, visit_occurrence_id long, visit_detail_id long, procedure_source_value string:50, "
        "procedure_source_concept_id int, modifier_source_value string:50"
    ),
    "drug_exposure": (
        "drug_exposure_id long!, person_id long!, drug_concept_id long!, drug_exposure_start_date date!, "
        "drug_exposure_start_datetime ts, drug_exposure_end_date date!, drug_exposure_end_datetime ts, "
        "verbatim_end_date date, drug_type_concept_id int!, stop_reason string:20, refills int, quantity double, "
        "days_supply int, sig string, route_concept_id int, lot_number string:50, provider_id long, "
        "visit_occurrence_id long, visit_detail_id long, drug_source_value string:50, drug_source_concept_id int, "
        "route_source_value string:50, dose_unit_source_value string:50"
    ),
    "device_exposure": (
        "device_exposure_id long!, person_id long!, device_concept_id long!, device_exposure_start_date date!, "
        "device_exposure_start_datetime ts, device_exposure_end_date date, device_exposure_end_datetime ts, "
        "device_type_concept_id int!, unique_device_id string:50, quantity int, provider_id long, "
        "visit_occurrence_id long, visit_detail_id long, device_source_value string:100, device_source_concept_id int"
    ),
    "condition_occurrence": (
        "condition_occurrence_id long!, person_id long!, condition_concept_id long!, condition_start_date date!, "
        "condition_start_datetime ts, condition_end_date date, condition_end_datetime ts, "
        "condition_type_concept_id int!, stop_reason string:20, provider_id long, visit_occurrence_id long, "
        "visit_detail_id long, condition_source_value string:50, condition_source_concept_id int, "
        "condition_status_source_value string:50, condition_status_concept_id int"
    ),
    "measurement": (
        "measurement_id long!, person_id long!, measurement_concept_id long!, measurement_date date!, "
        "measurement_datetime ts, measurement_time string:10, measurement_type_concept_id int!, "
        "operator_concept_id int, value_as_number double, value_as_concept_id int, unit_concept_id int, "
        "range_low double, range_high double, provider_id long, visit_occurrence_id long, visit_detail_id long, "
        "measurement_source_value string:50, measurement_source_concept_id int, unit_source_value string:50, "
        "value_source_value string:50"
    ),
    "observation": (
        "observation_id long!, person_id long!, observation_concept_id long!, observation_date date!, "
        "observation_datetime ts, observation_type_concept_id int!, value_as_number double, "
        "value_as_string string:60, value_as_concept_id int, qualifier_concept_id int, unit_concept_id int, "
        "provider_id long, visit_occurrence_id long, visit_detail_id long, observation_source_value string:50, "
        "observation_source_concept_id int, unit_source_value string:50, qualifier_source_value string:50"
    ),
}


def _parse(spec: str) -> list[tuple[str, str, bool, int | None]]:
    out = []
    for item in spec.split(","):
        name, typ = item.split()
        not_null = typ.endswith("!")
        typ = typ.rstrip("!")
        max_len = None
        if ":" in typ:
            typ, n = typ.split(":")
            max_len = int(n)
        out.append((name, typ, not_null, max_len))
    return out


COLUMNS: dict[str, list[tuple[str, str, bool, int | None]]] = {k: _parse(v) for k, v in _SPEC.items()}

SCHEMAS: dict[str, T.StructType] = {
    k: T.StructType([T.StructField(n, _TYPES[t], not nn) for n, t, nn, _ in cols]) for k, cols in COLUMNS.items()
}


def column_names(table: str) -> list[str]:
    return [c[0] for c in COLUMNS[table]]


def conform(df: DataFrame, table: str, along: Sequence[str] = ()) -> DataFrame:
    """Select the contract's columns in order, cast to its types (missing columns become NULL), and after them
    the columns ``along`` as they are."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(n) if n in have else F.lit(None)).cast(_TYPES[t]).alias(n)
            for n, t, _, _ in COLUMNS[table]
        ],
        *along,
    )


def _rules(df: DataFrame, table: str) -> list[tuple[str, str, Column]]:
    """(column, rule, whether a row breaks it) of the contract's rules on the columns of ``df``."""
    out = []
    for n, _, not_null, max_len in COLUMNS[table]:
        if n not in df.columns:
            continue
        if not_null:
            out.append((n, "not_null", F.col(n).isNull()))
        if max_len is not None:
            out.append((n, f"max_length_{max_len}", F.coalesce(F.length(F.col(n)) > max_len, F.lit(False))))
    return out


def broken_rules(df: DataFrame, table: str) -> Column:
    """The rules ("column: rule") that a row breaks, an empty list for most."""
    named = [F.when(broken, F.lit(f"{n}: {rule}")) for n, rule, broken in _rules(df, table)]
    return F.filter(F.array(*named), lambda r: r.isNotNull()) if named else F.array().cast("array<string>")


def violations(df: DataFrame, table: str) -> DataFrame:
    """(table_name, column_name, rule, violations): NULLs in NOT NULL columns and strings longer than
    the VARCHAR limit, from one global aggregate; only rules with a count are returned as rows
    with violations > 0 filtered by the caller if wanted."""
    checks = [(n, rule, F.sum(F.when(broken, times(df)).otherwise(0))) for n, rule, broken in _rules(df, table)]
    agg = df.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(f"c{i}") for i, (_, _, c) in enumerate(checks)])
    stack = ", ".join(f"'{n}', '{r}', c{i}" for i, (n, r, _) in enumerate(checks))
    return agg.selectExpr(f"stack({len(checks)}, {stack}) AS (column_name, rule, violations)").select(
        F.lit(table).alias("table_name"), "column_name", "rule", "violations"
    )
