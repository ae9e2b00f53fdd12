"""Summary statistics (O65, O68-O82): source-value profiles, ancestor profiles and the cohort
summary report (age, race, ethnicity, deaths, length of stay).

Numbers in the text report are written with fixed formats (integers plainly, reals with four
decimals) so that the report does not depend on an engine's default float-to-text rendering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.arith import round_percent, round_ratio
from cohortkit.operators.bag import times, weight_columns
from cohortkit.operators.concepts import concept_slice
from cohortkit.operators.distinct import BITS, BLOCK, count_persons, person_bitmaps
from cohortkit.plans.broadcast import broadcast_checked, join_lookup, written


def ingredient_route_profile(drug: DataFrame, concept_ancestor: DataFrame, concept: DataFrame,
                             ingredients: Sequence[int]) -> DataFrame:
    """Patients per (ingredient, route text, drug source text) for listed ingredients."""
    ids = [int(i) for i in ingredients]
    ing = concept.where((F.col("concept_class_id") == "Ingredient") & F.col("concept_id").isin(ids)).select(
        F.col("concept_id").alias("ingredient_concept_id"), F.col("concept_name").alias("ingredient_name")
    )
    ca = concept_ancestor.where(F.col("ancestor_concept_id").isin(ids)).select(
        F.col("descendant_concept_id").alias("drug_concept_id"), F.col("ancestor_concept_id").alias("ingredient_concept_id")
    )
    slice_ = broadcast_checked(ca.join(ing, "ingredient_concept_id"))
    keys = ["ingredient_concept_id", "ingredient_name", "route_source_value", "drug_source_value"]
    return (
        drug.select("person_id", "drug_concept_id", "route_source_value", "drug_source_value")
        .join(slice_, "drug_concept_id")
        .select(*keys, "person_id").distinct()
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("patient_count"))
    )


def _per_person_stats(df: DataFrame, keys: list[str], mean_name: str) -> DataFrame:
    """Distinct persons and records per key, pre-aggregated per (key, person)."""
    per = df.groupBy(*keys, "person_id").agg(F.sum(times(df)).alias("_n"))
    return per.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("unique_person_count"),
        (F.sum("_n") / F.count(F.lit(1))).alias(mean_name),
    )


def source_profile(measurement: DataFrame) -> DataFrame:
    """Persons, percent of persons and records per person, by concept and source text."""
    total = measurement.agg(F.countDistinct("person_id")).scalar()
    s = _per_person_stats(measurement, ["measurement_concept_id", "measurement_source_value"], "mean_measurements_per_patient")
    return s.select(
        "measurement_concept_id", "measurement_source_value", "unique_person_count",
        round_percent(F.col("unique_person_count"), total).alias("percent_of_persons"), "mean_measurements_per_patient",
    )


def ancestor_profile(fact: DataFrame, concept_ancestor: DataFrame, concept: DataFrame, concept_col: str,
                     source_col: str, mean_name: str) -> DataFrame:
    """Prevalence by every ancestor (self included); concepts without closure rows are
    kept under their own id, and names fall back to the concept's, then the source text.

    Persons and records are first gathered per (concept, source text) as bitmaps and counts, so the closure
    fan-out repeats and merges those, and no person. A concept's ancestors and their names are one row per concept,
    which the bitmaps of a concept that most records share (0) meet where they are."""
    total = fact.agg(F.countDistinct("person_id")).scalar()
    base = person_bitmaps(fact, [F.col(concept_col).alias("_c"), F.col(source_col).alias(source_col)], _n=times(fact))
    used = written(fact.select(F.col(concept_col).alias("_c")).where("_c IS NOT NULL").distinct())
    names = concept.select(F.col("concept_id").alias("_id"), F.col("concept_name").alias("_name"))
    ca = concept_ancestor.select(F.col("descendant_concept_id").alias("_c"), F.col("ancestor_concept_id").alias("_a"))
    up = (
        used.join(ca, "_c", "left")
        .join(names.select(F.col("_id").alias("_a"), F.col("_name").alias("_an")), "_a", "left")
        .join(names.select(F.col("_id").alias("_c"), F.col("_name").alias("_sn")), "_c", "left")
        .select(F.col("_c").alias("_of"), F.struct(F.coalesce("_a", "_c").alias("id"), F.coalesce("_an", "_sn").alias("name")).alias("_up"))
        .groupBy("_of").agg(F.collect_list("_up").alias("_ups"))
    )
    keyed = join_lookup(base, up, "_c", "_of", "left").select("*", F.explode_outer("_ups").alias("_up")).select(
        F.coalesce("_up.id", "_c").alias("concept_id"),
        F.coalesce("_up.name", F.col(source_col)).alias("concept_name"),
        source_col, BLOCK, BITS, "_n",
    )
    agg = count_persons(keyed, ["concept_id", "concept_name", source_col], "unique_person_count", _n="_n")
    return agg.select(
        "concept_id", "concept_name", source_col, "unique_person_count",
        round_percent(F.col("unique_person_count"), total).alias("percent_of_persons"), (F.col("_n") / F.col("unique_person_count")).alias(mean_name),
    )


# ------------------------------------------------------------------ cohort summary
def first_visit(visits: DataFrame) -> DataFrame:
    """First visit date per person."""
    return visits.groupBy("person_id").agg(F.min("visit_start_date").alias("first_visit_date"))


def age_at_first_visit(person: DataFrame, first: DataFrame) -> DataFrame:
    """Year difference between the first visit and the birth year."""
    return person.join(first, "person_id").select(
        "person_id", (F.year("first_visit_date") - F.col("year_of_birth")).alias("age_at_first_visit")
    )


def demographics(person: DataFrame, age: DataFrame) -> DataFrame:
    """O73."""
    return person.join(age, "person_id").select(
        "person_id", "gender_concept_id", "race_concept_id", "ethnicity_concept_id", "year_of_birth", "age_at_first_visit"
    )


def death_info(death: DataFrame, concept: DataFrame) -> DataFrame:
    """Death with the cause's name (left join). Only the names of causes that occur are looked
    up, and joined to the deaths without shuffling them by cause."""
    c = concept_slice(concept, death.select(F.col("cause_concept_id").alias("concept_id"))).select(F.col("concept_id").alias("cause_concept_id"), F.col("concept_name").alias("cause_of_death"))
    return death.join(broadcast_checked(c), "cause_concept_id", "left").select(
        "person_id", "death_date", "cause_source_value", "cause_of_death", *weight_columns(death))


def stay(visits: DataFrame, first: DataFrame) -> DataFrame:
    """Length of stay of the visit(s) starting on the first visit date (ties give several rows)."""
    v = visits.select("person_id", F.col("visit_start_date").alias("first_visit_date"), "visit_start_date", "visit_end_date")
    return first.join(v, ["person_id", "first_visit_date"]).select(
        "person_id", F.datediff("visit_end_date", "visit_start_date").alias("length_of_stay")
    )


def age_summary(age: DataFrame) -> DataFrame:
    """Mean, median (interpolating), min, max and sample standard deviation of age."""
    return age.agg(
        F.avg("age_at_first_visit").alias("mean_age"),
        F.percentile("age_at_first_visit", 0.5).alias("median_age"),
        F.min("age_at_first_visit").alias("min_age"),
        F.max("age_at_first_visit").alias("max_age"),
        F.stddev_samp("age_at_first_visit").alias("age_sd"),
    )


def share(demo: DataFrame, concept: DataFrame, concept_col: str, label: str) -> DataFrame:
    """Persons per concept name and their percent; inner join to the vocabulary, so
    unmapped ids leave the denominator (Q30). The total is over the few result rows."""
    counts, total = _share_counts(demo, concept, concept_col, label)
    return counts.select(label, "count", (F.lit(100.0) * F.col("count") / total).alias("percent"))


def _share_counts(demo: DataFrame, concept: DataFrame, concept_col: str, label: str) -> tuple[DataFrame, Column]:
    c = concept.select(F.col("concept_id").alias(concept_col), F.col("concept_name").alias(label))
    by_id = demo.groupBy(concept_col).agg(F.count(F.lit(1)).alias("_n")).join(c, concept_col)
    counts = by_id.groupBy(label).agg(F.sum("_n").alias("count"))
    return counts, by_id.agg(F.sum("_n")).scalar()


def death_summary(info: DataFrame) -> DataFrame:
    """O79."""
    return info.agg(
        F.coalesce(F.sum(times(info)), F.lit(0)).cast("long").alias("total_deaths"),
        F.countDistinct("cause_of_death").alias("causes_of_death"),
        F.countDistinct("cause_source_value").alias("causes_source_value"),
    )


def stay_summary(los: DataFrame) -> DataFrame:
    """Exact interpolated median and quartiles of length of stay."""
    p = F.percentile("length_of_stay", F.array(F.lit(0.5), F.lit(0.25), F.lit(0.75)))
    return los.agg(p.alias("_p")).select(
        F.col("_p")[0].alias("median_los"), F.col("_p")[1].alias("iqr_los_25"), F.col("_p")[2].alias("iqr_los_75")
    )


def _real(c: Column) -> Column:
    return F.format_string("%.4f", c.cast("double"))


def _int(c: Column) -> Column:
    return c.cast("long").cast("string")


REPORT_COLUMNS = ["section", "category", "mean", "median", "min", "max", "standard_deviation", "count", "percent"]


def summary_report(visits: DataFrame, person: DataFrame, death: DataFrame, concept: DataFrame) -> DataFrame:
    """One text report of seven branches (UNION ALL), from the cohort visits, the
    registry person and death tables and the vocabulary."""
    first = first_visit(visits)
    age = age_at_first_visit(person, first)
    demo = demographics(person, age)
    info = death_info(death, concept)
    los = stay(visits, first)
    null = F.lit(None).cast("string")

    def row(df: DataFrame, section: str, **cols: Column) -> DataFrame:
        return df.select(*[(cols.get(c, null) if c != "section" else F.lit(section)).alias(c) for c in REPORT_COLUMNS])

    # ratios of counts (mean age, shares) are rounded half-up on their exact value before the text is
    # written, so the report cannot depend on how an engine rounds a half-way double
    a = age_summary(age).select(
        "*", age.agg(round_ratio(F.sum("age_at_first_visit"), F.count("age_at_first_visit"), 4)).scalar().alias("_mean4")
    )
    race, race_total = _share_counts(demo, concept, "race_concept_id", "race")
    eth, eth_total = _share_counts(demo, concept, "ethnicity_concept_id", "ethnicity")
    parts = [
        row(a, "Age Summary", mean=_real(F.col("_mean4")), median=_real(F.col("median_age")),
            min=_int(F.col("min_age")), max=_int(F.col("max_age")), standard_deviation=_real(F.col("age_sd"))),
        row(race, "Race Summary", category=F.col("race"), count=_int(F.col("count")),
            percent=_real(round_ratio(F.col("count"), race_total, 4, 100))),
        row(eth, "Ethnicity Summary", category=F.col("ethnicity"), count=_int(F.col("count")),
            percent=_real(round_ratio(F.col("count"), eth_total, 4, 100))),
    ]
    d = death_summary(info)
    for cat, col in (("Total Deaths", "total_deaths"), ("Causes of Death", "causes_of_death"),
                     ("Cause Source Values", "causes_source_value")):
        parts.append(row(d, "Death Summary", category=F.lit(cat), count=_int(F.col(col))))
    s = stay_summary(los)
    parts.append(row(s, "Length of Stay Summary", category=F.lit("Median Length of Stay (days)"),
                     median=_real(F.col("median_los")), min=_real(F.col("iqr_los_25")), max=_real(F.col("iqr_los_75"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
