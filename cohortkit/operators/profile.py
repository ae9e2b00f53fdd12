"""Cohort profiles (O45-O63): condition prevalence, measurement percentiles, drug ingredients,
unmapped drug review, device use.

Scale notes:
* totals in ratios are uncorrelated scalar subqueries (``DataFrame.scalar()``): computed once,
  no join against a one-row table;
* distinct persons are counted by bitmaps (``operators.distinct``), which a closure fan-out merges;
* percentiles and ranks of the persons x concepts grid are computed from per-concept
  histograms of the non-zero counts plus an implicit zero bucket (``N - persons with a
  record``), so neither the dense grid nor a window over all persons of a concept is built;
  the grid itself is given as its non-zero cells and one row for the zeros of each concept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.arith import int_div, mean, percent
from cohortkit.operators.bag import TIMES, times, weight_columns
from cohortkit.operators.concepts import closure_slice
from cohortkit.operators.distinct import count_persons, person_bitmaps
from cohortkit.operators.intervals import count_covering
from cohortkit.plans.broadcast import broadcast_checked


def _n_persons(person: DataFrame) -> Column:
    return person.agg(F.countDistinct("person_id")).scalar()


# ------------------------------------------------------------------ conditions
def prevalence_observed(cond: DataFrame, concept_ancestor: DataFrame, concept: DataFrame, person: DataFrame,
                        concept_col: str = "condition_concept_id", integer: bool = True) -> DataFrame:
    """Persons per ancestor that is itself an observed concept (descendants included)."""
    persons = person_bitmaps(cond, [F.col(concept_col).alias("_c")])
    observed = cond.select(F.col(concept_col).alias("ancestor_concept_id")).distinct()
    ca = (
        closure_slice(concept_ancestor, observed, on="ancestor_concept_id")
        .join(broadcast_checked(observed.withColumnRenamed("ancestor_concept_id", "descendant_concept_id")),
              "descendant_concept_id", "left_semi")
        .select(F.col("descendant_concept_id").alias("_c"), "ancestor_concept_id")
    )
    per = count_persons(persons.join(broadcast_checked(ca), "_c"), ["ancestor_concept_id"], "persons_with_condition_or_descendant")
    names = concept.select(F.col("concept_id").alias("ancestor_concept_id"), F.col("concept_name").alias("condition_name"))
    return per.join(names, "ancestor_concept_id", "left").select(
        "condition_name", "ancestor_concept_id", "persons_with_condition_or_descendant",
        percent(F.col("persons_with_condition_or_descendant"), _n_persons(person), integer).alias("percent_persons_with_condition"),
    )


def prevalence_registry(cond: DataFrame, closure: DataFrame, person: DataFrame, concept_col: str = "condition_concept_id",
                        integer: bool = True) -> DataFrame:
    """Persons per registry parent; ``closure`` is ``expand_concepts(.., 'Condition')``."""
    persons = person_bitmaps(cond, [F.col(concept_col).alias("concept_id")])
    per = count_persons(persons.join(broadcast_checked(closure), "concept_id"), ["ancestor_concept_id", "concept_name"], "persons_with_condition")
    return per.select(
        F.col("concept_name").alias("condition_name"), "ancestor_concept_id", "persons_with_condition",
        percent(F.col("persons_with_condition"), _n_persons(person), integer).alias("percent_persons_with_condition"),
    )


# ------------------------------------------------------------------ grids, ranks, percentiles
def _grid_keys(closure: DataFrame, grain: str) -> tuple[DataFrame, str]:
    key = "ancestor_concept_id" if grain == "ancestor" else "concept_id"
    return closure.select(F.col(key).alias("_gk"), "concept_name"), key


def sparse_counts(fact: DataFrame, closure: DataFrame, person: DataFrame, concept_col: str, grain: str = "ancestor") -> DataFrame:
    """Non-zero cells of the grid: (person_id, concept_id, concept_name, concept_count) for
    persons of ``person``; a record counts once per matching closure row, as the reference's join."""
    cl = closure.select(F.col("concept_id").alias(concept_col), "ancestor_concept_id", "concept_name")
    key = "ancestor_concept_id" if grain == "ancestor" else concept_col
    return (
        fact.select("person_id", concept_col, times(fact).alias(TIMES))
        .join(person.select("person_id").distinct(), "person_id", "left_semi")
        .join(broadcast_checked(cl), concept_col)
        .groupBy("person_id", F.col(key).alias("concept_id"), "concept_name")
        .agg(F.sum(TIMES).alias("concept_count"))
    )


def count_grid(fact: DataFrame, closure: DataFrame, person: DataFrame, concept_col: str, grain: str = "ancestor") -> DataFrame:
    """The persons x concepts grid of counts, without writing its zeros one by one: a row per
    non-zero cell (``persons`` = 1) and, per concept, one row with a null person_id and count 0
    that stands for ``persons`` cells. No row is left out; the dense form would be persons x concepts."""
    cells = sparse_counts(fact, closure, person, concept_col, grain)
    rows = person.agg(F.countDistinct("person_id")).scalar()
    zeros = count_histogram(cells, closure, rows, grain).where("concept_count = 0")
    return cells.select(
        F.col("person_id"), "concept_id", "concept_name", F.col("concept_count").cast("long").alias("concept_count"), F.lit(1).cast("long").alias("persons"),
    ).unionByName(zeros.select(
        F.lit(None).cast(person.schema["person_id"].dataType).alias("person_id"), "concept_id", "concept_name", "concept_count", F.col("n").alias("persons")))


def count_histogram(sparse: DataFrame, closure: DataFrame, n_rows: Column, grain: str = "ancestor") -> DataFrame:
    """(concept_id, concept_name, concept_count, n, lo, hi): for each count value of a concept, how
    many persons have it and the rank range [lo, hi] they take in ascending order; the zero
    bucket holds ``n_rows`` minus the persons with a record. One row per distinct count value."""
    keys, _ = _grid_keys(closure, grain)
    concepts = keys.select(F.col("_gk").alias("concept_id"), "concept_name").distinct()
    nonzero = sparse.groupBy("concept_id", "concept_name", "concept_count").agg(F.count(F.lit(1)).alias("n"))
    persons_with = nonzero.groupBy("concept_id", "concept_name").agg(F.sum("n").alias("_with"))
    zeros = concepts.join(persons_with, ["concept_id", "concept_name"], "left").select(
        "concept_id", "concept_name", F.lit(0).cast("long").alias("concept_count"),
        (n_rows - F.coalesce(F.col("_with"), F.lit(0))).cast("long").alias("n"),
    ).where(F.col("n") > 0)
    h = nonzero.select("concept_id", "concept_name", "concept_count", F.col("n").cast("long")).unionByName(zeros)
    w = Window.partitionBy("concept_id").orderBy("concept_count").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return h.withColumn("hi", F.sum("n").over(w)).withColumn("lo", F.col("hi") - F.col("n") + 1)


def rank_counts(fact: DataFrame, closure: DataFrame, person: DataFrame, concept_col: str, grain: str = "ancestor") -> DataFrame:
    """The grid ranked by count within its concept, as (concept_name, concept_id, concept_count, lo,
    hi): cells of equal count are interchangeable and take the ranks lo to hi."""
    rows = person.agg(F.countDistinct("person_id")).scalar()
    h = count_histogram(sparse_counts(fact, closure, person, concept_col, grain), closure, rows, grain)
    return h.select("concept_name", "concept_id", "concept_count", "lo", "hi")


def rank_percentiles(fact: DataFrame, closure: DataFrame, person: DataFrame, concept_col: str,
                     q100: Sequence[int] = (25, 50, 75, 95), grain: str = "ancestor") -> DataFrame:
    """Per concept, the count at rank FLOOR(q * N) (N = rows of ``person``), for each q.
    Null when that rank is below 1 (Q24)."""
    # grid rows per concept = distinct persons; the rank picked uses COUNT(person_id) as the reference
    rows = person.agg(F.countDistinct("person_id")).scalar()
    n = person.agg(F.count("person_id")).scalar()
    h = count_histogram(sparse_counts(fact, closure, person, concept_col, grain), closure, rows, grain)
    # ranks are projected first: a scalar subquery may not sit inside an aggregate
    ranked = h.select("concept_id", "concept_count", "lo", "hi",
                      *[int_div(F.lit(int(q)) * n, F.lit(100)).alias(f"_k{int(q)}") for q in q100])
    cols = [
        F.max(F.when((F.col("lo") <= F.col(f"_k{int(q)}")) & (F.col(f"_k{int(q)}") <= F.col("hi")), F.col("concept_count")))
        .alias(f"p{int(q)}")
        for q in q100
    ]
    return ranked.groupBy("concept_id").agg(*cols)


def percentile_report(fact: DataFrame, closure: DataFrame, person: DataFrame, concept_col: str) -> DataFrame:
    """Percentiles 25/50/75/95 per registry concept with a sentence; a null percentile makes
    the sentence null (null-propagating concatenation, as the reference)."""
    pct = rank_percentiles(fact, closure, person, concept_col)
    concepts = closure.select(F.col("ancestor_concept_id").alias("concept_id"), "concept_name").distinct()
    j = concepts.join(pct, "concept_id", "left")
    s = lambda c: F.col(c).cast("string")
    text = F.when(
        F.col("p50") == 0,
        F.concat(F.lit("At least half of the patients have no record of this measurement; 5% have "), s("p95"),
                 F.lit(" or more records.")),
    ).otherwise(
        F.concat(F.lit("Half of the patients have "), s("p50"), F.lit(" or more records; the middle half have "),
                 s("p25"), F.lit(" to "), s("p75"), F.lit("; 5% have "), s("p95"), F.lit(" or more."))
    )
    return j.select(
        "concept_name", "concept_id",
        F.col("p25").alias("percentile_25"), F.col("p50").alias("median"),
        F.col("p75").alias("percentile_75"), F.col("p95").alias("percentile_95"),
        text.alias("interpretation"),
    )


# ------------------------------------------------------------------ drugs
def drugs_given(drug: DataFrame, concept: DataFrame) -> DataFrame:
    """Distinct (concept_id, concept_name) of the drugs given; ids missing from the
    vocabulary give a null row, as the reference's left join selects the vocabulary's id."""
    ids = drug.select(F.col("drug_concept_id").alias("_d")).distinct()
    c = concept.select("concept_id", "concept_name")
    return ids.join(c, F.col("_d") == F.col("concept_id"), "left").select("concept_id", "concept_name").distinct()


def ingredient_map(drug: DataFrame, concept_ancestor: DataFrame, concept: DataFrame) -> DataFrame:
    """(drug_concept_id, drug_concept_name, ingredient_concept_id, ingredient_name);
    combination drugs fan out to each ingredient."""
    given = drugs_given(drug, concept)
    ing = concept.where(F.col("concept_class_id") == "Ingredient").select(
        F.col("concept_id").alias("ingredient_concept_id"), F.col("concept_name").alias("ingredient_name")
    )
    used = given.select(F.col("concept_id").alias("descendant_concept_id"))
    ca = closure_slice(concept_ancestor, used).select(
        F.col("descendant_concept_id").alias("drug_concept_id"), F.col("ancestor_concept_id").alias("ingredient_concept_id")
    )
    return (
        given.select(F.col("concept_id").alias("drug_concept_id"), F.col("concept_name").alias("drug_concept_name"))
        .join(broadcast_checked(ca), "drug_concept_id")
        .join(broadcast_checked(ing), "ingredient_concept_id")
        .select("drug_concept_id", "drug_concept_name", "ingredient_concept_id", "ingredient_name")
    )


def exposure_by_ingredient(drug: DataFrame, imap: DataFrame) -> DataFrame:
    """(ingredient_name, ingredient_concept_id, drug_concept_id, person_id); unmapped drugs keep
    a null ingredient (left join)."""
    m = imap.select(F.col("drug_concept_id").alias("_dc"), "ingredient_name", "ingredient_concept_id")
    return drug.join(broadcast_checked(m), F.col("drug_concept_id") == F.col("_dc"), "left").select(
        "ingredient_name", "ingredient_concept_id", "drug_concept_id", "person_id", *weight_columns(drug)
    )


def _ingredient_doses(exposure: DataFrame) -> DataFrame:
    """(person_id, ingredient_concept_id, ingredient_name, n): a person's administrations of an ingredient; 0 for
    drugs without one."""
    mapped = F.when(F.col("ingredient_concept_id").isNotNull(), times(exposure)).otherwise(F.lit(0).cast("long"))
    return exposure.groupBy("person_id", "ingredient_concept_id", "ingredient_name").agg(F.sum(mapped).alias("n"))


def ingredient_use(exposure: DataFrame, integer: bool = True) -> DataFrame:
    """Persons per ingredient and their integer percent of persons with any exposure."""
    total = exposure.agg(F.countDistinct("person_id")).scalar()
    keys = ["ingredient_concept_id", "ingredient_name"]
    per = count_persons(person_bitmaps(exposure, keys), keys, "person_count")
    return per.select("ingredient_name", "ingredient_concept_id", "person_count",
                      percent(F.col("person_count"), total, integer).alias("person_perc"))


def ingredient_intensity(exposure: DataFrame, integer: bool = True) -> DataFrame:
    """Integer mean and max administrations per person, per ingredient."""
    return _ingredient_doses(exposure).groupBy("ingredient_concept_id", "ingredient_name").agg(
        mean(F.sum("n"), F.count("n"), integer).alias("average_admin_per_person"),
        F.max("n").alias("max_admin_per_person"),
    )


def ingredient_profile(drug: DataFrame, concept_ancestor: DataFrame, concept: DataFrame, integer: bool = True) -> DataFrame:
    """Ingredient summary; the null ingredient has null mean and max, as a join on the id gives. Use and
    intensity come from one count per person and ingredient, so the exposures are shuffled once."""
    exposure = exposure_by_ingredient(drug, ingredient_map(drug, concept_ancestor, concept))
    total = exposure.agg(F.countDistinct("person_id")).scalar()
    per = _ingredient_doses(exposure).groupBy("ingredient_concept_id", "ingredient_name").agg(
        F.count("person_id").alias("person_count"), mean(F.sum("n"), F.count("n"), integer).alias("_mean"), F.max("n").alias("_max"))
    known = lambda c: F.when(F.col("ingredient_concept_id").isNotNull(), F.col(c))
    return per.select(
        "ingredient_name", "ingredient_concept_id", "person_count", percent(F.col("person_count"), total, integer).alias("person_perc"),
        known("_mean").alias("average_admin_per_person"), known("_max").alias("max_admin_per_person"))


# ------------------------------------------------------------------ unmapped drugs
def unmapped_review(raw_drug: DataFrame, visits: DataFrame, min_count: int = 20, cohort_only: bool = False) -> DataFrame:
    """Source values of unmapped drugs (concept 0) seen more than ``min_count`` times, each
    record counted once per extract visit of the person that contains its start date (at least
    once: left join, Q25). The containing-visit count comes from a day-coverage equi-join."""
    d = raw_drug.where(F.col("drug_concept_id") == 0).select("person_id", "drug_exposure_start_date", "drug_source_value")
    # reference: left join, a record outside every visit still counts once (Q25); cohort_only keeps
    # records inside an extract visit only
    j = count_covering(d, "person_id", F.col("drug_exposure_start_date"), visits, "person_id", F.col("visit_start_date"),
                       F.col("visit_end_date"), "k", "inner" if cohort_only else "left")
    visits_or_one = F.greatest(F.col("k"), F.lit(1).cast("long"))
    agg = j.groupBy("drug_source_value").agg(
        F.sum(F.when(F.col("drug_source_value").isNotNull(), visits_or_one).otherwise(0)).cast("long").alias("unmapped_drug_count")
    )
    return agg.where(F.col("unmapped_drug_count") > int(min_count))


# ------------------------------------------------------------------ devices
def device_use(device: DataFrame, closure: DataFrame, person: DataFrame, integer: bool = True) -> DataFrame:
    """Persons per device concept (descendant grain), zero users kept (left join)."""
    dci = closure.select("concept_id", "concept_name")
    users = count_persons(person_bitmaps(device, [F.col("device_concept_id").alias("concept_id")]), ["concept_id"], "_u")
    j = dci.join(users, "concept_id", "left")
    n = F.coalesce(F.col("_u"), F.lit(0)).cast("long")
    return j.groupBy("concept_id", "concept_name").agg(F.max(n).alias("person_count")).select(
        "concept_name", "concept_id", "person_count", percent(F.col("person_count"), _n_persons(person), integer).alias("person_perc")
    )


def device_intensity(device: DataFrame, closure: DataFrame, person: DataFrame, integer: bool = True) -> DataFrame:
    """Integer mean and max records per user (non-zero grid cells only)."""
    sc = sparse_counts(device, closure, person, "device_concept_id", grain="descendant")
    return sc.groupBy("concept_id", "concept_name").agg(
        mean(F.sum("concept_count"), F.count("concept_count"), integer).alias("average_entries_per_person"),
        F.max("concept_count").alias("max_entries_per_person"),
    )


def device_profile(device: DataFrame, closure: DataFrame, person: DataFrame, join_on_name: bool = False,
                   integer: bool = True) -> DataFrame:
    """Device summary, joined on the concept id only (Q26: a device under two registry names
    multiplies); ``join_on_name=True`` joins on (id, name)."""
    use = device_use(device, closure, person, integer)
    inten = device_intensity(device, closure, person, integer).select(
        F.col("concept_id").alias("_ci"), F.col("concept_name").alias("_cn"), "average_entries_per_person", "max_entries_per_person"
    )
    cond = F.col("concept_id") == F.col("_ci")
    if join_on_name:
        cond = cond & (F.col("concept_name") == F.col("_cn"))
    return use.join(inten, cond, "left").select(
        "concept_name", "concept_id", "person_count", "person_perc", "average_entries_per_person", "max_entries_per_person"
    )
