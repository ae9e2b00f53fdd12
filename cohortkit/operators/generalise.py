"""Rare-concept generalisation (O21-O28): replace a diagnosis by its most specific ancestor that
is common enough.

The reference rolls every (person, diagnosis) up to all ancestors, counts per ancestor, then
narrows per (person, diagnosis) in three self-joined stages. The candidate ancestors and their
counts depend on the diagnosis alone, so every person gets the same answer; here the choice is
made once per concept with ``min_by`` over (count, level, -ancestor_id), giving a map with one
row per observed concept (thousands of rows) that the facts join by concept id.

Counting rule (Q12): ``count="pairs"`` (reference) counts distinct (person, diagnosis) pairs
under an ancestor; ``count="persons"`` counts distinct persons, the safer privacy rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.operators.bag import times
from cohortkit.operators.concepts import closure_slice
from cohortkit.operators.distinct import count_persons, person_bitmaps
from cohortkit.plans.broadcast import broadcast_checked, join_lookup, written


def person_concepts(facts: DataFrame, concept_col: str = "condition_concept_id") -> DataFrame:
    """The persons of each original concept, as bitmaps: what every count below is based on."""
    return person_bitmaps(facts, [F.col(concept_col).alias("original_concept_id")])


def _persons(pairs: DataFrame) -> DataFrame:
    """(original_concept_id, persons): its distinct (person, concept) pairs."""
    return count_persons(pairs, ["original_concept_id"], "persons")


def concept_person_counts(pairs: DataFrame, concept: DataFrame) -> DataFrame:
    """Persons per original concept, with its name."""
    counts = _persons(pairs).withColumnRenamed("persons", "original_concept_count")
    names = concept.select(F.col("concept_id").alias("original_concept_id"), F.col("concept_name").alias("original_concept_name"))
    return counts.join(names, "original_concept_id", "left").select(
        "original_concept_id", "original_concept_name", "original_concept_count"
    )


def _rollup(pairs: DataFrame, concept_ancestor: DataFrame) -> DataFrame:
    """(original_concept_id, persons, ancestor_concept_id, min_levels_of_separation); ancestor null
    when the concept has no closure row (left join, as the reference)."""
    per_concept = _persons(pairs)
    ca = closure_slice(concept_ancestor, per_concept.select("original_concept_id")).select(
        F.col("descendant_concept_id").alias("original_concept_id"), "ancestor_concept_id", "min_levels_of_separation"
    )
    return per_concept.join(broadcast_checked(ca), "original_concept_id", "left")


def ancestor_counts(pairs: DataFrame, concept_ancestor: DataFrame, concept: DataFrame, count: str = "pairs") -> DataFrame:
    """(ancestor_concept_name, ancestor_concept_id, ancestor_concept_count)."""
    if count == "pairs":
        r = _rollup(pairs, concept_ancestor)
        agg = r.groupBy("ancestor_concept_id").agg(
            F.sum(F.when(F.col("ancestor_concept_id").isNotNull(), F.col("persons")).otherwise(0)).cast("long").alias("ancestor_concept_count")
        )
    elif count == "persons":
        ca = closure_slice(concept_ancestor, pairs.select("original_concept_id")).select(
            F.col("descendant_concept_id").alias("original_concept_id"), "ancestor_concept_id")
        per = count_persons(pairs.join(broadcast_checked(ca), "original_concept_id", "left"), ["ancestor_concept_id"], "_n")
        agg = per.select("ancestor_concept_id", F.when(F.col("ancestor_concept_id").isNotNull(), F.col("_n")).otherwise(0).cast("long").alias("ancestor_concept_count"))
    else:
        raise ValueError(count)
    names = concept.select(F.col("concept_id").alias("ancestor_concept_id"), F.col("concept_name").alias("ancestor_concept_name"))
    return agg.join(names, "ancestor_concept_id", "left").select("ancestor_concept_name", "ancestor_concept_id", "ancestor_concept_count")


def rare_concept_map(
    facts: DataFrame,
    concept_ancestor: DataFrame,
    concept: DataFrame,
    min_count: int = 10,
    concept_col: str = "condition_concept_id",
    count: str = "pairs",
) -> DataFrame:
    """One row per original concept that has an ancestor (self included) with
    count > min_count: (original_concept_id, original_concept_name, original_concept_count,
    revised_concept_id, revised_concept_name, min_levels_of_separation, ancestor_concept_count).

    Choice: lowest ancestor count, then fewest levels, then the highest ancestor id (the
    reference's forced unique ROW_NUMBER ... ORDER BY revised DESC)."""
    pairs = written(person_concepts(facts, concept_col))  # read several times below
    counts = ancestor_counts(pairs, concept_ancestor, concept, count).where(
        F.col("ancestor_concept_count") > int(min_count)
    )
    ca = concept_ancestor.select(
        F.col("descendant_concept_id").alias("original_concept_id"), "ancestor_concept_id", "min_levels_of_separation"
    )
    observed = pairs.select("original_concept_id").distinct()
    cand = ca.join(broadcast_checked(observed), "original_concept_id", "left_semi").join(
        counts.select("ancestor_concept_id", "ancestor_concept_count"), "ancestor_concept_id"
    )
    pick = cand.groupBy("original_concept_id").agg(
        F.min_by(
            F.struct("ancestor_concept_id", "min_levels_of_separation", "ancestor_concept_count"),
            F.struct("ancestor_concept_count", "min_levels_of_separation", (-F.col("ancestor_concept_id")).alias("neg_id")),
        ).alias("best")
    )
    names = concept.select(F.col("concept_id").alias("revised_concept_id"), F.col("concept_name").alias("revised_concept_name"))
    return (
        pick.select(
            "original_concept_id",
            F.col("best.ancestor_concept_id").alias("revised_concept_id"),
            F.col("best.min_levels_of_separation").alias("min_levels_of_separation"),
            F.col("best.ancestor_concept_count").alias("ancestor_concept_count"),
        )
        .join(names, "revised_concept_id", "left")
        .join(concept_person_counts(pairs, concept), "original_concept_id", "left")
        .select(
            "original_concept_id", "original_concept_name", "original_concept_count", "revised_concept_id",
            "revised_concept_name", "min_levels_of_separation", "ancestor_concept_count",
        )
    )


def generalise(facts: DataFrame, concept_map: DataFrame, concept_col: str = "condition_concept_id") -> DataFrame:
    """Facts with the concept replaced by its revised ancestor; facts whose concept has no
    common-enough ancestor are dropped (inner join, Q13). Column order and weights kept."""
    m = concept_map.select(F.col("original_concept_id").alias("_orig"), F.col("revised_concept_id").alias("_rev"))
    cols = facts.columns
    j = join_lookup(facts, m, concept_col, "_orig")
    return j.select(*[F.col("_rev").alias(c) if c == concept_col else F.col(c) for c in cols])


def dropped_facts(facts: DataFrame, concept_map: DataFrame, concept_col: str = "condition_concept_id") -> DataFrame:
    """Q13 report: facts that ``generalise`` drops, counted per original concept."""
    m = concept_map.select(F.col("original_concept_id").alias(concept_col))
    return facts.join(m, concept_col, "left_anti").groupBy(concept_col).agg(F.sum(times(facts)).alias("dropped_records"))
