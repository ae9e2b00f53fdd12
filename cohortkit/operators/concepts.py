"""Concept sets over a closed vocabulary hierarchy.

``concept_ancestor`` is already the transitive closure with self rows at level 0, so every
hierarchy question is one equi-join, never a recursion. The vocabulary is large (tens of
millions of closure rows in a real warehouse), the registry slice of it is small: every
function filters the closure by the registry ancestors first and only then joins facts.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.plans.broadcast import broadcast_checked

CONCEPT_SET_SCHEMA = T.StructType(
    [
        T.StructField("concept_id", T.LongType(), False),
        T.StructField("concept_code", T.StringType(), True),
        T.StructField("concept_name", T.StringType(), True),
        T.StructField("domain", T.StringType(), True),
        T.StructField("vocabulary", T.StringType(), True),
        T.StructField("is_standard", T.StringType(), True),
        T.StructField("include_descendants", T.BooleanType(), True),
    ]
)


def _as_bool(v) -> bool | None:
    if v is None or isinstance(v, bool):
        return v
    s = str(v).strip().strip("'\"‘’“”").upper()
    if s in ("TRUE", "T", "1", "YES"):
        return True
    if s in ("FALSE", "F", "0", "NO"):
        return False
    return None


def concept_set(spark: SparkSession, rows: Iterable[Sequence]) -> DataFrame:
    """A concept set from literal rows
    (concept_id, concept_code, concept_name, domain, vocabulary, is_standard, include_descendants).
    Text ids are cast to long and the text flag to boolean."""
    clean = [
        (int(r[0]), r[1], r[2], r[3], r[4], r[5], _as_bool(r[6]))
        for r in rows
    ]
    return spark.createDataFrame(clean, CONCEPT_SET_SCHEMA)


def expand_concepts(concept_set: DataFrame, concept_ancestor: DataFrame, domain: str) -> DataFrame:
    """Registry concepts of one domain, expanded to descendants when flagged.

    One row per (descendant concept_id, registry ancestor_concept_id), with the registry name.
    A concept under two registry ancestors appears twice; the bag extracts rely on that.
    """
    cs = concept_set.where(F.col("domain") == domain).select(
        F.col("concept_id").alias("_reg_id"), "concept_name", "include_descendants"
    )
    ca = concept_ancestor.select("ancestor_concept_id", "descendant_concept_id")
    return (
        ca.join(broadcast_checked(cs), F.col("ancestor_concept_id") == F.col("_reg_id"))
        .where(F.col("include_descendants") | (F.col("ancestor_concept_id") == F.col("descendant_concept_id")))
        .select(
            F.col("descendant_concept_id").alias("concept_id"),
            "ancestor_concept_id",
            "concept_name",
        )
    )


def concept_multiplicity(expansion: DataFrame) -> DataFrame:
    """(concept_id, n_anc): how many registry-ancestor rows each concept matches in O03."""
    return expansion.groupBy("concept_id").agg(F.count(F.lit(1)).alias("n_anc"))


def descendants(roots: Sequence[int], concept: DataFrame, concept_ancestor: DataFrame, valid_only: bool = True) -> DataFrame:
    """Distinct descendants (self included) of literal roots, valid concepts only by default."""
    ca = concept_ancestor.where(F.col("ancestor_concept_id").isin([int(r) for r in roots])).select(
        F.col("descendant_concept_id").alias("concept_id")
    )
    c = concept.select("concept_id", "invalid_reason")
    if valid_only:
        c = c.where(F.col("invalid_reason").isNull())
    return ca.join(c.select("concept_id"), "concept_id", "inner").distinct()


def closure_slice(concept_ancestor: DataFrame, observed: DataFrame, on: str = "descendant_concept_id") -> DataFrame:
    """Rows of the closure whose ``on`` column is one of the ``observed`` concept ids (a one-column
    DataFrame). The vocabulary's closure is large; the part a cohort touches is small, so it is cut
    with a broadcast semi join first and can then itself be broadcast against the facts."""
    ids = observed.select(observed.columns[0]).distinct().withColumnRenamed(observed.columns[0], on)
    return concept_ancestor.join(broadcast_checked(ids), on, "left_semi")


def concept_slice(concept: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``concept`` for the given ids (a one-column DataFrame), cut the same way."""
    keys = ids.select(ids.columns[0]).distinct().withColumnRenamed(ids.columns[0], "concept_id")
    return concept.join(broadcast_checked(keys), "concept_id", "left_semi")
