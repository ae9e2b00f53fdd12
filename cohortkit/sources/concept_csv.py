"""Concept-set CSV reader.

The registry's concept-set file is an R-style export: a leading unnamed index column, quoted
text, ``NA`` for missing codes, a bare or quoted TRUE/FALSE flag, and some rows written with
typographic (curly) quotes. Lines are read as text, quotes normalised, then parsed with
``from_csv`` - every step a built-in expression over a distributed read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.operators.concepts import CONCEPT_SET_SCHEMA

_RAW_SCHEMA = (
    "idx STRING, concept_id STRING, concept_code STRING, concept_name STRING, domain STRING, "
    "vocabulary STRING, is_standard STRING, include_descendants STRING"
)
# Typographic double and single quotes normalised to the ASCII double quote.
_CURLY = "[“”„‟‘’]"


def read_concept_set(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path)
    clean = lines.select(F.regexp_replace("value", _CURLY, '"').alias("line")).where(F.trim("line") != "")
    parsed = clean.select(F.from_csv("line", _RAW_SCHEMA, {"nullValue": "NA", "quote": '"'}).alias("r")).select("r.*")
    flag = F.upper(F.trim(F.col("include_descendants")))
    out = parsed.select(
        F.expr("try_cast(concept_id AS BIGINT)").alias("concept_id"),
        F.when(F.upper(F.col("concept_code")) == "NA", F.lit(None)).otherwise(F.col("concept_code")).alias("concept_code"),
        "concept_name",
        "domain",
        "vocabulary",
        "is_standard",
        F.when(flag == "TRUE", True).when(flag == "FALSE", False).alias("include_descendants"),
    ).where(F.col("concept_id").isNotNull())  # the header row has no numeric id
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CONCEPT_SET_SCHEMA.fields])
