"""Every registered query against its DuckDB oracle at sf0.01 (row count, columns, value hash),
plus the smoke entry and the sizes stated in FIXTURES.md §3."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF01
from cohortkit.oracle.compare import compare, duck
from cohortkit.plans.catalog import REGISTRY

QUERIES = {k: v for k, v in entry.queries().items() if k in REGISTRY}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in REGISTRY}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 26
    assert df.columns == ["person_id", "visit_occurrence_id", "visit_start_date", "visit_end_date", "birth_date", "death_date"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(name, QUERIES[name](spark, SF01), con, SQL[name])
    assert r.ok, (r.rows_spark, r.rows_oracle, r.cols_ok, r.hash_ok, r.note)


def test_fixture_sizes(spark):
    q = lambda n: QUERIES[n](spark, SF01).count()
    assert q("cohort_events") == 903
    assert q("cohort_build") == 264
    assert q("extract_condition_occurrence") == 1114
    assert q("extract_condition_occurrence_distinct") == 802
    assert q("extract_observation") == 267
    assert q("deid_visit_map") == 236
    assert q("deid_condition_occurrence") == 957
    grid = QUERIES["profile_measurement_grid"](spark, SF01).agg(F.sum("persons")).first()[0]
    assert grid == 15680  # cells of the dense grid
    assert q("rare_dropped_m10") == 0  # every concept has a common-enough ancestor


def test_rows_only_queries_run(spark):
    for name in set(QUERIES) - set(SQL):
        assert QUERIES[name](spark, SF01).count() >= 0
