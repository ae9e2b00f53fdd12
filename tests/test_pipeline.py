"""The end-to-end runner publishes what the registered queries give, keeps ids over runs, quarantines rows that break
the contract, and leaves nothing of a run that stopped."""

import datetime as dt
import os
import uuid

import pytest
from conftest import SF001
from helpers import F

import __spark_entry__ as entry
from cohortkit.operators.bag import TIMES
from cohortkit.params import FIXTURE_PARAMS
from cohortkit.plans import pipeline as PL
from cohortkit.plans.broadcast import written
from cohortkit.plans.publish import last_published, published, remove_unpublished
from cohortkit.session import ensure_checkpoint_dir
from cohortkit.sources.fixtures import clinical_view


def _root(spark):
    return f"{ensure_checkpoint_dir(spark)}/pipeline-test-{uuid.uuid4().hex[:8]}"


def _local(path):
    return path.removeprefix("file:")


@pytest.fixture(scope="module")
def first(spark):
    """A run of the half of the persons that are numbered last, with a visit without its end and a text that is too long."""
    root = _root(spark)
    tables = {name: written(df) for name, df in clinical_view(spark, SF001).as_dict().items()}
    inside = entry.queries()["cohort_build"](spark, SF001).where("person_id % 2 = 0").agg(F.min("visit_occurrence_id")).first()[0]
    known = entry.queries()["extract_observation"](spark, SF001).where("person_id % 2 = 0").agg(F.max("observation_id")).first()[0]
    opened = F.when(F.col("visit_occurrence_id") == inside, F.lit(None)).otherwise(F.col("visit_end_date"))
    text = F.when(F.col("observation_id") == known, F.repeat(F.lit("x"), 61)).otherwise(F.substring("value_as_string", 1, 60))
    early = {**tables, "person": tables["person"].where("person_id % 2 = 0"),
             "visit_occurrence": tables["visit_occurrence"].withColumn("visit_end_date", opened),
             "observation": tables["observation"].withColumn("value_as_string", text)}
    return root, tables, PL.run_registry(spark, early, FIXTURE_PARAMS, root, "weighted"), inside, known


def test_rows_that_break_the_contract_are_quarantined(spark, first):
    root, _, m, visit, observation = first
    folder = f"{root}/{m.run}/quarantine"
    held = spark.read.parquet(f"{folder}/registry_cohort").collect()
    assert {r["visit_occurrence_id"] for r in held} == {visit} and {tuple(r["broken_rules"]) for r in held} == {("visit_end_date: not_null",)}
    held = spark.read.parquet(f"{folder}/deid_observation").collect()
    assert [(r["observation_id"], r["broken_rules"]) for r in held] == [(observation, ["value_as_string: max_length_60"])]
    assert spark.read.parquet(m.tables["registry_cohort"]).where(F.col("visit_occurrence_id") == visit).isEmpty()
    assert spark.read.parquet(m.tables["deid_observation"]).where(F.col("observation_id") == observation).isEmpty()
    assert m.quarantined["deid_observation"] == 1 and set(m.quarantined) == {"registry_cohort", "deid_observation"}


def test_second_run_publishes_the_queries_results_and_keeps_ids(spark, first):
    root, tables, before, _, _ = first
    assert last_published(spark, root) == before and before.number == 1 and set(before.inputs) == set(tables)
    assert not os.path.exists(f"{_local(root)}/{before.run}/stage")
    assert TIMES in spark.read.parquet(before.tables["deid_condition_occurrence"]).columns
    m = PL.run_registry(spark, tables, FIXTURE_PARAMS.with_(as_of=dt.date(2004, 1, 1)), root, ingredients=(20101, 30101), previous=last_published(spark, root))
    for name, key in (("person_map", "id"), ("visit_map", "new_id")):
        old = {r.source_key: r for r in spark.read.parquet(before.tables[name]).collect()}
        new = {r.source_key: r for r in spark.read.parquet(m.tables[name]).collect()}
        assert old and len(new) > len(old) and {k: new[k] for k in old} == old
        assert sorted(r[key] for r in new.values()) == list(range(1, len(new) + 1))
        assert m.watermarks[name] == len(new)
    assert [x.number for x in published(spark, root)] == [1, 2]
    assert {"registry_cohort", "deid_condition_occurrence", "person_map", "profile_device", "summary_report"} <= set(m.tables)
    q = entry.queries()
    for name, query in [
        ("registry_cohort", "cohort_build"),
        ("registry_condition_occurrence", "extract_condition_occurrence"),
        ("registry_drug_exposure", "extract_drug_exposure"),
        ("registry_observation", "extract_observation"),
        ("profile_device", "profile_device"),
        ("profile_ingredient", "profile_ingredient"),
    ]:
        got = spark.read.parquet(m.tables[name])
        want = q[query](spark, SF001)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name
        assert m.rows[name] == want.count()
    with pytest.raises(ValueError, match="another salt"):
        PL.run_registry(spark, tables, FIXTURE_PARAMS.with_(salt="other"), root, previous=m)


def test_run_that_stops_midway_is_not_picked_up(spark, monkeypatch):
    root = _root(spark)
    tables = clinical_view(spark, SF001).as_dict()

    def stop(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(PL.D, "visit_map", stop)
        with pytest.raises(KeyboardInterrupt):
            PL.run_registry(spark, tables, FIXTURE_PARAMS, root)
    assert last_published(spark, root) is None and not [n for n in os.listdir(_local(root)) if n.startswith("run-")]
    # a driver that was lost leaves its folder, which a later run may remove
    spark.range(1).write.parquet(f"{root}/run-lost/stage/x")
    assert last_published(spark, root) is None
    assert remove_unpublished(spark, root, 3600) == [] and remove_unpublished(spark, root, 0) == ["run-lost"]


def test_salt_and_date_are_required(spark):
    for params in (FIXTURE_PARAMS.with_(salt=""), FIXTURE_PARAMS.with_(as_of=None)):
        with pytest.raises(ValueError, match="salt"):
            PL.run_registry(spark, {}, params, "/nowhere")
