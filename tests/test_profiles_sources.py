"""Percentiles and ranks against the dense grid, drug/device/unmapped quirks, summary pieces, sources
and the target contract."""

import datetime as dt
import os

import pytest
from conftest import SF001
from helpers import D, F, ancestor_df, cohort_df, concept_set_df, table

from cohortkit.operators import profile as PR
from cohortkit.operators import summary as S
from cohortkit.operators.concepts import concept_set, expand_concepts
from cohortkit.plans.catalog import Ctx
from cohortkit.schemas import violations
from cohortkit.sources.concept_csv import read_concept_set
from cohortkit.sources.fixtures import event_stream, vocabulary


def _grid_inputs(spark, n_persons, counts):
    """counts: {person: {leaf: n}}; registry ancestor 100 over leaves 1, 2."""
    person = table(spark, "person", [{"person_id": p, "gender_concept_id": 1} for p in range(n_persons)])
    rows, i = [], 0
    for p, per in counts.items():
        for leaf, n in per.items():
            for _ in range(n):
                rows.append({"measurement_id": i, "person_id": p, "measurement_concept_id": leaf, "measurement_date": D(2020, 1, 1)})
                i += 1
    meas = table(spark, "measurement", rows)
    closure = expand_concepts(concept_set_df(spark, [(100, "M", "Measurement", True)]),
                              ancestor_df(spark, [(100, 100, 0), (100, 1, 1), (100, 2, 1)]), "Measurement")
    return person, meas, closure


@pytest.mark.parametrize("n_persons", [3, 4, 20])
def test_percentiles_and_ranks_match_dense_grid(spark, n_persons):
    counts = {p: {1: p % 3, 2: (p * 7) % 4} for p in range(0, n_persons, 2)}
    person, meas, closure = _grid_inputs(spark, n_persons, counts)
    grid = PR.count_grid(meas, closure, person, "measurement_concept_id")
    cells = grid.collect()
    assert {r["person_id"]: r["concept_count"] for r in cells if r["person_id"] is not None} == {
        p: sum(per.values()) for p, per in counts.items() if sum(per.values())}
    dense = sorted(r["concept_count"] for r in cells for _ in range(r["persons"]))
    assert len(dense) == n_persons
    ranks = PR.rank_counts(meas, closure, person, "measurement_concept_id")
    assert sorted((k, r["concept_count"]) for r in ranks.collect() for k in range(r["lo"], r["hi"] + 1)) == list(enumerate(dense, start=1))
    pct = PR.rank_percentiles(meas, closure, person, "measurement_concept_id").first()
    for q in (25, 50, 75, 95):
        k = q * n_persons // 100
        assert pct[f"p{q}"] == (dense[k - 1] if k >= 1 else None)
    rep = PR.percentile_report(meas, closure, person, "measurement_concept_id").first()
    if n_persons < 4:
        assert rep["percentile_25"] is None
        assert rep["interpretation"] is None or rep["median"] == 0


def test_unmapped_review_threshold_and_visit_fanout(spark):
    rows = []
    for i in range(21):
        rows.append({"drug_exposure_id": i, "person_id": 1, "drug_concept_id": 0, "drug_source_value": "twentyone",
                     "drug_exposure_start_date": D(2020, 1, 1) + dt.timedelta(days=100 + i)})
    for i in range(20):
        rows.append({"drug_exposure_id": 100 + i, "person_id": 1, "drug_concept_id": 0, "drug_source_value": "twenty",
                     "drug_exposure_start_date": D(2020, 1, 1) + dt.timedelta(days=100 + i)})
    for i in range(11):  # 11 records inside two overlapping visits -> 22
        rows.append({"drug_exposure_id": 200 + i, "person_id": 2, "drug_concept_id": 0, "drug_source_value": "overlap",
                     "drug_exposure_start_date": D(2020, 3, 5)})
    drug = table(spark, "drug_exposure", rows)
    visits = cohort_df(spark, [(2, 1, D(2020, 3, 1), D(2020, 3, 10)), (2, 2, D(2020, 3, 5), D(2020, 3, 6))])
    got = {r[0]: r[1] for r in PR.unmapped_review(drug, visits, 20).collect()}
    assert got == {"twentyone": 21, "overlap": 22}


def test_stay_ties_give_two_rows(spark):
    visits = cohort_df(spark, [(1, 1, D(2020, 1, 1), D(2020, 1, 3)), (1, 2, D(2020, 1, 1), D(2020, 1, 9)),
                               (1, 3, D(2020, 2, 1), D(2020, 2, 2))])
    los = S.stay(visits, S.first_visit(visits))
    assert sorted(r["length_of_stay"] for r in los.collect()) == [2, 8]
    s = S.stay_summary(los).first()
    assert s["median_los"] == 5.0 and s["iqr_los_25"] == 3.5


def test_read_concept_set_csv(spark):
    path = os.path.join(os.path.dirname(__file__), "data", "concept_set_sample.csv")
    rows = {r["concept_id"]: r for r in read_concept_set(spark, path).collect()}
    assert sorted(rows) == [101, 102, 301, 302, 303, 2001]
    assert rows[102]["concept_name"] == "Beta, gamma disorder" and rows[102]["include_descendants"] is False
    assert rows[2001]["concept_code"] is None and rows[301]["concept_code"] is None   # bare and quoted NA
    assert rows[302]["concept_code"] == "77-7" and rows[302]["include_descendants"] is True   # curly quotes
    assert rows[303]["include_descendants"] is False


def test_concept_set_literal_rows(spark):
    df = concept_set(spark, [("317", "c", "Name", "Condition", "SNOMED", "S", "TRUE"), ("9", None, "x", "Device", "C", "C", "FALSE")])
    assert [(r[0], r[6]) for r in df.orderBy("concept_id").collect()] == [(9, False), (317, True)]


def test_contract_violations(spark):
    obs = table(spark, "observation", [
        {"observation_id": 1, "person_id": 1, "observation_concept_id": 5, "observation_date": D(2020, 1, 1),
         "value_as_string": "x" * 61},
        {"observation_id": 2, "person_id": 1, "observation_concept_id": 5, "observation_date": None, "value_as_string": "ok"},
    ])
    v = {(r["column_name"], r["rule"]): r["violations"] for r in violations(obs, "observation").collect()}
    assert v[("value_as_string", "max_length_60")] == 1
    assert v[("observation_date", "not_null")] == 1
    assert v[("observation_id", "not_null")] == 0


def test_share_excludes_unmapped_ids(spark):
    demo = spark.createDataFrame([(1, 5), (2, 5), (3, 6), (4, 99)], "person_id bigint, race_concept_id bigint")
    concept = spark.createDataFrame([(5, "A"), (6, "B")], "concept_id bigint, concept_name string")
    got = {r["race"]: (r["count"], round(r["percent"], 4)) for r in S.share(demo, concept, "race_concept_id", "race").collect()}
    assert got == {"A": (2, 66.6667), "B": (1, 33.3333)}


def test_unmapped_review_cohort_only(spark):
    rows = [{"drug_exposure_id": i, "person_id": 1, "drug_concept_id": 0, "drug_source_value": "x",
             "drug_exposure_start_date": D(2020, 1, 1) + dt.timedelta(days=i)} for i in range(30)]
    drug = table(spark, "drug_exposure", rows)
    visits = cohort_df(spark, [(1, 1, D(2020, 1, 1), D(2020, 1, 22))])
    assert PR.unmapped_review(drug, visits, 20).first()["unmapped_drug_count"] == 30
    assert PR.unmapped_review(drug, visits, 20, cohort_only=True).first()["unmapped_drug_count"] == 22


def test_device_profile_join_on_name(spark):
    # descendant 1 sits under two registry concepts with different names (Q26)
    closure = expand_concepts(
        concept_set_df(spark, [(100, "A", "Device", True), (200, "B", "Device", True)]),
        ancestor_df(spark, [(100, 100, 0), (100, 1, 1), (200, 200, 0), (200, 1, 1)]), "Device")
    person = table(spark, "person", [{"person_id": p, "gender_concept_id": 1} for p in range(4)])
    dev = table(spark, "device_exposure", [
        {"device_exposure_id": i, "person_id": i % 2, "device_concept_id": 1, "device_exposure_start_date": D(2020, 1, 1)}
        for i in range(5)
    ])
    ref = [r for r in PR.device_profile(dev, closure, person).collect() if r["concept_id"] == 1]
    by_name = [r for r in PR.device_profile(dev, closure, person, join_on_name=True).collect() if r["concept_id"] == 1]
    assert len(ref) == 4 and len(by_name) == 2
    assert {r["person_count"] for r in by_name} == {2} and {r["max_entries_per_person"] for r in by_name} == {3}


def test_real_valued_percent_option(spark):
    closure = expand_concepts(concept_set_df(spark, [(100, "A", "Device", True)]), ancestor_df(spark, [(100, 100, 0)]), "Device")
    person = table(spark, "person", [{"person_id": p, "gender_concept_id": 1} for p in range(3)])
    dev = table(spark, "device_exposure", [
        {"device_exposure_id": i, "person_id": i % 2, "device_concept_id": 100, "device_exposure_start_date": D(2020, 1, 1)}
        for i in range(3)
    ])
    ref = PR.device_profile(dev, closure, person).first()
    real = PR.device_profile(dev, closure, person, integer=False).first()
    assert (ref["person_perc"], ref["average_entries_per_person"]) == (66, 1)
    assert round(real["person_perc"], 4) == 66.6667 and real["average_entries_per_person"] == 1.5


def test_invalid_leaf_stands_under_its_groups(spark, tmp_path):
    spark.createDataFrame([(7, "a", "MEDIUM", "Brand#12", 50), (8, "b", "MEDIUM", "Brand#12", 3)],
                          "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    concept, ancestor, concepts = vocabulary(spark, str(tmp_path))
    assert [r[0] for r in concept.where("invalid_reason IS NOT NULL").select("concept_id").collect()] == [1000007]
    above = ancestor.where("descendant_concept_id = 1000007").select("ancestor_concept_id", "min_levels_of_separation")
    assert sorted(tuple(r) for r in above.collect()) == [(10003, 2), (20312, 1), (30350, 1), (1000007, 0)]
    # the root is a registry entry with descendants, the leaf one without
    reg = expand_concepts(concepts, ancestor, "Measurement").where("concept_id = 1000007").select("ancestor_concept_id")
    assert sorted(r[0] for r in reg.collect()) == [10003, 1000007]


def test_events_of_persons_and_concepts(spark, tmp_path):
    """Persons or concepts that are asked for leave the others out, and no more."""
    day = dt.datetime(1999, 5, 1)
    spark.createDataFrame([(1, 5, day), (1, 5, day), (2, 6, day), (3, None, day), (4, 5, None)],
                          "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    items = [(o, p, 1, line, 12.0, 3.5, flag, status) for o in (1, 2, 3, 4, None) for p, line, flag, status in
             ((7, 1, "R", "O"), (7, 4, "R", "F"), (8, 1, "N", None), (None, 2, "N", "F"), (8, 2, None, "F"))]
    spark.createDataFrame(items, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                                 "l_extendedprice double, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(7, "a", "STANDARD", "Brand#2", 4), (8, "b", "SMALL", "Brand#3", 5)],
                          "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    rows = lambda df: sorted(map(str, df.collect()))
    whole = event_stream(spark, str(tmp_path))
    assert whole.count() == 5 * 4
    persons = spark.createDataFrame([(5,), (5,), (9,), (None,)], "person_id bigint")
    assert rows(event_stream(spark, str(tmp_path), persons=persons)) == rows(whole.where("pid = 5"))
    concepts = spark.createDataFrame([(1000007,), (0,), (None,)], "concept_id bigint")
    assert rows(event_stream(spark, str(tmp_path), concepts=concepts)) == rows(whole.where("cid IN (0, 1000007)"))


def test_extracts_do_not_write_every_event(spark):
    """A death needs the cohort's diagnoses, an extract the cohort's events; neither writes the whole stream."""
    c = Ctx(spark, SF001)
    c.deid("death")
    assert not {"src_events", "cohort_events", "src_visit_occurrence"} & set(c.store._done)
    c.extract("device_exposure")
    assert "src_events" not in c.store._done
    held = spark.read.parquet(c.store.path("cohort_events")).select("pid").distinct()
    assert held.join(c.cohort(), held.pid == c.cohort().person_id, "left_anti").isEmpty()
