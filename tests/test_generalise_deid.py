"""Rare-concept map tie-breaks and thresholds; de-identification invariants and window rules."""

import datetime as dt
import random

from helpers import D, F, ancestor_df, concept_df, ids, plan_text, table

from cohortkit.functions.keyed import date_shift
from cohortkit.operators import deid as DE
from cohortkit.operators import generalise as G
from cohortkit.operators.bag import TIMES
from cohortkit.operators.quality import qc_concepts
from cohortkit.operators.rownum import row_number_global


def _facts(spark, pairs):
    """pairs: (person_id, concept_id) -> condition rows"""
    return table(spark, "condition_occurrence", [
        {"condition_occurrence_id": i, "person_id": p, "condition_concept_id": c, "condition_start_date": D(2020, 1, 1)}
        for i, (p, c) in enumerate(pairs)
    ])


def test_threshold_is_strict_and_ties_break_by_level_then_highest_id(spark):
    # concept 1 has ancestors 5 and 6 (both level 1) and 7 (level 2); 2 has ancestor 9 only
    ca = ancestor_df(spark, [(1, 1, 0), (5, 1, 1), (6, 1, 1), (7, 1, 2), (2, 2, 0), (9, 2, 1)])
    c = concept_df(spark, [(i, f"c{i}", "Leaf", None) for i in (1, 2, 5, 6, 7, 9)])
    # 11 persons with concept 1 -> every ancestor of 1 counts 11 (> 10); 10 persons with 2 -> 9 counts 10
    pairs = [(p, 1) for p in range(11)] + [(100 + p, 2) for p in range(10)]
    m = G.rare_concept_map(_facts(spark, pairs), ca, c, min_count=10)
    rows = {r["original_concept_id"]: r for r in m.collect()}
    assert set(rows) == {1}                      # concept 2 and its ancestor have count 10: not > 10
    assert rows[1]["revised_concept_id"] == 1   # self row: level 0 wins the tie on count
    # without the self row, equal counts and levels between 5 and 6: 6 wins
    ca2 = ancestor_df(spark, [(5, 1, 1), (6, 1, 1), (7, 1, 2)])
    m2 = G.rare_concept_map(_facts(spark, pairs), ca2, c, min_count=10).collect()
    assert [(r["original_concept_id"], r["revised_concept_id"], r["min_levels_of_separation"]) for r in m2] == [(1, 6, 1)]


def test_pair_counting_lets_one_person_with_many_subtypes_pass(spark):
    # one person with 11 subtypes of ancestor 50 -> ancestor count 11 (pairs), 1 (persons)
    ca = ancestor_df(spark, [(50, s, 1) for s in range(11)] + [(s, s, 0) for s in range(11)])
    c = concept_df(spark, [(i, f"c{i}", "Leaf", None) for i in list(range(11)) + [50]])
    facts = _facts(spark, [(1, s) for s in range(11)])
    by_pairs = G.rare_concept_map(facts, ca, c, min_count=10)
    by_persons = G.rare_concept_map(facts, ca, c, min_count=10, count="persons")
    assert by_pairs.count() == 11 and by_persons.count() == 0


def test_concept_without_ancestor_row_is_dropped(spark):
    ca = ancestor_df(spark, [(1, 1, 0)])
    c = concept_df(spark, [(1, "c1", "Leaf", None)])
    facts = _facts(spark, [(p, 1) for p in range(12)] + [(0, 77)])
    m = G.rare_concept_map(facts, ca, c, min_count=10)
    out = G.generalise(facts, m)
    assert out.count() == 12
    assert G.dropped_facts(facts, m).collect()[0]["dropped_records"] == 1


def test_row_number_global_equals_window(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([8507, 8532])) for i in rnd.sample(range(100000), 3000)]
    df = spark.createDataFrame(rows, "person_id bigint, gender int").repartition(7)
    got = row_number_global(df, [F.col("gender").desc(), F.col("person_id").desc()], "id")
    want = sorted(rows, key=lambda r: (-r[1], -r[0]))
    assert [(r["person_id"], r["id"]) for r in got.orderBy("id").collect()] == [(p, i + 1) for i, (p, _) in enumerate(want)]
    assert "SinglePartition" not in plan_text(got)


def test_keyed_shift_is_stable_and_bounded(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("k"))
    a = df.select("k", date_shift("salt", F.col("k"), 183).alias("s"))
    b = df.repartition(5).select("k", date_shift("salt", F.col("k"), 183).alias("s"))
    assert a.exceptAll(b).count() == 0
    lo, hi = a.agg(F.min("s"), F.max("s")).first()
    assert -183 <= lo and hi <= 183 and hi - lo > 300
    assert spark.range(1).select(date_shift("salt", F.lit(42).cast("long"), 183)).first()[0] == 151


def _maps(spark, persons, visits, start, end):
    pmap = DE.person_map(persons, "salt", D(2024, 1, 1))
    vmap = DE.visit_map(visits, pmap, start, end)
    return pmap, vmap


def test_window_rules_and_null_routes(spark):
    persons = table(spark, "person", [{"person_id": 42, "gender_concept_id": 8507, "year_of_birth": 1950,
                                       "birth_datetime": dt.datetime(1950, 1, 1), "race_concept_id": 1, "ethnicity_concept_id": 1}])
    shift = 151  # keyed shift of person 42 with salt 'salt'
    start, end = D(2020, 1, 1), D(2020, 12, 31)
    sd = lambda d: d - dt.timedelta(days=shift)  # noqa: E731 source date that lands on d after shifting
    visits = table(spark, "visit_occurrence", [
        {"visit_occurrence_id": 1, "person_id": 42, "visit_concept_id": 9201, "visit_start_date": sd(start), "visit_end_date": sd(end)},
        {"visit_occurrence_id": 2, "person_id": 42, "visit_concept_id": 9201, "visit_start_date": sd(end), "visit_end_date": sd(end + dt.timedelta(days=1))},
    ])
    pmap, vmap = _maps(spark, persons, visits, start, end)
    assert ids(vmap, "source_key") == [1]          # inclusive window for visits
    dv = DE.deidentify(visits, pmap, vmap, DE.DEID_SPECS["visit_occurrence"], start, end)
    assert ids(dv, "visit_start_date") == [start]
    meas = table(spark, "measurement", [
        {"measurement_id": 1, "person_id": 42, "measurement_concept_id": 5, "measurement_date": sd(start), "visit_occurrence_id": 1},
        {"measurement_id": 2, "person_id": 42, "measurement_concept_id": 5, "measurement_date": sd(end), "visit_occurrence_id": 1},
        {"measurement_id": 3, "person_id": 42, "measurement_concept_id": 5, "measurement_date": sd(start + dt.timedelta(days=1)),
         "visit_occurrence_id": 2},
    ])
    dm = DE.deidentify(meas, pmap, vmap, DE.DEID_SPECS["measurement"], start, end).collect()
    assert [(r["measurement_id"], r["visit_occurrence_id"]) for r in dm] == [(3, None)]  # exclusive; unmapped visit -> null
    drug = table(spark, "drug_exposure", [
        {"drug_exposure_id": 1, "person_id": 42, "drug_concept_id": 5, "drug_exposure_start_date": sd(start + dt.timedelta(days=3))},
    ])
    dev = table(spark, "device_exposure", [
        {"device_exposure_id": 1, "person_id": 42, "device_concept_id": 5, "device_exposure_start_date": sd(start + dt.timedelta(days=3))},
    ])
    assert DE.deidentify(drug, pmap, vmap, DE.DEID_SPECS["drug_exposure"], start, end).count() == 0
    assert DE.deidentify(dev, pmap, vmap, DE.DEID_SPECS["device_exposure"], start, end).count() == 1


def test_over_89_uses_unshifted_birth_and_365_25(spark):
    as_of = D(2024, 6, 30)
    young = as_of - dt.timedelta(days=int(89 * 365.25))       # exactly 89 * 365.25 days (floored): not > 89
    old = as_of - dt.timedelta(days=int(89 * 365.25) + 1)
    persons = table(spark, "person", [
        {"person_id": 1, "gender_concept_id": 8507, "birth_datetime": dt.datetime.combine(young, dt.time())},
        {"person_id": 2, "gender_concept_id": 8507, "birth_datetime": dt.datetime.combine(old, dt.time())},
    ])
    pmap = DE.person_map(persons, "salt", as_of)
    out = {r["gender_concept_id"] and r["person_id"]: r for r in DE.deid_person(persons, pmap, as_of).collect()}
    years = sorted(r["year_of_birth"] for r in out.values())
    repl = [r["over_89_birth_year"] for r in pmap.collect() if r["source_key"] == 2][0]
    assert repl in range(as_of.year - 99, as_of.year - 89)
    assert repl in years
    assert all(r["day_of_birth"] == 1 for r in out.values())


def test_intervals_within_person_are_preserved(spark):
    persons = table(spark, "person", [{"person_id": p, "gender_concept_id": 8507} for p in range(1, 6)])
    rows = [{"condition_occurrence_id": i, "person_id": 1 + i % 5, "condition_concept_id": 5,
             "condition_start_date": D(2020, 1, 1) + dt.timedelta(days=i * 3), "condition_end_date": D(2020, 1, 1) + dt.timedelta(days=i * 3 + i % 4)}
            for i in range(40)]
    cond = table(spark, "condition_occurrence", rows)
    pmap = DE.person_map(persons, "k", D(2024, 1, 1))
    out = DE.deidentify(cond, pmap, None, DE.DEID_SPECS["condition_occurrence"], D(1900, 1, 1), D(2100, 1, 1))
    got = {r["condition_occurrence_id"]: r for r in out.collect()}
    for r in rows:
        g = got[r["condition_occurrence_id"]]
        assert (g["condition_end_date"] - g["condition_start_date"]) == (r["condition_end_date"] - r["condition_start_date"])
    # one shift per person: the gap between two records of a person is unchanged
    a, b = got[0], got[5]
    assert (b["condition_start_date"] - a["condition_start_date"]).days == 15


def test_strict_blanks_linkable_columns(spark):
    persons = table(spark, "person", [{"person_id": 1, "gender_concept_id": 8507}])
    drug = table(spark, "drug_exposure", [{"drug_exposure_id": 5, "person_id": 1, "drug_concept_id": 9, "sig": "take two",
                                           "lot_number": "L1", "drug_exposure_start_date": D(2020, 5, 1),
                                           "drug_exposure_end_date": D(2020, 5, 2)}])
    pmap = DE.person_map(persons, "s", D(2024, 1, 1))
    loose = DE.deidentify(drug, pmap, None, DE.DEID_SPECS["drug_exposure"], D(2000, 1, 1), D(2030, 1, 1)).first()
    strict = DE.deidentify(drug, pmap, None, DE.DEID_SPECS["drug_exposure"], D(2000, 1, 1), D(2030, 1, 1), strict=True).first()
    assert loose["sig"] == "take two" and strict["sig"] is None and strict["lot_number"] is None
    assert strict["drug_exposure_id"] == 5


def test_visit_map_continues_after_existing_ids(spark):
    persons = table(spark, "person", [{"person_id": 42, "gender_concept_id": 8507}])
    visits = table(spark, "visit_occurrence", [
        {"visit_occurrence_id": v, "person_id": 42, "visit_concept_id": 9201,
         "visit_start_date": D(2020, 6, 1), "visit_end_date": D(2020, 6, 2)} for v in (7, 3, 9)
    ])
    pmap = DE.person_map(persons, "salt", D(2024, 1, 1))
    existing = spark.createDataFrame([(3, 1), (5, 2)], "source_key bigint, new_id bigint")
    vmap = DE.visit_map(visits, pmap, D(2000, 1, 1), D(2030, 1, 1), existing=existing)
    got = sorted((r["source_key"], r["new_id"]) for r in vmap.collect())
    assert got == [(3, 1), (5, 2), (7, 3), (9, 4)]


def test_person_map_over_refreshes(spark):
    """A new person that sorts first changes no old id, shift or birth year; ids are never given anew."""
    def persons(rows):
        return table(spark, "person", [{"person_id": p, "gender_concept_id": g} for p, g in rows])

    first = DE.person_map(persons([(1, 8507), (5, 8532), (9, 8507)]), "salt", D(2024, 1, 1))
    old = {r["source_key"]: r for r in first.collect()}
    assert [old[k]["id"] for k in (5, 9, 1)] == [1, 2, 3]
    second = DE.person_map(persons([(1, 8507), (5, 8507), (77, 8532), (99, 8532), (9, 8507)]), "salt", D(2031, 6, 1), existing=first)
    new = {r["source_key"]: r for r in second.collect()}
    assert {k: new[k] for k in old} == old and [new[99]["id"], new[77]["id"]] == [4, 5]
    # the highest id ever given counts, although its row has left the map
    third = DE.person_map(persons([(123, 8507)]), "salt", D(2031, 6, 1), existing=second.where("id < 3"), watermark=5)
    assert sorted(r["id"] for r in third.collect()) == [1, 2, 6]


def test_weights_are_carried_and_counted(spark):
    facts = _facts(spark, [(1, 5), (2, 5), (3, 6)]).withColumn(TIMES, F.col("person_id"))
    m = spark.createDataFrame([(5, 50)], "original_concept_id bigint, revised_concept_id bigint")
    assert [(r["condition_concept_id"], r[TIMES]) for r in G.generalise(facts, m).orderBy("person_id").collect()] == [(50, 1), (50, 2)]
    assert G.dropped_facts(facts, m).collect()[0]["dropped_records"] == 3
    persons = table(spark, "person", [{"person_id": p, "gender_concept_id": 8507} for p in range(1, 4)])
    out = DE.deidentify(facts, DE.person_map(persons, "s", D(2024, 1, 1)), None, DE.DEID_SPECS["condition_occurrence"], D(1900, 1, 1), D(2100, 1, 1))
    assert sorted(r[TIMES] for r in out.collect()) == [1, 2, 3]
    assert {r["condition_concept_id"]: r["num_records"] for r in qc_concepts(out, "condition_concept_id").collect()} == {5: 3, 6: 3}
