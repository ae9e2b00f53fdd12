"""One person holds a third of all facts and of the cohort's visits: results stay exact and the fact
side is never joined on person_id alone (the join key carries a bin of days, or the person's map row is
broadcast), so the hot person's rows are spread instead of landing in one task."""

import datetime as dt
import random

from helpers import D, F, ancestor_df, cohort_df, concept_set_df, count_by, plan_text, table

from cohortkit.operators import deid as DE
from cohortkit.operators import extract as X
from cohortkit.params import Params

P = Params(study_start=D(2020, 1, 1), extract_visit_start=D(2020, 1, 1))
HOT = 7


def _skewed(spark, n_facts=900):
    rnd = random.Random(17)
    base = D(2020, 1, 1)
    day = lambda n: base + dt.timedelta(days=n)
    visits = []
    for p in range(1, HOT + 1):
        k = 12 if p == HOT else 4
        for _ in range(k):
            s = rnd.randint(0, 300)
            visits.append((p, day(s), day(s + rnd.randint(0, 10))))
    facts = []
    for i in range(n_facts):
        p = HOT if i % 3 == 0 else rnd.randint(1, 6)
        s = rnd.randint(-5, 320)
        e = rnd.choice([None, s, s + rnd.randint(0, 15)])
        facts.append((i, p, day(s), None if e is None else day(e)))
    return visits, facts


def test_hot_person_extracts_are_exact(spark):
    visits, facts = _skewed(spark)
    coh = cohort_df(spark, [(p, 1000 + i, s, e) for i, (p, s, e) in enumerate(visits)])
    ca = ancestor_df(spark, [(5, 5, 0)])
    one_day = dt.timedelta(days=1)

    dev = table(spark, "device_exposure", [
        {"device_exposure_id": i, "person_id": p, "device_concept_id": 5, "device_exposure_start_date": s}
        for i, p, s, _ in facts
    ])
    got = count_by(X.extract(dev, coh, X.SPECS["device_exposure"], P,
                             concept_set_df(spark, [(5, "D", "Device", True)]), ca, None), "device_exposure_id")
    want = {}
    for i, p, s, _ in facts:
        k = sum(1 for q, vs, ve in visits if q == p and vs - one_day <= s <= ve + one_day)
        if k:
            want[i] = k
    assert got == want
    assert sum(1 for i in want if facts[i][1] == HOT) > 50  # the hot person takes part

    cond = table(spark, "condition_occurrence", [
        {"condition_occurrence_id": i, "person_id": p, "condition_concept_id": 5, "condition_start_date": s,
         "condition_end_date": e} for i, p, s, e in facts
    ])
    got = count_by(X.extract(cond, coh, X.SPECS["condition_occurrence"], P,
                             concept_set_df(spark, [(5, "C", "Condition", True)]), ca, None), "condition_occurrence_id")
    want = {}
    for i, p, s, e in facts:
        k = sum(1 for q, vs, ve in visits if q == p and (s < ve or e is None or e > vs))
        if k:
            want[i] = k
    assert got == want


def test_hot_person_fact_join_is_keyed_by_bin(spark):
    visits, facts = _skewed(spark, 300)
    coh = cohort_df(spark, [(p, 1000 + i, s, e) for i, (p, s, e) in enumerate(visits)])
    meas = table(spark, "measurement", [
        {"measurement_id": i, "person_id": p, "measurement_concept_id": 5, "measurement_date": s} for i, p, s, _ in facts
    ])
    out = X.extract(meas, coh, X.SPECS["measurement"], P, concept_set_df(spark, [(5, "M", "Measurement", True)]),
                    ancestor_df(spark, [(5, 5, 0)]), None)
    out.count()
    txt = plan_text(out)
    assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt
    # the only join between the facts and what comes of the cohort's windows is on (person_id, bin)
    joins = [line for line in txt.splitlines() if "Join" in line and "person_id" in line and "LeftSemi" not in line]
    assert joins and all("_fbin" in line and "_bin" in line for line in joins), txt


def _map_case(spark, n=3000):
    visits, facts = _skewed(spark, n)
    persons = table(spark, "person", [{"person_id": p, "gender_concept_id": 8507} for p in range(1, HOT + 1)])
    pmap = DE.person_map(persons, "salt", D(2024, 1, 1))
    rows = [{"condition_occurrence_id": i, "person_id": p, "condition_concept_id": 5, "condition_start_date": s,
             "visit_occurrence_id": None if i % 4 == 0 else -5 if i % 4 == 1 else i % 60} for i, p, s, _ in facts]
    vmap = spark.createDataFrame([(-5, 1)] + [(v, v + 2) for v in range(40)], "source_key bigint, new_id bigint")
    return facts, rows, table(spark, "condition_occurrence", rows).repartition(8, "condition_occurrence_id"), pmap, vmap


def test_deid_maps_above_the_broadcast_bound(spark):
    """With the bound at 0 no task gets a third of the rows, and ids, shifts and visits are the same."""
    facts, rows, cond, pmap, vmap = _map_case(spark)
    spec, window = DE.DEID_SPECS["condition_occurrence"], (D(1900, 1, 1), D(2100, 1, 1))
    small = DE.deidentify(cond, pmap, vmap, spec, *window)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        large = DE.deidentify(cond, pmap, vmap, spec, *window, limit_bytes=0)
        assert small.count() == large.count() == len(rows) and small.exceptAll(large).isEmpty()
        sizes = [r["count"] for r in large.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert 3 * max(sizes) < len(rows), sizes
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_deid_keeps_visits_with_negative_ids(spark):
    _, rows, cond, pmap, vmap = _map_case(spark, 300)
    out = DE.deidentify(cond, pmap, vmap, DE.DEID_SPECS["condition_occurrence"], D(1900, 1, 1), D(2100, 1, 1))
    new = {r["source_key"]: r["new_id"] for r in vmap.collect()}
    got = {r["condition_occurrence_id"]: r["visit_occurrence_id"] for r in out.collect()}
    assert got == {r["condition_occurrence_id"]: new.get(r["visit_occurrence_id"]) for r in rows}
    assert 1 in got.values()


def test_hot_person_deid_keeps_one_shift(spark):
    visits, facts = _skewed(spark, 300)
    persons = table(spark, "person", [{"person_id": p, "gender_concept_id": 8507} for p in range(1, HOT + 1)])
    pmap = DE.person_map(persons, "salt", D(2024, 1, 1))
    cond = table(spark, "condition_occurrence", [
        {"condition_occurrence_id": i, "person_id": p, "condition_concept_id": 5, "condition_start_date": s}
        for i, p, s, _ in facts
    ])
    out = DE.deidentify(cond, pmap, None, DE.DEID_SPECS["condition_occurrence"], D(1900, 1, 1), D(2100, 1, 1))
    shifts = {}
    src = {i: s for i, _, s, _ in facts}
    for r in out.collect():
        shifts.setdefault(r["person_id"], set()).add((r["condition_start_date"] - src[r["condition_occurrence_id"]]).days)
    assert len(shifts) == HOT and all(len(v) == 1 for v in shifts.values())
    hot = {r["id"] for r in pmap.where(f"source_key = {HOT}").collect()}
    assert sum(r["person_id"] in hot for r in out.collect()) == 100
