"""Hand-made cases for cohort building and windowed extraction (FIXTURES.md §4), plus brute-force
equivalence of the coverage-count band join and the OR-overlap failure count."""

import datetime as dt
import random

from helpers import D, F, ancestor_df, cohort_df, concept_df, concept_set_df, count_by, ids, plan_text, table

from cohortkit.operators import cohort as C
from cohortkit.operators import extract as X
from cohortkit.operators.bag import TIMES
from cohortkit.params import Params

P = Params(study_start=D(2020, 1, 1), extract_visit_start=D(2020, 1, 1))


def test_index_window_is_strict(spark):
    dx = D(2020, 3, 10)
    events = spark.createDataFrame([(1, dx)], "person_id bigint, diagnosis_date date")
    offsets = [-7, -6, 0, 20, 21]
    visits = table(spark, "visit_occurrence", [
        {"visit_occurrence_id": 10 + i, "person_id": 1, "visit_concept_id": 9201,
         "visit_start_date": dx + dt.timedelta(days=o), "visit_end_date": dx + dt.timedelta(days=o + 2)}
        for i, o in enumerate(offsets)
    ])
    out = C.index_visits(visits, events, [9201, 262], D(2020, 1, 1))
    assert ids(out, "visit_occurrence_id") == [11, 12, 13]


def test_visit_repeats_per_qualifying_date(spark):
    events = spark.createDataFrame([(1, D(2020, 3, 10)), (1, D(2020, 3, 12))], "person_id bigint, diagnosis_date date")
    visits = table(spark, "visit_occurrence", [
        {"visit_occurrence_id": 7, "person_id": 1, "visit_concept_id": 262,
         "visit_start_date": D(2020, 3, 14), "visit_end_date": D(2020, 3, 20)},
        {"visit_occurrence_id": 8, "person_id": 1, "visit_concept_id": 9202,  # wrong type
         "visit_start_date": D(2020, 3, 14), "visit_end_date": D(2020, 3, 20)},
    ])
    out = C.index_visits(visits, events, [9201, 262], D(2020, 1, 1))
    assert ids(out, "visit_occurrence_id") == [7, 7]


def _vocab(spark):
    # registry: 100 (Measurement, with descendants), 200 (Measurement, self only), 300 (Measurement, with descendants)
    cs = concept_set_df(spark, [(100, "M parent", "Measurement", True), (200, "M self", "Measurement", False),
                                (300, "M other", "Measurement", True)])
    ca = ancestor_df(spark, [(100, 100, 0), (100, 101, 1), (200, 200, 0), (200, 201, 1), (300, 300, 0), (300, 101, 1),
                             (101, 101, 0), (201, 201, 0)])
    c = concept_df(spark, [(i, f"c{i}", "Leaf", None) for i in (100, 101, 200, 201, 300)])
    return cs, ca, c


def test_band_bounds_and_concept_rules(spark):
    cs, ca, c = _vocab(spark)
    coh = cohort_df(spark, [(1, 50, D(2020, 5, 10), D(2020, 5, 12))])
    m = table(spark, "measurement", [
        {"measurement_id": 1, "person_id": 1, "measurement_concept_id": 101, "measurement_date": D(2020, 5, 8)},   # start-2
        {"measurement_id": 2, "person_id": 1, "measurement_concept_id": 101, "measurement_date": D(2020, 5, 9)},   # start-1
        {"measurement_id": 3, "person_id": 1, "measurement_concept_id": 101, "measurement_date": D(2020, 5, 13)},  # end+1
        {"measurement_id": 4, "person_id": 1, "measurement_concept_id": 101, "measurement_date": D(2020, 5, 14)},  # end+2
        {"measurement_id": 5, "person_id": 1, "measurement_concept_id": 201, "measurement_date": D(2020, 5, 11)},  # FALSE parent, child
        {"measurement_id": 6, "person_id": 1, "measurement_concept_id": 200, "measurement_date": D(2020, 5, 11)},  # FALSE parent, self
        {"measurement_id": 7, "person_id": 2, "measurement_concept_id": 101, "measurement_date": D(2020, 5, 11)},  # other person
    ])
    out = X.extract(m, coh, X.SPECS["measurement"], P, cs, ca, c)
    assert ids(out, "measurement_id") == [2, 3, 6]
    assert out.where("measurement_source_value IS NOT NULL").count() == 0


def test_two_registry_parents_bag_vs_distinct(spark):
    cs, ca, c = _vocab(spark)
    cs = cs.withColumn("domain", F.lit("Procedure"))
    coh = cohort_df(spark, [(1, 50, D(2020, 5, 10), D(2020, 5, 12)), (1, 50, D(2020, 5, 10), D(2020, 5, 12))])
    pr = table(spark, "procedure_occurrence", [
        {"procedure_occurrence_id": 9, "person_id": 1, "procedure_concept_id": 101, "procedure_date": D(2020, 5, 11)},
    ])
    bag = X.extract(pr, coh, X.SPECS["procedure_occurrence"], P, cs, ca, c)
    dist = X.extract(pr, coh, X.SPECS["procedure_occurrence"], P, cs, ca, c, multiplicity="distinct")
    # 2 registry parents x 2 cohort rows
    assert bag.count() == 4
    assert dist.count() == 1


def test_observation_year_window_feb29(spark):
    cs = concept_set_df(spark, [(5, "O", "Observation", True)])
    ca = ancestor_df(spark, [(5, 5, 0)])
    coh = cohort_df(spark, [(1, 1, D(2020, 2, 29), D(2020, 2, 29))])
    o = table(spark, "observation", [
        {"observation_id": 1, "person_id": 1, "observation_concept_id": 5, "observation_date": D(2019, 2, 28)},
        {"observation_id": 2, "person_id": 1, "observation_concept_id": 5, "observation_date": D(2019, 2, 27)},
        {"observation_id": 3, "person_id": 1, "observation_concept_id": 5, "observation_date": D(2021, 2, 28)},
        {"observation_id": 4, "person_id": 1, "observation_concept_id": 5, "observation_date": D(2021, 3, 1)},
    ])
    out = X.extract(o, coh, X.SPECS["observation"], P, cs, ca, None)
    assert ids(out, "observation_id") == [1, 3]


def test_condition_null_end_long_before_is_kept(spark):
    cs = concept_set_df(spark, [(5, "C", "Condition", True)])
    ca = ancestor_df(spark, [(5, 5, 0)])
    coh = cohort_df(spark, [(1, 1, D(2020, 6, 1), D(2020, 6, 5))])
    cond = table(spark, "condition_occurrence", [
        {"condition_occurrence_id": 1, "person_id": 1, "condition_concept_id": 5, "condition_start_date": D(2001, 1, 1)},
    ])
    assert X.extract(cond, coh, X.SPECS["condition_occurrence"], P, cs, ca, None).count() == 1


def _brute_overlap(conds, visits):
    out = {}
    for cid, p, s, e in conds:
        k = sum(1 for vp, vs, ve in visits if vp == p and (s < ve or (e is not None and e > vs) or e is None))
        out[cid] = k
    return out


def test_overlap_counts_match_pair_join_on_dirty_intervals(spark):
    rnd = random.Random(7)
    base = D(2020, 1, 1)
    day = lambda n: base + dt.timedelta(days=n)
    visits, conds = [], []
    for p in range(1, 5):
        for _ in range(rnd.randint(1, 6)):
            s = rnd.randint(0, 40)
            e = s + rnd.choice([-3, 0, 0, 1, 5])  # includes zero-length and reversed visits
            visits.append((p, day(s), day(e)))
        for _ in range(25):
            s = rnd.randint(0, 40)
            e = rnd.choice([None, s, s + rnd.randint(-8, 8)])
            conds.append((len(conds) + 1, p, day(s), None if e is None else day(e)))
    coh = cohort_df(spark, [(p, 100 + i, s, e) for i, (p, s, e) in enumerate(visits)])
    cs = concept_set_df(spark, [(5, "C", "Condition", True)])
    ca = ancestor_df(spark, [(5, 5, 0)])
    cond = table(spark, "condition_occurrence", [
        {"condition_occurrence_id": c, "person_id": p, "condition_concept_id": 5, "condition_start_date": s,
         "condition_end_date": e} for c, p, s, e in conds
    ])
    got = count_by(X.extract(cond, coh, X.SPECS["condition_occurrence"], P, cs, ca, None), "condition_occurrence_id")
    want = {k: v for k, v in _brute_overlap(conds, visits).items() if v > 0}
    assert got == want


def test_band_counts_match_pair_join(spark):
    rnd = random.Random(3)
    base = D(2020, 1, 1)
    day = lambda n: base + dt.timedelta(days=n)
    visits = [(p, day(s), day(s + rnd.randint(0, 6))) for p in range(1, 4) for s in rnd.sample(range(0, 30), 5)]
    devs = [(i, rnd.randint(1, 3), day(rnd.randint(-3, 40))) for i in range(200)]
    coh = cohort_df(spark, [(p, 100 + i, s, e) for i, (p, s, e) in enumerate(visits)])
    cs = concept_set_df(spark, [(5, "D", "Device", True)])
    ca = ancestor_df(spark, [(5, 5, 0)])
    dev = table(spark, "device_exposure", [
        {"device_exposure_id": i, "person_id": p, "device_concept_id": 5, "device_exposure_start_date": d} for i, p, d in devs
    ])
    got = count_by(X.extract(dev, coh, X.SPECS["device_exposure"], P, cs, ca, None), "device_exposure_id")
    want = {}
    for i, p, d in devs:
        k = sum(1 for vp, vs, ve in visits if vp == p and vs - dt.timedelta(days=1) <= d <= ve + dt.timedelta(days=1))
        if k:
            want[i] = k
    assert got == want


def test_extract_plans_have_no_pair_or_cartesian_joins(spark):
    from cohortkit.plans.catalog import Ctx

    ctx = Ctx(spark, "/root/testdata/sf0.001", materialize=False)
    for t in ["measurement", "condition_occurrence", "observation", "device_exposure", "drug_exposure"]:
        txt = plan_text(ctx.extract(t))
        assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt, t
    txt = plan_text(ctx.index())
    assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt


def test_interval_overlap_option_matches_pair_join(spark):
    rnd = random.Random(11)
    base = D(2020, 1, 1)
    day = lambda n: base + dt.timedelta(days=n)
    visits, conds = [], []
    for p in range(1, 5):
        for _ in range(rnd.randint(1, 7)):
            s = rnd.randint(0, 60)
            visits.append((p, day(s), day(s + rnd.choice([-2, 0, 1, 3, 9]))))
        for _ in range(30):
            s = rnd.randint(-5, 70)
            e = rnd.choice([None, s, s + rnd.randint(-6, 12)])
            conds.append((len(conds) + 1, p, day(s), None if e is None else day(e)))
    conds.append((999, 9, day(1), day(2)))  # person without visits
    coh = cohort_df(spark, [(p, 100 + i, s, e) for i, (p, s, e) in enumerate(visits)])
    cs = concept_set_df(spark, [(5, "C", "Condition", True)])
    ca = ancestor_df(spark, [(5, 5, 0)])
    cond = table(spark, "condition_occurrence", [
        {"condition_occurrence_id": c, "person_id": p, "condition_concept_id": 5, "condition_start_date": s,
         "condition_end_date": e} for c, p, s, e in conds
    ])
    got = count_by(X.extract(cond, coh, X.SPECS["condition_occurrence"], P, cs, ca, None, overlap="interval"),
                   "condition_occurrence_id")
    want = {}
    for cid, p, s, e in conds:
        k = sum(1 for vp, vs, ve in visits if vp == p and s < ve and (e is None or e > vs))
        if k:
            want[cid] = k
    assert got == want


def test_cohort_options_distinct_and_death_fallback(spark):
    from helpers import concept_df as cdf

    cond = table(spark, "condition_occurrence", [
        {"condition_occurrence_id": 1, "person_id": 1, "condition_concept_id": 5, "condition_start_date": D(2020, 3, 10)},
        {"condition_occurrence_id": 2, "person_id": 1, "condition_concept_id": 5, "condition_start_date": D(2020, 3, 11)},
    ])
    visits = table(spark, "visit_occurrence", [
        {"visit_occurrence_id": 7, "person_id": 1, "visit_concept_id": 9201,
         "visit_start_date": D(2020, 3, 12), "visit_end_date": D(2020, 3, 15)},
    ])
    person = table(spark, "person", [{"person_id": 1, "gender_concept_id": 8507, "birth_datetime": dt.datetime(1950, 5, 1)}])
    death = table(spark, "death", [{"person_id": 1, "death_date": D(2020, 4, 1), "death_datetime": None}])
    concept = cdf(spark, [(5, "dx", "Leaf", None)])
    ca = ancestor_df(spark, [(5, 5, 0)])
    p = P.with_(diagnosis_roots=(5,))
    bag = C.build_cohort(cond, visits, person, death, concept, ca, p).collect()
    assert len(bag) == 2 and all(r["death_date"] is None for r in bag)          # Q1 bag, Q3 datetime only
    one = C.build_cohort(cond, visits, person, death, concept, ca, p, distinct=True, coalesce_death=True).collect()
    assert len(one) == 1 and one[0]["death_date"] == D(2020, 4, 1) and one[0]["birth_date"] == D(1950, 5, 1)


def test_distinct_interval_and_weighted_forms_agree(spark):
    cs, ca, c = _vocab(spark)
    cs = cs.withColumn("domain", F.lit("Procedure"))
    coh = cohort_df(spark, [(1, 50, D(2020, 5, 10), D(2020, 5, 12)), (1, 51, D(2020, 5, 11), D(2020, 5, 11))])
    pr = table(spark, "procedure_occurrence", [
        {"procedure_occurrence_id": i, "person_id": 1, "procedure_concept_id": 101, "procedure_date": D(2020, 5, 7 + i)} for i in range(9)
    ])
    args = (pr, coh, X.SPECS["procedure_occurrence"], P, cs, ca, c)
    weighted = {r["procedure_occurrence_id"]: r[TIMES] for r in X.extract(*args, multiplicity="weighted").collect()}
    assert weighted == {2: 2, 3: 4, 4: 4, 5: 4, 6: 2}
    assert count_by(X.extract(*args), "procedure_occurrence_id") == weighted
    assert ids(X.extract(*args, multiplicity="distinct"), "procedure_occurrence_id") == sorted(weighted)


def test_condition_overlap_with_open_visits(spark):
    """A visit without an end matches by its start only, in both overlap modes."""
    day = lambda n: D(2020, 1, 1) + dt.timedelta(days=n)
    visits = [(1, day(10), None), (1, day(10), None), (1, day(20), day(25)), (2, day(5), None), (3, day(0), day(3)), (4, day(30), day(28))]
    facts = []
    for p in (1, 2, 3, 4, 5):
        for s in range(-5, 40, 3):
            for e in (None, s, s + 4, s - 2):
                facts.append((len(facts), p, day(s), None if e is None else day(e)))
    facts.append((len(facts), 1, day(-356), day(-352)))
    coh = cohort_df(spark, [(p, 100 + i, s, e) for i, (p, s, e) in enumerate(visits)])
    cond = table(spark, "condition_occurrence", [
        {"condition_occurrence_id": i, "person_id": p, "condition_concept_id": 5, "condition_start_date": s, "condition_end_date": e}
        for i, p, s, e in facts])
    cs, ca = concept_set_df(spark, [(5, "C", "Condition", True)]), ancestor_df(spark, [(5, 5, 0)])

    def matches(either):
        out = {}
        for i, p, s, e in facts:
            n = 0
            for q, vs, ve in visits:
                starts, ends = ve is not None and s < ve, e is None or e > vs
                n += q == p and ((starts or ends) if either else (starts and ends))
            if n:
                out[i] = n
        return out

    assert count_by(X.extract(cond, coh, X.SPECS["condition_occurrence"], P, cs, ca, None), "condition_occurrence_id") == matches(True)
    interval = X.extract(cond, coh, X.SPECS["condition_occurrence"], P, cs, ca, None, overlap="interval")
    assert count_by(interval, "condition_occurrence_id") == matches(False)
