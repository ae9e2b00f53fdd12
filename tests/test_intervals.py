"""The boundary sweep against comparing every fact with every interval."""

import datetime as dt
import random

import pytest
from helpers import D, F

from cohortkit.operators import intervals as I
from cohortkit.operators.bag import TIMES, expand_bag


def _tables(spark, seed):
    rnd = random.Random(seed)
    day = lambda n: D(2019, 1, 1) + dt.timedelta(days=n)
    ivs = [(p, day(s), day(s + rnd.choice([-5, 0, 1, 3, 31, 32, 64, 400]))) for p in range(1, 4) for s in rnd.sample(range(-70, 700), 12)]
    ivs += [(1, day(10), D(9999, 12, 31)), (1, day(10), D(9999, 12, 31)), (2, D(1, 1, 1), day(-300)), (3, None, day(5)), (3, day(5), None), (None, day(1), day(2))]
    facts = [(i, rnd.randint(1, 4), day(rnd.randint(-400, 1200))) for i in range(400)]
    facts += [(900, 1, None), (901, None, day(1)), (902, 1, D(9999, 12, 31)), (903, 1, D(1, 1, 1)), (904, 2, D(1, 1, 1)), (905, 1, D(1969, 12, 31))]
    return ivs, facts, spark.createDataFrame(ivs, "who bigint, lo date, hi date"), spark.createDataFrame(facts, "fid bigint, person_id bigint, d date")


@pytest.mark.parametrize("seed, bin_days", [(1, 32), (2, 32), (3, 7), (4, 365)])
def test_counts_equal_the_pair_join(spark, monkeypatch, seed, bin_days):
    monkeypatch.setattr(I, "BIN_DAYS", bin_days)
    ivs, facts, iv, f = _tables(spark, seed)
    want = {i: sum(p is not None and q == p and lo is not None and hi is not None and d is not None and lo <= d <= hi for q, lo, hi in ivs) for i, p, d in facts}
    some = I.count_covering(f, "person_id", F.col("d"), iv, "who", F.col("lo"), F.col("hi"), "k")
    assert {r["fid"]: r["k"] for r in some.collect()} == {i: k for i, k in want.items() if k}
    every = I.count_covering(f, "person_id", F.col("d"), iv, "who", F.col("lo"), F.col("hi"), "k", "left")
    assert every.columns == ["fid", "person_id", "d", "k"]
    assert {r["fid"]: r["k"] for r in every.collect()} == want


def test_points_count_the_rows_up_to_a_day(spark):
    ivs, facts, iv, f = _tables(spark, 5)
    got = I.running_count(f, "person_id", F.col("d"), I.points(iv, "who", F.col("lo")), "k")
    want = {i: sum(p is not None and q == p and lo is not None and d is not None and lo <= d for q, lo, _ in ivs) for i, p, d in facts}
    assert {r["fid"]: r["k"] for r in got.collect()} == want


def test_an_interval_is_two_rows_however_long(spark):
    iv = spark.createDataFrame([(1, D(2020, 1, 1), D(9999, 12, 31)), (2, D(2020, 1, 1), D(2020, 1, 1)), (3, D(2020, 1, 1), D(2020, 1, 9)),
                                (3, D(2020, 1, 10), D(2020, 1, 12))], "who bigint, lo date, hi date")
    rows = I.boundaries(iv, "who", F.col("lo"), F.col("hi"))
    assert {k: sum(r["_key"] == k for r in rows.collect()) for k in (1, 2, 3)} == {1: 2, 2: 2, 3: 2}  # intervals that touch change nothing between


def test_hot_key_meets_one_row_a_bin(spark):
    """One person holds nearly all facts and visits: what a fact is joined with has a row per bin, not per visit."""
    rnd = random.Random(8)
    day = lambda n: D(2020, 1, 1) + dt.timedelta(days=n)
    ivs = [(7, day(s), day(s + rnd.randint(0, 200))) for s in range(1000) for _ in range(3)]
    facts = [(i, 7, day(rnd.randint(0, 1200))) for i in range(3000)]
    f = spark.createDataFrame(facts, "fid bigint, person_id bigint, d date")
    bounds = I.boundaries(spark.createDataFrame(ivs, "who bigint, lo date, hi date"), "who", F.col("lo"), F.col("hi"))
    asked = f.select(F.col("person_id").alias("_key"), I._bin(I._day(F.col("d"))).alias("_bin")).distinct()
    table = I._carried(bounds, asked)
    held = table.select("_bin", F.size("_steps").alias("n")).collect()
    assert len(held) == len({r["_bin"] for r in held}) <= 1200 // I.BIN_DAYS + 2 and max(r["n"] for r in held) <= I.BIN_DAYS


def test_expand_bag(spark):
    df = spark.createDataFrame([(1, 3), (2, 1), (3, 0)], f"x bigint, {TIMES} bigint")
    assert sorted(r.x for r in expand_bag(df).collect()) == [1, 1, 1, 2] and expand_bag(df).columns == ["x"]
    assert expand_bag(df.select("x")).count() == 3
