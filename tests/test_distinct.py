"""Distinct persons by bitmaps against sets."""

import random

from helpers import F

from cohortkit.operators.distinct import BITS, count_persons, person_bitmaps
from cohortkit.plans.broadcast import value_bytes


def test_counts_equal_sets(spark):
    rnd = random.Random(4)
    ids = [*range(-40_000, 40_000, 700), 0, 1, 32768, 32769, 2**40, 2**40 + 1, -(2**40), None]
    rows = [(rnd.choice(["a", "b", None]), rnd.randint(1, 4), rnd.choice(ids), rnd.randint(1, 3)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, c bigint, person_id bigint, n bigint")
    fan = {1: [10, 11], 2: [10], 3: [11, 12], 4: [10, 11, 12]}
    bitmaps = person_bitmaps(df, ["k", F.col("c").alias("concept")], _n=F.col("n"))
    up = spark.createDataFrame([(c, a) for c, many in fan.items() for a in many], "concept bigint, ancestor bigint")
    got = {(r["k"], r["ancestor"]): (r["persons"], r["records"]) for r in
           count_persons(bitmaps.join(up, "concept"), ["k", "ancestor"], "persons", records="_n").collect()}
    want = {}
    for k, c, p, n in rows:
        for a in fan[c]:
            people, records = want.get((k, a), (set(), 0))
            want[k, a] = (people | ({p} if p is not None else set()), records + n)
    assert got == {key: (len(people), records) for key, (people, records) in want.items()}


def test_fan_out_repeats_no_person(spark):
    """A shuffle row is a key and a block of ids, however many persons it holds."""
    df = spark.range(100_000).select(F.col("id").alias("person_id"), (F.col("id") % 2).alias("c"))
    assert person_bitmaps(df, ["c"]).count() == 9  # blocks of 32,768 ids from 1 on, and one that holds 0


def test_rare_keys_take_little_room(spark):
    """A key's bitmap is no larger than its persons, however far apart their ids are."""
    df = spark.range(2_000).select((F.col("id") * 40_009).alias("person_id"), (F.col("id") % 100).alias("c"))
    bitmaps = person_bitmaps(df, ["c"])
    assert bitmaps.agg(F.sum(value_bytes(F.col(BITS), bitmaps.schema[BITS].dataType))).first()[0] < 2_000 * 100
    assert count_persons(bitmaps, ["c"], "n").agg(F.sum("n"), F.max("n")).first() == (2_000, 20)
