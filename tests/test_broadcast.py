"""Broadcasts by measured size, and the split join beyond it."""

import pytest
from helpers import F, plan_text

from cohortkit.plans import broadcast as B


def test_long_lists_and_strings_are_not_broadcast(spark):
    ids = spark.range(2000)
    lists = ids.select("id", F.sequence(F.lit(0), F.lit(999)).alias("x"))
    strings = ids.select("id", F.repeat(F.lit("ab"), 4000).alias("x"))
    nested = ids.select("id", F.array(F.struct(F.repeat(F.lit("c"), 8000).alias("y"))).alias("x"))
    facts = spark.range(10).withColumnRenamed("id", "f")
    for side in (lists, strings, nested):
        for df in (side, B.written(side)):  # computed, and already a table
            _, size = B.measured(df)
            assert 16_000_000 <= size <= 24_000_000
            plan = plan_text(facts.join(B.broadcast_checked(df, 8 << 20), F.col("f") == F.col("id"), "left"))
            assert "SortMergeJoin" in plan and "Broadcast" not in plan, plan
            plan = plan_text(facts.join(B.broadcast_checked(df, 64 << 20), F.col("f") == F.col("id"), "left"))
            assert "BroadcastHashJoin" in plan


def test_measured_bytes_of_nulls_and_empty(spark):
    none = spark.createDataFrame([(None, None, None)], "a string, b array<string>, c struct<d:string>")
    assert 0 < B.measured(none)[1] < 200
    assert B.measured(none.limit(0))[1] == 0


def test_bounds_by_footers_need_no_job(spark):
    few = B.written(spark.range(1000).select("id", (F.col("id") % 7).alias("k")).repartition(3))
    row = B.ROW_OVERHEAD + 32
    assert B._bound(few) == 1000 * row
    assert B._bound(few.where("k > 3").groupBy("k").agg(F.count("*").alias("n"))) == 1000 * row
    assert B._bound(few.unionByName(few).join(few.select("k").distinct(), "k", "left_semi")) == 2000 * row
    assert B._bound(few.join(few.select("k"), "k")) == 1_000_000 * row
    assert B._bound(few.select("id", F.explode(F.sequence(F.lit(1), F.lit(9))).alias("e"))) is None
    assert B._bound(few.select(F.col("id").cast("string").alias("s"))) is None and B._bound(few.select(F.array("id").alias("a"))) is None
    side = few.where("k = 1")
    assert B._side(side, 1 << 20)[0] is side and B._side(side, 1000)[0] is not None


def _facts(spark):
    rows = [(i, 7 if i % 3 == 0 else (None if i % 10 == 1 else i % 500 - 100)) for i in range(6000)]
    return rows, spark.createDataFrame(rows, "fid bigint, who bigint").repartition(8, "fid")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_join_lookup(spark, how, limit):
    rows, facts = _facts(spark)
    lookup = spark.createDataFrame([(k, k * 10) for k in range(-150, 300)], "key bigint, val bigint")
    got = B.join_lookup(facts, lookup, "who", "key", how, limit)
    known = {k: k * 10 for k in range(-150, 300)}
    if how == "left_semi":
        assert sorted(map(tuple, got.collect()), key=str) == sorted(((i, k) for i, k in rows if k in known), key=str)
    else:
        want = [(i, k, known.get(k)) for i, k in rows if how == "left" or k in known]
        assert sorted(map(tuple, got.select("fid", "who", "val").collect()), key=str) == sorted(want, key=str)


def test_hot_key_is_not_shuffled_to_one_task(spark):
    rows, facts = _facts(spark)
    lookup = spark.createDataFrame([(k, k * 10) for k in range(-150, 500)], "key bigint, val bigint")

    def largest(df):
        return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        split = B.join_lookup(facts, lookup, "who", "key", limit_bytes=0)
        plain = facts.join(lookup.hint("shuffle_merge"), F.col("who") == F.col("key"))
        hot = sum(k == 7 for _, k in rows)
        assert split.count() == plain.count() and hot >= len(rows) // 3
        assert largest(plain) >= hot and 3 * largest(split) < len(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_sides_of_one_plan_share_the_limit(spark):
    facts = B.written(spark.range(50).select("id", (F.col("id") % 9).alias("a"), (F.col("id") % 7).alias("b"), (F.col("id") % 5).alias("c")))
    sides = [B.written(spark.range(1000).select(F.col("id").alias(f"k{i}"), (F.col("id") * 2).alias(f"v{i}"))) for i in range(3)]
    limit = 200_000  # of two sides, not of three
    size = 1000 * (B.ROW_OVERHEAD + 32)
    assert 2 * size <= limit < 3 * size
    out, held = facts, []
    for i, key in enumerate("abc"):
        out = B.join_lookup(out, sides[i], key, f"k{i}", limit_bytes=limit)
        held.append(B._held(out))
    assert held[0] > 0 and max(held) <= limit
    assert plan_text(out).count("SortMergeJoin") >= 1
    assert sorted(map(tuple, out.select("id", "v0", "v1", "v2").collect())) == [(i, i % 9 * 2, i % 7 * 2, i % 5 * 2) for i in range(50)]


def test_a_side_used_twice_is_held_once(spark):
    facts = B.written(spark.range(50).select("id", (F.col("id") % 9).alias("a")))
    one = B.join_lookup(facts, B.written(spark.range(1000).withColumnRenamed("id", "k")), "a", "k")
    assert 0 < B._held(one) == B._held(one.unionByName(one)) <= 1000 * (B.ROW_OVERHEAD + 32)
    wide = B.broadcast_checked(spark.range(2000).withColumnRenamed("id", "k2"), B._held(one) + 1000, beside=one)
    assert "Broadcast" not in plan_text(facts.join(wide, F.col("a") == F.col("k2")))


def test_bytes_of_a_row_hold_its_place_in_a_hash_table(spark):
    assert B.measured(spark.range(1000).select("id", F.col("id").alias("v")))[1] >= 1000 * (2 * 8 + 4 * 8)
