"""Band joins as boundary sweeps.

The reference joins facts to cohort visits on ``person_id`` with a date-range residual. That plan pairs
every fact of a person with every cohort visit of the person before the residual runs, and a person holding a
large share of the facts lands in one task.

Here an interval is two boundary rows, +1 on its first day and -1 on the day after its last, however long it
is; an interval that ends on 9999-12-31 is two rows like any other. How many intervals cover a day is the sum of
the boundaries up to it:

* boundaries are added up per (key, day) on the map side, and gathered per (key, bin) of BIN_DAYS days as a
  short list of steps (``_steps``; at most BIN_DAYS entries);
* what earlier bins add up to is carried into a bin (``_carried``): a running sum over the key's bins, which are
  at most the bins of the calendar, whatever the number of facts and intervals;
* a fact meets at most one row, that of its own (key, bin), and adds the steps up to its day to the carry.

Facts are shuffled once, by (key, bin), so a hot key spreads over its bins; nothing is paired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.plans.broadcast import broadcast_checked

BIN_DAYS = 32


def _day(c: Column) -> Column:
    return F.unix_date(c)


def _bin(day: Column) -> Column:
    return F.floor(day / F.lit(BIN_DAYS)).cast("int")


def boundaries(intervals: DataFrame, key: str, lo: Column, hi: Column) -> DataFrame:
    """(_key, _day, _step): by how much the number of intervals [lo, hi] (inclusive dates) changes on a day.
    An interval without lo or hi, or with hi before lo, holds no day. Days that change nothing are left out."""
    iv = intervals.select(F.col(key).alias("_key"), _day(lo).alias("_lo"), _day(hi).alias("_hi")).where("_lo <= _hi")
    ends = F.array(F.struct(F.col("_lo").alias("_day"), F.lit(1).cast("long").alias("_step")),
                   F.struct((F.col("_hi") + 1).alias("_day"), F.lit(-1).cast("long").alias("_step")))
    steps = iv.select("_key", F.inline(ends)).groupBy("_key", "_day").agg(F.sum("_step").alias("_step"))
    return steps.where("_step <> 0")


def points(rows: DataFrame, key: str, day: Column) -> DataFrame:
    """(_key, _day, _step): as :func:`boundaries`, for a count of the rows up to a day."""
    return rows.select(F.col(key).alias("_key"), _day(day).alias("_day")).where("_day IS NOT NULL").groupBy("_key", "_day").agg(
        F.count(F.lit(1)).alias("_step"))


def _steps(bounds: DataFrame) -> DataFrame:
    """(_key, _bin, _steps, _total): the boundaries of a bin, and what they add up to."""
    return bounds.groupBy("_key", _bin(F.col("_day")).alias("_bin")).agg(
        F.collect_list(F.struct("_day", "_step")).alias("_steps"), F.sum("_step").alias("_total"))


def _carried(bounds: DataFrame, asked: DataFrame) -> DataFrame:
    """(_key, _bin, _carry, _steps) of the bins ``asked`` (_key, _bin, distinct) in which a count can differ
    from 0. The window runs over one key's bins, boundary rows and facts being gathered before it."""
    both = _steps(bounds).withColumn("_asked", F.lit(False)).unionByName(asked.select(
        "_key", "_bin", F.lit(None).cast("array<struct<_day:int,_step:bigint>>").alias("_steps"), F.lit(0).cast("long").alias("_total"),
        F.lit(True).alias("_asked")))
    # a bin has one row with steps and one that is asked for at most
    bins = both.groupBy("_key", "_bin").agg(F.max("_steps").alias("_steps"), F.sum("_total").alias("_total"), F.max("_asked").alias("_asked"))
    before = Window.partitionBy("_key").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = bins.withColumn("_carry", F.coalesce(F.sum("_total").over(before), F.lit(0).cast("long")))
    return carried.where(F.col("_asked") & ((F.col("_carry") != 0) | F.col("_steps").isNotNull())).select("_key", "_bin", "_carry", "_steps")


def running_count(facts: DataFrame, key: str, day: Column, bounds: DataFrame, out: str, how: str = "left") -> DataFrame:
    """``facts`` with ``out``: the sum of the steps of ``bounds`` up to ``day`` for the fact's key.

    ``how="left"`` keeps every fact (0 where nothing was added up, also for a null key or day); ``"inner"``
    keeps those whose bin can hold another count than 0."""
    cols = facts.columns
    asked = facts.select(F.col(key).alias("_key"), _bin(_day(day)).alias("_bin")).where("_key IS NOT NULL AND _bin IS NOT NULL").distinct()
    table = broadcast_checked(_carried(bounds, asked), beside=facts)
    f = facts.withColumn("_fday", _day(day)).withColumn("_fbin", _bin(F.col("_fday")))
    j = f.join(table, (F.col(key) == F.col("_key")) & (F.col("_fbin") == F.col("_bin")), how)
    inside = F.aggregate(F.filter("_steps", lambda s: s["_day"] <= F.col("_fday")), F.lit(0).cast("long"), lambda a, s: a + s["_step"])
    count = F.coalesce("_carry", F.lit(0).cast("long")) + F.coalesce(inside, F.lit(0).cast("long"))
    return j.select(*cols, count.alias(out))


def count_covering(facts: DataFrame, key: str, day: Column, intervals: DataFrame, interval_key: str, lo: Column, hi: Column, out: str,
                   how: str = "inner") -> DataFrame:
    """``facts`` with ``out``: the number of ``intervals`` of the fact's key that cover ``day``. ``how="inner"``
    keeps the facts that one interval covers at least, ``"left"`` all."""
    counted = running_count(facts, key, day, boundaries(intervals, interval_key, lo, hi), out, how)
    return counted.where(F.col(out) > 0) if how == "inner" else counted

