"""Exact counts of distinct persons by bitmaps.

Persons of a key are the bits of one bitmap per block of ids. A bitmap is the list of its words of 64 ids that hold
a person, so it is never larger than the persons in it: a rare concept's persons, spread over many blocks, take a word
each, and those of a common one share words. Words are built on the map side, and a shuffle carries a word instead of a
row per (key, person). Where a key then fans out to many others (a concept to all its ancestors), the words are merged
and no person is repeated per ancestor. The counts are exact for any ids; the bitmaps are well filled for the dense ids
of the person map (O30).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, BITS = "_block", "_bits"


def person_bitmaps(df: DataFrame, keys: list[str | Column], person: str = "person_id", **sums: Column) -> DataFrame:
    """(keys, BLOCK, BITS, sums): the persons of each key, and columns added up. A null person is in no bitmap."""
    rows = df.select(*keys, F.col(person).cast("long").alias("_person"), *[c.alias(name) for name, c in sums.items()])
    names = [c for c in rows.columns if c != "_person" and c not in sums]
    position = F.bitmap_bit_position("_person")
    words = rows.groupBy(*names, F.bitmap_bucket_number("_person").alias(BLOCK), F.shiftright(position, 6).cast("short").alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), position.bitwiseAND(F.lit(63).cast("long")).cast("int"))).alias("_set"),
        *[F.sum(name).alias(name) for name in sums])
    held = F.when(F.col("_word").isNotNull(), F.struct("_word", "_set"))
    return words.groupBy(*names, BLOCK).agg(F.collect_list(held).alias(BITS), *[F.sum(name).alias(name) for name in sums])


def count_persons(bitmaps: DataFrame, keys: list[str], out: str, **sums: str) -> DataFrame:
    """(keys, out, sums): persons of each of the ``keys``, columns of ``bitmaps`` that may be fewer or others than
    those that they were built by; ``sums`` (name -> column) are added up."""
    added = {f"_sum_{name}": c for name, c in sums.items()}
    words = bitmaps.select(*keys, BLOCK, *[F.col(c).alias(name) for name, c in added.items()], F.posexplode_outer(BITS).alias("_at", "_held"))
    first = F.coalesce(F.col("_at"), F.lit(0)) == 0  # what a bitmap adds to the sums counts once, not per word
    merged = words.groupBy(*keys, BLOCK, F.col("_held._word").alias("_word")).agg(
        F.bit_or("_held._set").alias("_set"), *[F.sum(F.when(first, F.col(name))).alias(name) for name in added])
    n = F.coalesce(F.sum(F.bit_count("_set")), F.lit(0)).cast("long").alias(out)
    return merged.groupBy(*keys).agg(n, *[F.sum(f"_sum_{name}").alias(name) for name in sums])
