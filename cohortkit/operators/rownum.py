"""Global ROW_NUMBER() OVER (ORDER BY ...) without a single-partition window.

``row_number()`` over an unpartitioned window moves every row into one task. Here the rows are
range-partitioned and sorted on the order keys, the result is checkpointed to the cluster's
checkpoint folder (so partition boundaries, which come from sampling, are frozen and survive
lost executors), and each row's number is its partition's offset (from per-partition counts:
one small row per partition) plus its position inside the partition. With unique order keys
the numbers equal the plain window's, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.session import ensure_checkpoint_dir


def row_number_global(df: DataFrame, order: list[Column], out_col: str, start: int | Column = 1) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint(eager=True)
    tagged = ranged.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
    counts = {r["_pid"]: r["count"] for r in tagged.groupBy("_pid").count().collect()}
    n_parts = max(counts, default=-1) + 1
    offsets, run = [], 0
    for pid in range(n_parts):
        offsets.append(run)
        run += counts.get(pid, 0)
    if not offsets:
        offsets = [0]
    offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("_pid") + 1)
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    base = start if isinstance(start, Column) else F.lit(int(start))
    return tagged.withColumn(out_col, (offset + local + base.cast("long")).cast("long")).drop("_pid", "_mid")
