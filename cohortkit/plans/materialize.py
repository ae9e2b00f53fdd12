"""Stage materialisation.

The reference runs as a chain of scripts whose results are tables (``SELECT ... INTO``); every
downstream script reads them. Here a stage is written once as parquet under the cluster's
checkpoint folder (``spark.checkpoint.dir``, a shared reliable store) and read back:

* lineage is cut, so a lost executor re-reads files instead of recomputing the chain;
* stages read by several branches (cohort, extracts, key maps) are computed once;
* the read-back relation carries its real file size, so join planning (broadcast or not) rests
  on a measured size rather than an estimate.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortkit.session import ensure_checkpoint_dir


class StageStore:
    def __init__(self, spark: SparkSession, run_id: str | None = None):
        self.spark = spark
        root = ensure_checkpoint_dir(spark).rstrip("/")
        self.root = f"{root}/cohortkit-stages/{run_id or uuid.uuid4().hex}"
        self._done: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        if name not in self._done:
            p = self.path(name)
            df.write.mode("overwrite").parquet(p)
            self._done[name] = self.spark.read.parquet(p)
        return self._done[name]
