"""Session helpers. Library functions never create sessions; tests, bench and the runner do."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators are designed around. AQE gives runtime broadcast conversion with a
# measured size, partition coalescing and skew-join splitting (a person with a third of all
# records gets its partition split, the small side replicated).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "cohortkit",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra_conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this is a shared, reliable folder set by the operator of the cluster and is
    only read here. Only when it is unset (a bare local test session) is a scratch folder made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder for the cluster")
    path = tempfile.mkdtemp(prefix="cohortkit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
