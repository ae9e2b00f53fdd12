"""Published runs.

A run writes its tables aside, in a folder of its own that nothing reads yet, and is published by one small file at the
end: a manifest that names every table with its path and row count, the state of the inputs and the marks
of the key maps. Readers and the next run look for manifests only, so a run that stopped midway is never picked
up. Stage tables are removed when the run is published; a run that fails removes its folder, and one whose driver was
lost is removed by a later ``remove_unpublished``.

The manifest is written under another name and renamed, and is numbered after the last one; a run that finds its
number taken by another run fails.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortkit.operators.bag import TIMES, expand_bag
from cohortkit.schemas import broken_rules

BROKEN = "broken_rules"


@dataclass
class Manifest:
    number: int
    run: str
    published_at: float
    tables: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    quarantined: dict[str, int] = field(default_factory=dict)
    inputs: dict[str, str] = field(default_factory=dict)
    watermarks: dict[str, int] = field(default_factory=dict)
    salt_check: str = ""


def salt_check(salt: str) -> str:
    """A slow one-way value by which a run can tell that it has the salt of the run before."""
    return hashlib.pbkdf2_hmac("sha256", salt.encode(), b"cohortkit salt check", 200_000).hex()


class _Files:
    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def names(self, p: str) -> list[tuple[str, int]]:
        """(name, time of change in ms) of what a folder holds."""
        return [(s.getPath().getName(), s.getModificationTime()) for s in self.fs.listStatus(self.path(p))] if self.fs.exists(self.path(p)) else []

    def read(self, p: str) -> str:
        stream = self.fs.open(self.path(p))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, p: str, text: str) -> None:
        stream = self.fs.create(self.path(p), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def remove(self, p: str) -> None:
        self.fs.delete(self.path(p), True)


def input_state(spark: SparkSession, df: DataFrame) -> str:
    """A digest of names, sizes and times of the files that ``df`` reads."""
    h = hashlib.sha256()
    for name in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        h.update(f"{name}\0{status.getLen()}\0{status.getModificationTime()}\n".encode())
    return h.hexdigest()


def published(spark: SparkSession, root: str) -> list[Manifest]:
    """Manifests of ``root`` in the order in which they were published."""
    folder = f"{root.rstrip('/')}/published"
    files = _Files(spark, folder)
    found = [json.loads(files.read(f"{folder}/{name}")) for name, _ in files.names(folder) if name.endswith(".json")]
    return sorted((Manifest(**m) for m in found), key=lambda m: m.number)


def last_published(spark: SparkSession, root: str) -> Manifest | None:
    runs = published(spark, root)
    return runs[-1] if runs else None


def remove_unpublished(spark: SparkSession, root: str, older_than_s: float) -> list[str]:
    """Remove the folders of runs without a manifest in which nothing was written for ``older_than_s`` seconds;
    a run that is still going on writes into its folder. Returns their names."""
    root = root.rstrip("/")
    files, known = _Files(spark, root), {m.run for m in published(spark, root)}
    gone = []
    for name, changed in files.names(root):
        if name.startswith("run-") and name not in known:
            inner = [t for part in ("tables", "stage", "quarantine") for _, t in files.names(f"{root}/{name}/{part}")]
            if time.time() - max([changed, *inner]) / 1000 >= older_than_s:
                files.remove(f"{root}/{name}")
                gone.append(name)
    return gone


class Run:
    """Tables of one run under ``root``. Used as a context: a run that raises is removed."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.run = f"run-{uuid.uuid4().hex[:12]}"
        self.folder = f"{self.root}/{self.run}"
        self.files = _Files(spark, self.root)
        self.tables: dict[str, str] = {}
        self.quarantine: dict[str, str] = {}
        self.rows: dict[str, int] = {}
        self.ended = False

    def __enter__(self) -> "Run":
        return self

    def __exit__(self, kind, value, trace) -> None:
        if not self.ended:
            self.files.remove(self.folder)

    def _write(self, path: str, df: DataFrame, sort: list[str] | None) -> DataFrame:
        seen = Observation()
        (df.sortWithinPartitions(*sort) if sort else df).observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        self.rows[path] = seen.get["rows"]
        return self.spark.read.schema(df.schema).parquet(path)

    def stage(self, name: str, df: DataFrame, sort: list[str] | None = None) -> DataFrame:
        """A table of this run that is not published."""
        return self._write(f"{self.folder}/stage/{name}", df, sort)

    def table(self, name: str, df: DataFrame, sort: list[str] | None = None) -> DataFrame:
        """A table to publish."""
        self.tables[name] = f"{self.folder}/tables/{name}"
        return self._write(self.tables[name], df, sort)

    def both(self, name: str, df: DataFrame, expand: bool, sort: list[str] | None = None) -> DataFrame:
        """``df`` for the following stages. It is published as it is, or, where its rows have weights and the bag
        is asked for, as that."""
        if not (expand and TIMES in df.columns):
            return self.table(name, df, sort)
        held = self.stage(name, df, sort)
        self.table(name, expand_bag(held))
        return held

    def accepted(self, name: str, df: DataFrame, contract: str, expand: bool = False, sort: list[str] | None = None) -> DataFrame:
        """As :meth:`both`, of the rows of ``df`` that keep the ``contract``. The others, which the same job counts,
        go to the run's quarantine with the names of the rules they break."""
        checked = df.withColumn(BROKEN, broken_rules(df, contract))
        seen = Observation()
        counted = checked.observe(seen, F.coalesce(F.sum(F.when(F.size(BROKEN) > 0, 1)), F.lit(0)).alias("broken"))
        kept = self.both(name, counted.where(F.size(BROKEN) == 0).drop(BROKEN), expand, sort)
        if seen.get["broken"]:
            self.quarantine[name] = f"{self.folder}/quarantine/{name}"
            self._write(self.quarantine[name], checked.where(F.size(BROKEN) > 0), None)
        return kept

    def publish(self, inputs: dict[str, str], watermarks: dict[str, int], salt: str) -> Manifest:
        last = last_published(self.spark, self.root)
        m = Manifest((last.number if last else 0) + 1, self.run, time.time(), dict(self.tables), {n: self.rows[p] for n, p in self.tables.items()},
                     {n: self.rows[p] for n, p in self.quarantine.items()}, inputs, watermarks, salt_check(salt))
        folder = f"{self.root}/published"
        self.files.fs.mkdirs(self.files.path(folder))
        aside, final = f"{folder}/.{self.run}", f"{folder}/{m.number:08d}.json"
        self.files.write(aside, json.dumps(asdict(m), indent=1))
        if self.files.fs.exists(self.files.path(final)) or not self.files.fs.rename(self.files.path(aside), self.files.path(final)):
            self.files.remove(aside)
            raise RuntimeError(f"another run was published as number {m.number}")
        self.ended = True
        self.files.remove(f"{self.folder}/stage")
        return m
