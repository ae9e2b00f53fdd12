"""Measured broadcasts, and joins with a lookup table of any size.

A side is broadcast only if its size is proven. Columns of fixed width are, where the rows that the plan can give are
bounded by the row counts in the footers of a few files (``_row_bound``). Otherwise its rows are measured: their bytes
are added up, strings and lists by their real length, while the side is written as a stage under the cluster's
checkpoint folder (an optimizer's estimate counts a list as one element and trusts compressed file sizes). The written
table is what is then joined, so the side is computed once and lost executors cost a re-read. A plain projection
of a table that is already written is measured in place.

What is broadcast at once adds up on the driver, which builds each side's hash table and sends it on. So the limit is one
of a whole plan: sides that are already broadcast for the facts (``_held``) leave less for the next one. A row counts with
its place in that table.

Above the limit ``join_lookup`` splits the facts: the few keys that hold a large share of them are found by a count,
their lookup rows are broadcast (their number is bounded by the share), and only the other facts are shuffled.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.session import ensure_checkpoint_dir

DEFAULT_LIMIT = 64 * 1024 * 1024
ROW_OVERHEAD = 64  # a hash table has two slots of two longs a key at least, a pointer and a header
# A key that holds at least this share of the facts is heavy, so there are at most 1 / HEAVY_SHARE of them.
HEAVY_SHARE = 1 / 1000
FOOTERS = 64  # files whose footers are read for a bound
_ROWS: dict[tuple, int] = {}
_SIZES: dict[int, int] = {}  # bytes of what was hinted for broadcast, by the hash of its plan
_FIXED = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType, T.FloatType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def value_bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value in memory, 0 for its content if null."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit(8) + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.ArrayType):
        each = F.aggregate(F.transform(value, lambda x: value_bytes(x, kind.elementType).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
        return F.lit(24) + F.coalesce(each, F.lit(0))
    if isinstance(kind, T.MapType):
        return F.lit(24) + value_bytes(F.map_keys(value), T.ArrayType(kind.keyType)) + value_bytes(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        out = F.lit(16)
        for f in kind.fields:
            out = out + value_bytes(value.getField(f.name), f.dataType)
        return out
    return F.lit(16 if isinstance(kind, T.DecimalType) else 8)


def _row_bytes(df: DataFrame) -> Column:
    out = F.lit(ROW_OVERHEAD)
    for f in df.schema.fields:
        out = out + value_bytes(F.col(f"`{f.name}`"), f.dataType)
    return F.coalesce(F.sum(out.cast("long")), F.lit(0).cast("long"))


def _is_written(df: DataFrame) -> bool:
    """Whether ``df`` is columns of one file table, perhaps filtered."""
    nodes = re.findall(r"^[\s:+\-]*(\w+)", df._jdf.queryExecution().optimizedPlan().toString(), re.M)
    return bool(nodes) and nodes[-1] == "Relation" and set(nodes[:-1]) <= {"Project", "Filter"}


def written(df: DataFrame, *metrics: Observation | Column) -> DataFrame:
    """``df`` as a table under the checkpoint folder; with an observation and its columns, observed on the way."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/cohortkit-sides/{uuid.uuid4().hex}"
    (df.observe(*metrics) if metrics else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _footer_rows(spark, files: list[str]) -> int | None:
    """Rows of some parquet files by their footers; None for many files, or for another format."""
    jvm, conf, total = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    if len(files) > FOOTERS:
        return None
    for name in files:
        path = jvm.org.apache.hadoop.fs.Path(name)
        state = path.getFileSystem(conf).getFileStatus(path)
        key = (name, state.getLen(), state.getModificationTime())
        if key not in _ROWS:
            if not name.endswith(".parquet"):
                return None
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
            try:
                _ROWS[key] = reader.getRecordCount()
            finally:
                reader.close()
        total += _ROWS[key]
    return total


def _row_bound(spark, node) -> int | None:
    """The most rows that a logical plan can give, None if that is not plain. Filters, projections, aggregates and
    semi joins give no more rows than they get, a join no more than all pairs."""
    name, children = node.nodeName(), node.children()
    kids = [_row_bound(spark, children.apply(i)) for i in range(children.size())] if name != "LogicalRelation" else []
    if any(k is None for k in kids):
        return None
    if name in ("Project", "Filter", "Aggregate", "Distinct", "Deduplicate", "Sort", "Window", "ResolvedHint", "SubqueryAlias"):
        return max(1, kids[0])
    if name == "Union":
        return sum(kids)
    if name == "LocalRelation":
        return node.data().size()
    if name == "Join":
        kind = node.joinType().toString()
        if kind in ("LeftSemi", "LeftAnti"):
            return kids[0]
        pairs = max(1, kids[0]) * max(1, kids[1])
        return pairs + kids[0] + kids[1] if kind == "FullOuter" else pairs if kind in ("Inner", "LeftOuter", "RightOuter") else None
    if node.getClass().getSimpleName() == "LogicalRelation":
        location = getattr(node.relation(), "location", None)
        return _footer_rows(spark, list(location().inputFiles())) if location else None
    return None


def _bound(df: DataFrame) -> int | None:
    """Bytes that ``df`` can have at most, if its plan shows it."""
    if not all(isinstance(f.dataType, _FIXED) for f in df.schema.fields):
        return None
    rows = _row_bound(df.sparkSession, df._jdf.queryExecution().optimizedPlan())
    return None if rows is None else rows * (ROW_OVERHEAD + 16 * len(df.columns))


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` as a written table, and its bytes in memory."""
    if _is_written(df):
        return df, df.agg(_row_bytes(df)).first()[0]
    seen = Observation()
    side = written(df, seen, _row_bytes(df).alias("bytes"))
    return side, seen.get["bytes"] or 0


def _hinted(side: DataFrame, size: int) -> DataFrame:
    _SIZES[side._jdf.queryExecution().analyzed().semanticHash()] = size
    return F.broadcast(side)


def _held(df: DataFrame) -> int:
    """Bytes of the sides that the plan of ``df`` broadcasts, each counted once."""
    seen, nodes = {}, [df._jdf.queryExecution().analyzed()]
    while nodes:
        node = nodes.pop()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "ResolvedHint":
            plan = children.apply(0).semanticHash()
            seen[plan] = _SIZES.get(plan, 0)
    return sum(seen.values())


def broadcast_checked(df: DataFrame, limit_bytes: int = DEFAULT_LIMIT, beside: DataFrame | None = None) -> DataFrame:
    """``df``, hinted for broadcast if its measured bytes stay within the limit, else for a shuffle join (without a
    hint the optimizer would go by the size of compressed files). ``beside`` is what it is joined to."""
    limit = max(0, limit_bytes - (_held(beside) if beside is not None else 0))
    side, size = _side(df, limit)
    return _hinted(side, size) if size <= limit else side.hint("shuffle_merge")


def _side(df: DataFrame, limit_bytes: int) -> tuple[DataFrame, int]:
    bound = _bound(df)
    return (df, bound) if bound is not None and bound <= limit_bytes else measured(df)


def join_lookup(facts: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str, how: str = "inner",
                limit_bytes: int | None = None) -> DataFrame:
    """``facts`` joined (inner, left or left_semi) with ``lookup``, which has one row per ``lookup_key`` and shares
    no column name with ``facts``. A null key matches nothing.

    Within the limit the lookup is broadcast. Beyond it, facts of heavy keys meet the broadcast rows of those keys
    where they are, facts without a key are not joined at all, and the others are shuffled: none of their keys
    holds more than HEAVY_SHARE of the facts."""
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(how)
    limit = max(0, (DEFAULT_LIMIT if limit_bytes is None else limit_bytes) - _held(facts))
    side, size = _side(lookup, limit)
    on = F.col(fact_key) == F.col(lookup_key)
    if size <= limit:
        return facts.join(_hinted(side, size), on, how)
    facts = facts if _is_written(facts) else written(facts)  # read several times below
    held = facts.where(F.col(fact_key).isNotNull()).groupBy(F.col(fact_key).alias("_held")).agg(F.count(F.lit(1)).alias("_n"))
    held = written(held)
    total = held.agg(F.sum("_n")).first()[0] or 0
    heavy = F.broadcast(held.where(F.col("_n") >= max(2, int(total * HEAVY_SHARE))).select("_held"))  # at most 1 / HEAVY_SHARE rows
    heavy_rows = F.broadcast(side.join(heavy, F.col(lookup_key) == F.col("_held"), "left_semi"))
    keyed = facts.where(F.col(fact_key).isNotNull())
    is_heavy = F.col(fact_key) == F.col("_held")
    out = keyed.join(heavy, is_heavy, "left_semi").join(heavy_rows, on, how).unionByName(
        keyed.join(heavy, is_heavy, "left_anti").join(side.hint("shuffle_merge"), on, how))
    if how == "left":
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in side.schema.fields]
        out = out.unionByName(facts.where(F.col(fact_key).isNull()).select("*", *none))
    return out
