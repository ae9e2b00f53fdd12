"""Stage tables, joins that stay even when one key holds a third of all rows, and components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.session import ensure_checkpoint_dir

# A key holding at least this share of the rows is heavy; there are at most 1 / share such keys,
# which is the proven bound of every broadcast in this module.
HEAVY_SHARE = 1 / 1000
PAIRS_A_MEMBER = 4  # buckets that hold no more pairs in all are compared whole
EDGES_A_TASK = 100_000
TEXT_TABLES = ("lines", "distinct", "texts", "numbered")  # of line dedup; their texts are most of what it holds on disk
BROADCAST_ROWS = 2_000_000  # keys of 8 to 16 bytes; beyond it a join shuffles


def by_place(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns named c0, c1, ..., and the name of each in there: columns that only travel
    along cannot clash with those of an operator."""
    own = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return df.toDF(*own.values()), own


class Stages:
    """Tables of one run under the cluster's shared ``spark.checkpoint.dir``.

    A written table cuts the lineage: a lost executor costs a re-read, and values that depend on
    the order of rows (generated ids, ranks) are fixed once."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}"
        self.made = 0
        self.written: list[tuple[DataFrame, str]] = []

    def path(self, name: str) -> str:
        self.made += 1
        return f"{self.root}/{self.made:03d}-{name}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path, compression="zstd" if name in TEXT_TABLES else None)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.written.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables of which everything that reads them is written. The driver's collection lets
        the shuffle files of ended jobs go, too, which otherwise stay until it happens to run."""
        for df in tables:
            for one, path in self.written:
                if one is df:
                    p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                    p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        self.written = [(one, path) for one, path in self.written if not any(one is df for df in tables)]
        self.spark._jvm.System.gc()


def join_unique(left: DataFrame, right: DataFrame, key: str, cols: list[str], rows: str, total: int) -> DataFrame:
    """``left`` left-joined with ``right``, which has one row per ``key``; null keys match nothing.

    ``rows`` is a column of ``right`` with the number of left rows of the key, ``total`` their sum.
    The heavy keys (at most 1 / HEAVY_SHARE of them) are broadcast; their left rows and those
    without a key get a random-like second key part, so the shuffle join stays even. With heavy keys
    alone there is nothing to shuffle."""
    least = max(2, int(total * HEAVY_SHARE))
    heavy = right.where(F.col(rows) >= least).select(F.col(key).alias("_hk"), F.struct(*cols).alias("_heavy"))
    light = right.where(F.col(rows) < least).select(F.col(key).alias("_lk"), F.struct(*cols).alias("_light"), F.lit(0).alias("_ls"))
    spread = F.when(F.col("_heavy").isNotNull() | F.col(key).isNull(), 1 + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))).otherwise(0)
    out = left.join(F.broadcast(heavy), F.col(key) == F.col("_hk"), "left")
    if light.isEmpty():
        return out.select(*[F.col(c) for c in left.columns], *[F.col("_heavy")[c].alias(c) for c in cols])
    out = out.withColumn("_s", spread.cast("int"))
    k = F.coalesce(F.col(key), F.lit("0").cast(left.schema[key].dataType))
    out = out.withColumn("_k", k).join(light, (F.col("_k") == F.col("_lk")) & (F.col("_s") == F.col("_ls")), "left")
    both = F.coalesce("_heavy", "_light")
    return out.select(*[F.col(c) for c in left.columns], *[both[c].alias(c) for c in cols])


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or has one edge, to a centre."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def connected_components(stages: Stages, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over the undirected ``edges`` (u, v longs).

    Alternating large-star and small-star until the edges are stars around the smallest nodes.
    Every node's smallest neighbour is an aggregate with map-side combine; it is joined back by a
    plain shuffle join, of which adaptive execution splits a hub's partition. Tables of few edges
    are written by few tasks."""
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = stages.put("edges", e)
    tasks = 4 + e.count() // EDGES_A_TASK
    while not _is_forest_of_stars(e):
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = sym.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = stages.put("large-star", large.coalesce(tasks).distinct().coalesce(tasks))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v")
        e = stages.put("small-star", small.coalesce(tasks).distinct().coalesce(tasks))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def semi_join(left: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose ``key`` is in the written table ``keys``: broadcast if its counted rows
    stay within BROADCAST_ROWS, else a shuffle join."""
    small = keys.count() <= BROADCAST_ROWS
    return left.join(F.broadcast(keys) if small else keys, key, "left_semi")


def _open_buckets(stages: Stages, members: DataFrame, components: DataFrame) -> DataFrame:
    """Members, with their component, of the buckets that still hold more than one component."""
    named = members.select("bucket", "node").join(components, "node", "left")
    named = stages.put("named", named.select("bucket", "node", F.coalesce("component", "node").alias("component")))
    mixed = named.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b")
    return stages.put("open", named.join(mixed.select("bucket"), "bucket", "left_semi"))


def bucket_pairs(members: DataFrame, *, condition: str = "true", cols: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (u > v) of members (bucket, node, component, ``cols``) of one bucket and different
    components for which ``condition`` on the ``cols``, named x_... and y_..., holds."""
    x = members.select("bucket", F.col("node").alias("a"), F.col("component").alias("x"), *[F.col(c).alias(f"x_{c}") for c in cols])
    y = members.select("bucket", F.col("node").alias("b"), F.col("component").alias("y"), *[F.col(c).alias(f"y_{c}") for c in cols])
    pairs = x.join(y, (x.bucket == y.bucket) & F.expr(f"x < y AND ({condition})"))
    return pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def linked_components(stages: Stages, members: DataFrame, confirm, rest_links=None, links: DataFrame | None = None) -> DataFrame:
    """(node, component) over the links that ``confirm`` finds among members of a common bucket.

    ``members`` (bucket, node) is a written table; ``confirm`` maps pairs (u > v) to those that are
    links; ``links`` are known ones. Large buckets are not expanded into their pairs: first every
    member is compared with a hub of its bucket (a member of many buckets meets as many hubs). For
    what is then still in different components, ``rest_links(rest, tried)`` finds the links (default:
    among all pairs of a bucket); it may leave out none. So the components are those of all links."""
    if links is None:
        links = stages.spark.createDataFrame([], "u bigint, v bigint")
    rest = members.withColumn("component", F.col("node"))
    held = rest.groupBy("bucket").agg(F.count("*").alias("n")).agg(F.sum("n"), F.sum(F.expr("CAST(n AS DOUBLE) * n / 2"))).first()
    if not held[0] or held[1] <= PAIRS_A_MEMBER * held[0]:
        found = confirm(stages.put("pairs", bucket_pairs(rest)))
        return connected_components(stages, links.unionByName(found))
    rank = F.struct(F.xxhash64("node", "bucket").alias("r"), "node")
    hubs = rest.groupBy("bucket").agg(F.min(rank).alias("hub"), F.count("*").alias("n"))
    at_hub = join_unique(rest, hubs, "bucket", ["hub"], "n", held[0]).where("node <> hub.node")
    tried = stages.put("pairs", at_hub.select(F.greatest("node", "hub.node").alias("u"), F.least("node", "hub.node").alias("v")).distinct())
    links = links.unionByName(stages.put("links", confirm(tried)))
    components = connected_components(stages, links)
    rest = _open_buckets(stages, rest, components)
    if rest.isEmpty():
        return components
    found = rest_links(rest, tried) if rest_links else confirm(stages.put("pairs", bucket_pairs(rest).join(tried, ["u", "v"], "left_anti")))
    found = stages.put("links", found)
    return components if found.isEmpty() else connected_components(stages, links.unionByName(found))
