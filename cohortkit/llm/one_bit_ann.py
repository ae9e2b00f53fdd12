"""Nearest neighbours by randomly rotated one-bit codes.

Every vector is centred, normalised, rotated by a fixed random orthogonal matrix and kept as the
signs of its coordinates, packed, with two correction scalars: its distance to the centre and the
inner product of the unit vector with its code. From a code, the inner product with a rotated query
is estimated together with a bound of the error that holds with high probability; vectors whose
lower bound of the distance does not exceed the k-th best distance so far are measured exactly.

Queries are searched in blocks of a fixed number, each against all rows; a task keeps the k best of
its rows, and those are merged per query. The error bound, not a cap, decides what is measured.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit.llm.tables import Stages

K = 10
QUERY_BLOCK = 4096  # queries broadcast at once
EPSILON = 4.0  # width of the error bound, in its standard deviations
SEED = 20240607


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same for every task."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(SEED)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _encode(centre: np.ndarray):
    dim = len(centre)
    turn = rotation(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column(2), dim) - centre
            norm = np.linalg.norm(x, axis=1)
            unit = (x / np.where(norm > 0, norm, 1)[:, None]) @ turn
            fit = np.abs(unit).sum(axis=1) / np.sqrt(dim)  # inner product of unit vector and code
            codes = np.packbits(unit > 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm), pa.array(fit)],
                names=[*batch.schema.names, "code", "norm", "fit"])
    return run


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """(row, vec_id, embedding in doubles) of the rows that take part, ``row`` telling apart rows of one vec_id:
    not those without vec_id, nor vectors that are null, zero, or hold a null or non-finite component."""
    x = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    x = x.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda v: v != 0))
    return x.select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding")


INDEX = "row bigint, vec_id bigint, embedding array<double>, code binary, norm double, fit double"


def build_index(stages: Stages, vectors: DataFrame, dim: int) -> tuple[DataFrame, np.ndarray]:
    """The index of ``vectors`` (row, vec_id, embedding of ``dim`` components), and their centre."""
    centre = np.array(vectors.agg(*[F.avg(F.col("embedding")[i]) for i in range(dim)]).first(), np.float64)
    return stages.put("index", vectors.mapInArrow(_encode(centre), INDEX)), centre


def _candidates(index: DataFrame, k: int) -> DataFrame:
    """Equal vectors with their k + 1 smallest vec_ids only: as ties go to smaller ids, and one may be
    the query's own, others can be no result. The limit works before the shuffle, too."""
    same = Window.partitionBy("embedding").orderBy("vec_id", "row")
    return index.withColumn("rank", F.row_number().over(same)).where(F.col("rank") <= k + 1).drop("rank")


def _search(ids: np.ndarray, vec_ids: np.ndarray, queries: np.ndarray, centre: np.ndarray, k: int):
    """The ``k`` nearest of a task's index rows for each of the ``queries``, whose own rows are ``ids``, of ``vec_ids``."""
    dim = queries.shape[1]
    centred = queries - centre
    q_norm = np.linalg.norm(centred, axis=1)
    turned = (centred / np.where(q_norm > 0, q_norm, 1)[:, None]) @ rotation(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_d = np.full((len(ids), k), np.inf)
        best_v = np.full((len(ids), k), np.iinfo(np.int64).max)
        best_r = np.full((len(ids), k), np.iinfo(np.int64).max)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                own, vec = (rows.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
                x = _vectors(rows.column(2), dim)
                bits = np.unpackbits(np.frombuffer(b"".join(rows.column(3).to_pylist()), np.uint8).reshape(len(vec), -1), axis=1, count=dim)
                signs = (bits.astype(np.float64) * 2 - 1) / np.sqrt(dim)
                norm, fit = (rows.column(c).to_numpy(zero_copy_only=False) for c in (4, 5))
                fit = np.where(fit > 0, fit, 1)
                error = EPSILON * np.sqrt(np.maximum(0, 1 - fit ** 2) / max(1, dim - 1)) / fit
                for a in range(0, len(ids), 512):
                    b = min(a + 512, len(ids))
                    guess = turned[a:b] @ (signs / fit[:, None]).T
                    scale = 2 * q_norm[a:b, None] * norm
                    # smallest squared distance within the bound, with room for rounding
                    low = (q_norm[a:b, None] ** 2 + norm ** 2) - scale * (guess + error)
                    low -= 1e-9 * (q_norm[a:b, None] ** 2 + norm ** 2)
                    for i in range(a, b):
                        maybe = np.flatnonzero(low[i - a] <= best_d[i, -1] ** 2)
                        maybe = maybe[np.argsort(low[i - a][maybe], kind="stable")]
                        for c in range(0, len(maybe), 64):  # the most promising first: they tighten the limit
                            some = maybe[c:c + 64]
                            some = some[(low[i - a][some] <= best_d[i, -1] ** 2) & (own[some] != ids[i])]
                            if not len(some):
                                continue
                            d = np.concatenate([best_d[i], np.sqrt(((x[some] - queries[i]) ** 2).sum(axis=1))])
                            v, r = np.concatenate([best_v[i], vec[some]]), np.concatenate([best_r[i], own[some]])
                            top = np.lexsort((r, v, d))[:k]
                            best_d[i], best_v[i], best_r[i] = d[top], v[top], r[top]
        found = np.isfinite(best_d)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(np.repeat(x, found.sum(axis=1))) for x in (ids, vec_ids)), pa.array(best_v[found]), pa.array(best_r[found]), pa.array(best_d[found])],
            names=["query", "query_id", "vec_id", "row", "score"])
    return run


def nearest(stages: Stages, embeddings: DataFrame, is_query, k: int = K) -> DataFrame:
    """The ``k`` nearest other vectors of each row of ``embeddings`` for which ``is_query`` holds:
    query_id, rank (from 1), vec_id, score (Euclidean distance of the original vectors, in doubles).

    Ties go to the smaller vec_id; fewer rows than ``k`` are all returned. A row is not its own neighbour, but
    rows that share its vec_id are; each row of a repeated vec_id is a query and a candidate of its own. Vectors of
    several lengths are searched by length, a query having candidates of its own length only. Extra columns
    are ignored; an empty table gives no rows."""
    spark = stages.spark
    vectors = stages.put("vectors", usable_vectors(embeddings))
    found = None
    for r in vectors.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).orderBy("dim").collect():  # a row per length
        for best in _search_length(stages, vectors.where(F.size("embedding") == r.dim), r.dim, is_query, k):
            found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    order = Window.partitionBy("query").orderBy("score", "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _search_length(stages: Stages, vectors: DataFrame, dim: int, is_query, k: int) -> Iterator[DataFrame]:
    """The best of every task for the queries among ``vectors``, block by block of queries."""
    index, centre = build_index(stages, vectors, dim)
    rows = stages.put("candidates", _candidates(index, k))
    queries = index.where(is_query).select("row", "vec_id", "embedding").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(1 << 40)))
    queries = stages.put("queries", queries)
    blocks = max(1, -(-queries.count() // (QUERY_BLOCK // 2)))  # half full on average, so never too large
    for b in range(blocks):
        part = queries.where(F.pmod("block", F.lit(blocks)) == b).orderBy("vec_id", "row").select("row", "vec_id", "embedding").toArrow()
        if not part.num_rows:
            continue
        search = _search(part.column(0).to_numpy(), part.column(1).to_numpy(), _vectors(part.column(2), dim), centre, k)
        best = rows.mapInArrow(search, "query bigint, query_id bigint, vec_id bigint, row bigint, score double")
        yield stages.put("best", best) if blocks > 1 else best


def op9_rotated_one_bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(Stages(spark), spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


ORACLE = f"""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS score
  FROM v q JOIN v c ON q.row <> c.row AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score, vec_id) AS rank FROM p) WHERE rank <= {K}
"""
