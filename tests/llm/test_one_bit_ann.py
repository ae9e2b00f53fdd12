import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import one_bit_ann as ann
from cohortkit.llm.tables import Stages

SCHEMA = "vec_id bigint, embedding array<float>"


def search(spark, rows, k=10, every=10):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("x")).withColumn("norm", F.lit("x"))
    return [tuple(r) for r in ann.nearest(Stages(spark), df, F.col("vec_id") % every == 0, k).orderBy("query_id", "rank").collect()]


def brute_force(rows, k=10, every=10):
    good = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    good.sort(key=lambda r: (len(r[1]), r[0]))  # queries by length and id
    out = []
    for n, (q, x) in enumerate(good):
        if q % every == 0:
            near = sorted((float(np.sqrt(((y - x) ** 2).sum())), i) for m, (i, y) in enumerate(good) if m != n and len(y) == len(x))[:k]
            out += [(q, r + 1, i, s) for r, (s, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("dim", [1, 7, 64])
def test_finds_what_brute_force_finds(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(i, rng.standard_normal(dim).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[5][1]) for i in range(120)]  # one common vector
    rows += [(2000, None), (2010, [0.0] * dim), (2020, [float("nan")] * dim), (2030, [None] + [1.0] * (dim - 1)), (2040, [float("inf")] * dim), (None, [1.0] * dim)]
    rows += [rows[7], rows[7]]
    got, want = sorted(search(spark, rows)), brute_force(rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    hits = len({g[:1] + g[2:3] for g in got} & {w[:1] + w[2:3] for w in want})
    assert hits >= 0.99 * len(want)
    exact = {(w[0], w[2]): w[3] for w in want}
    assert all(abs(exact[g[0], g[2]] - g[3]) < 1e-12 for g in got if (g[0], g[2]) in exact)
    common = [g for g in got if g[0] == 1050]
    assert [g[2] for g in common] == [5, *range(1000, 1009)]


def test_few_and_no_rows(spark):
    assert search(spark, []) == [] and search(spark, [(1, None)]) == []
    assert search(spark, [(0, [1.0, 2.0])]) == []
    assert search(spark, [(0, [1.0, 2.0]), (3, [1.0, 3.0])]) == [(0, 1, 3, 1.0)]
    rows = [(0, [1.0]), (1, [1.0, 2.0]), (2, [3.0]), (10, [2.0, 2.0]), (20, [1.5, 2.0]), (20, [1.0, 2.5])]
    assert sorted(search(spark, rows)) == brute_force(rows)  # by length


def test_rows_that_share_a_vec_id(spark):
    """Every row but the query's own is a candidate, and each is a query."""
    rows = [(10, [0.0, 1.0]), (10, [0.0, 2.0]), (10, [0.0, 1.0]), (3, [5.0, 1.0]), (3, [5.0, 1.0])]
    got, want = sorted(search(spark, rows, k=3)), brute_force(rows, k=3)
    assert got == want and len(got) == 9


def test_many_query_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(60)]
    monkeypatch.setattr(ann, "QUERY_BLOCK", 8)
    assert [g[:3] for g in search(spark, rows, every=2)] == [w[:3] for w in brute_force(rows, every=2)]


def test_recall_on_the_table(spark):
    path = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet'")
    want = {(r[0], r[2]) for r in con.sql(f"SELECT query_id, rank, vec_id FROM ({ann.ORACLE})").fetchall()}
    got = {(r.query_id, r.vec_id) for r in ann.op9_rotated_one_bit(spark, path).collect()}
    assert len(got & want) >= 0.99 * len(want)
