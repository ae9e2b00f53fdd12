import duckdb
from pyspark.sql import functions as F

from cohortkit.llm import quality_lines as q
from cohortkit.llm.tables import Stages

SCHEMA = "doc_id bigint, text string, source string, n_chars bigint"


def body(i, n=80):
    return " ".join(f"w{i}x{k}" for k in range(n))


def rows():
    boiler = "All rights reserved by the Site, please see the terms and conditions of use"
    terms = " ".join(f"term{k}" for k in range(60))
    out = [(i, f"{body(i)}\n{boiler}\n{body(i + 1000, 10)}\n{terms.upper()}", "host", 0) for i in range(40)]
    out += [(100 + i, f"{boiler}\n{boiler} \n{body(i + 500, 40)}", "other", 0) for i in range(3)]  # too few documents there
    out += [(200, f"{terms}\n{body(9999, 40)}", "host", 0)]  # depleted
    out += [(300 + i, body(7777), "host", 0) for i in range(30)]  # copies count once
    out += [(400, None, "host", 0), (401, "", "host", 0), (402, " \n\t ", None, 0), (None, body(5), None, 0), (403, "a b c " * 60, "host", 0),
            (404, body(1, 50) + "\n#|é* 中<>\n#|é* 中<>\n\n", "host", 0), (405, body(2, 30000), "host", 0), (405, body(2, 30000), "host", 0)]
    return out


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA).withColumn("host", F.lit(1)).withColumn("uid", F.lit(2)).withColumn("_lines", F.lit(3))


def oracle(table):
    con = duckdb.connect()
    con.register("documents", table)
    return con.sql(q.ORACLE).fetchall()


def key(r):
    return tuple((x is not None, x) for x in r)


def test_verdicts_equal_sql(spark):
    df = frame(spark)
    verdicts = q.quality_rules(Stages(spark), df)[0].drop("uid")
    got = sorted(map(tuple, verdicts.collect()), key=key)
    # null and repeated ids are told apart by row in Spark; the SQL joins by id, so it gets own ids
    own = df.toArrow().to_pylist()
    import pyarrow as pa
    ids = [r["doc_id"] for r in own]
    table = pa.Table.from_pylist([{**r, "doc_id": i} for i, r in enumerate(own)])
    want = sorted(((ids[r[0]], *r[1:]) for r in oracle(table)), key=key)
    assert got == want
    by_id = {r.doc_id: r for r in verdicts.collect()}
    assert by_id[0].kept and by_id[0].n_removed_words == 74 and not by_id[200].kept and not by_id[200].base_failed
    assert by_id[100].kept and by_id[300].kept and by_id[400].base_failed and by_id[403].base_failed


def test_cleaned_texts(spark):
    df = frame(spark)
    clean = q.clean_documents(Stages(spark), df)
    assert clean.columns == df.columns
    got = {r.doc_id: r for r in clean.collect()}
    kept = [r.doc_id for r in q.quality_rules(Stages(spark), df)[0].where("kept").collect()]
    assert sorted(map(str, kept)) == sorted(str(r.doc_id) for r in clean.collect())
    assert got[0].text == f"{body(0)}\n{body(1000, 10)}" and got[0].n_chars == len(got[0].text)
    assert got[100].text == rows()[40][1]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert q.quality_rules(Stages(spark), none)[0].count() == 0
    assert q.clean_documents(Stages(spark), none).count() == 0


def test_oracle(spark):
    got = sorted(map(tuple, q.op1_line_frequency(spark, "/root/testdata/sf0.001").collect()))
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    assert got == sorted(con.sql(q.ORACLE).fetchall())


def test_workers_hand_on_a_chunk_at_a_time():
    import pyarrow as pa
    n = 3000
    texts = [f"{body(i)}\nline {i % 7} of the host\n{body(i + 1, 20)}" for i in range(n)]
    ids = pa.array(range(n), pa.int64())
    whole = pa.RecordBatch.from_arrays([ids, ids, pa.array(["h"] * n), pa.array(texts)], names=["uid", "doc_id", "host", "text"])
    out = list(q._measure(iter([whole])))
    size = whole.nbytes / n
    assert sum(b.num_rows for b in out) == n and max(b.num_rows for b in out) * size <= 1 << 20
    assert [x for b in out for x in b.column(0).to_pylist()] == list(range(n))
    some = [None if i % 2 else [x["line"] for x in row if x["words"] < 10] for b in out for i, row in zip(b.column(0).to_pylist(), b.column(9).to_pylist(), strict=True)]
    batch = pa.RecordBatch.from_arrays([ids, pa.array(texts), pa.array(some, pa.list_(pa.int64()))], names=["doc_id", "text", "frequent"])
    for given in (batch, batch.slice(1001)):
        got = list(q._clean(["doc_id", "text"], "text")(iter([given])))
        assert sum(b.num_rows for b in got) == given.num_rows and max(b.num_rows for b in got) * size <= 1 << 20
        by_id = {i: t for b in got for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
        assert all(by_id[i] == texts[i] for i in by_id if i % 2) and all(len(by_id[i]) < len(texts[i]) for i in by_id if i % 2 == 0)
