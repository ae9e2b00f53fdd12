import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from cohortkit.llm import minhash
from cohortkit.llm.tables import Stages

SCHEMA = "doc_id bigint, text string, n bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_force(rows):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingle_set(t))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, s) for i, own in sets.items() for s in own if s]
    for k, (i, s) in enumerate(flat):
        for j, r in flat[:k]:
            both = len(s & r)
            if 100 * both >= 75 * (len(s) + len(r) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return sorted(((i, len(shingle_set(t)), find(i) if i is not None else None, i is None or find(i) == i) for i, t in rows), key=str)


def rows():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    text = lambda n: [word() for _ in range(n)]
    out = []
    base = text(120)
    for k in range(150):  # near copies that are links of some of the others only
        own = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
            own[rng.randrange(120)] = word()
        out.append((1000 + k, " ".join(own)))
    passage = text(60)
    out += [(3000 + k, " ".join(text(30) + passage + text(30))) for k in range(60)]  # a passage that many share
    out += [(4000 + k, "Exact  COPY of\nthis\ttext here, " + "again " * 5) for k in range(40)]
    chain = text(200)
    out += [(5000 + k, " ".join(chain[12 * k:12 * k + 100])) for k in range(8)]
    out += [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE Two"), (6, "one two three"), (7, "w " * 50000), (8, "w " * 40000),
            (None, "one two"), (None, None), (9, " ".join(text(30))), (10, "İstanbul ÀB c d e"), (11, "i̇stanbul àb c d e")]
    out += [out[0], out[0], (1000, " ".join(text(40))), (9, "one two")]  # repeated rows, one id with other texts
    for k in range(30):  # two texts an id, a near copy of each
        for j in range(2):
            own = text(60)
            out += [(7000 + k, " ".join(own)), (7100 + 2 * k + j, " ".join([*own[:-1], word()]))]
    return out


def test_equals_brute_force(spark):
    data = rows()
    df = spark.createDataFrame([(*r, 0) for r in data], SCHEMA).withColumn("node", F.lit("x")).withColumn("bucket", F.lit(1))
    got = minhash.near_duplicates(Stages(spark), df)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(data)


def test_one_of_each_stays(spark):
    data = rows()
    df = spark.createDataFrame([(*r, 0) for r in data], SCHEMA).withColumn("component_id", F.lit("x"))
    left = minhash.keep_one_of_each(Stages(spark), df)
    assert left.columns == df.columns
    ids = [r.doc_id for r in left.collect()]
    kept = {i for i, _, c, _ in brute_force(data) if i is not None and c == i}
    want = sorted(i for i, _ in {r for r in data if r[0] in kept})  # all different texts of a doc_id, each once
    assert sorted(i for i in ids if i is not None) == want and ids.count(None) == 2


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert minhash.near_duplicates(Stages(spark), none).count() == 0
    assert minhash.keep_one_of_each(Stages(spark), none).count() == 0


def test_signatures_leave_a_chunk_of_texts_at_a_time():
    texts = [None, " ".join(f"a{i}" for i in range(60_000)), "one two", " ".join(f"b{i}" for i in range(60_000)), ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    out = list(minhash._signatures(iter([batch])))
    assert len(out) > 1 and max(b.num_rows for b in out) < 5
    one_by_one = [next(minhash._signatures(iter([batch.slice(i, 1)]))) for i in range(5)]
    assert pa.Table.from_batches(out).to_pylist() == pa.Table.from_batches(one_by_one).to_pylist()
    assert len(list(minhash._full_sets(iter([batch])))) > 1
