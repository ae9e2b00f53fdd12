import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cohortkit.llm import context_tree as ct
from cohortkit.llm.tables import Stages

SCHEMA = "doc_id bigint, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held(i):
    return zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2


def log_kt(a, b):
    return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)


class Tree:
    """Context-tree weighting, node by node, with memory of nothing but the counts."""

    def __init__(self, texts, depth):
        self.depth, self.counts = depth, Counter()
        for t in texts:
            for context, byte in self.steps(t):
                for j in range(8):
                    prefix, bit = (1 << j) | byte >> (8 - j), byte >> (7 - j) & 1
                    for d in range(depth + 1):
                        self.counts[context[depth - d:], prefix, bit] += 1
        self.contexts = {}
        for context, prefix, _ in self.counts:
            if context:
                self.contexts.setdefault((context[1:], prefix), set()).add(context)
        self.known = {}

    def steps(self, text):
        data = b"\xff" * self.depth + text.encode() + b"\xff"
        return [(data[i - self.depth:i], data[i]) for i in range(self.depth, len(data))]

    def log_pw(self, context, prefix):
        if (context, prefix) not in self.known:
            own = log_kt(self.counts[context, prefix, 0], self.counts[context, prefix, 1])
            if len(context) < self.depth:
                below = sum(self.log_pw(c, prefix) for c in self.contexts.get((context, prefix), ()))
                own = np.logaddexp(math.log(.5) + own, math.log(.5) + below)
            self.known[context, prefix] = own
        return self.known[context, prefix]

    def bit(self, context, prefix, bit, d=0):
        own = context[self.depth - d:]
        a, b = self.counts[own, prefix, 0], self.counts[own, prefix, 1]
        kt = ((b if bit else a) + .5) / (a + b + 1)
        if d == self.depth:
            return kt
        w = math.exp(math.log(.5) + log_kt(a, b) - self.log_pw(own, prefix))
        return w * kt + (1 - w) * self.bit(context, prefix, bit, d + 1)

    def score(self, text):
        return sum(math.log10(self.bit(c, (1 << j) | x >> (8 - j), x >> (7 - j) & 1)) for c, x in self.steps(text) for j in range(8))


ROWS = [(i, f"the cat no {i} sat on\tthe Mat. Ünï 中\n" * (i % 5)) for i in range(40)] + [
    (50, None), (51, ""), (52, "zzz unseen QQQ"), (None, "null id"), (1, "the cat"), (1, "the cat"), (53, "x" * 3000), (54, " \n ")]


def score(spark, rows, depth):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("block", F.lit(1)).withColumn("score", F.lit(1)).withColumn("key", F.lit(1))
    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7
    return ct.score_documents(Stages(spark), df, part == 2, depth).collect()


def test_equals_the_tree_walked_node_by_node(spark, monkeypatch):
    monkeypatch.setattr(ct, "SHARD_GRAMS", 100)
    monkeypatch.setattr(ct, "BLOCK_BYTES", 1000)
    tree = Tree([t or "" for i, t in ROWS if not held(i)], 3)
    want = sorted((str(i), tree.score(t or "")) for i, t in ROWS)
    got = sorted((str(r.doc_id), r.score) for r in score(spark, ROWS, 3))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1] for g in got], [w[1] for w in want], rtol=1e-9)


def test_base_scores(spark):
    counts, n = Counter(), 0
    words = lambda t: re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER)) + [None]
    for i, t in ROWS:
        if not held(i):
            counts.update(words(t))
            n += len(words(t))
    want = sorted((str(i), held(i), len(words(t)), sum(counts[w] > 0 for w in words(t)), n,
                   round(sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in words(t)), 8)) for i, t in ROWS)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8)) for r in score(spark, ROWS, 3))
    assert got == want


def test_held_out_texts_are_compressed_better_than_by_the_base(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    held_out = [r for r in score(spark, rows, ct.DEPTH) if r.held_out]
    assert sum(r.score for r in held_out) > 1.05 * sum(r.base_score for r in held_out)
    size = {i: len(t.encode()) for i, t in rows}
    bits = -sum(r.score for r in held_out) / math.log10(2) / sum(size[r.doc_id] for r in held_out)
    assert 1.5 < bits < 3.0


def test_no_training_text_and_empty_table(spark):
    only = [i for i in range(200) if held(i)][:2]
    for r in score(spark, [(i, "abc") for i in only], 2):
        assert r.train_tokens == 0 and r.n_known == 0 and abs(r.score - 32 * math.log10(.5)) < 1e-9 and r.base_score == 0
    assert score(spark, [], 2) == []


def test_log_gamma():
    x = np.array([.5, 1, 1.5, 3.25, 8, 100.5, 1e9])
    assert np.allclose(ct.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12)


def test_held_keys_are_added_up_whenever_they_double(monkeypatch):
    import pyarrow as pa

    from cohortkit.llm import textops
    monkeypatch.setattr(ct, "HELD_KEYS", 2000)
    monkeypatch.setattr(textops, "CHUNK_BYTES", 1000)
    texts = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(120)]  # most keys are new in every chunk
    table = pa.table({"doc_id": list(range(120)), "text": texts, "held_out": [i % 5 == 0 for i in range(120)], "block": [3] * 120})
    counted, sizes = ct._counted, []
    monkeypatch.setattr(ct, "_counted", lambda keys, counts: sizes.append(sum(map(len, keys))) or counted(keys, counts))
    out = ct._vocabulary(5)(table).to_pylist()
    assert sum(r["n"] for r in out if r["kind"] == ct.WORD) == 60 * 96
    assert sum(r["n"] for r in out if r["kind"] == ct.GRAM) == sum(len(t) + 1 for i, t in enumerate(texts) if i % 5)
    assert sum(sizes) <= 8 * len(out)


def test_shuffles_of_ended_steps_are_let_go(spark, monkeypatch):
    done, put, drop = [], Stages.put, Stages.drop
    monkeypatch.setattr(Stages, "put", lambda self, name, df: (done.append(name), put(self, name, df))[1])
    monkeypatch.setattr(Stages, "drop", lambda self, *tables: done.append("let go") or drop(self, *tables))
    df = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, None)], "doc_id bigint, text string")
    assert ct.score_documents(Stages(spark), df, F.col("doc_id") == 2).count() == 3
    assert done == ["vocabulary", "let go", "grams", "let go", "let go", "scored"]
