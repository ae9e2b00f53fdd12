import math
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortkit.llm import lexical_search as ls
from cohortkit.llm.tables import Stages

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, length = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in asked.items():
        found = []
        for (doc, c), n in zip(counted, sizes, strict=True):
            score = 0
            for t in own & set(c):
                m = 100 - 50 + 50 * n * n_docs // length
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def tables():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(60)] + ["Été", "中文", "don't", "x_y", "A1"]
    text = lambda n: rng.choice([" ", "-", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    docs = [(k, text(rng.randrange(1, 60))) for k in range(300)]
    docs += [(500 + k, "copy of one Text w1 w2 w3") for k in range(40)]  # ties
    docs += [(1, "again w5"), docs[3], docs[3], (None, "w1 w2 no id"), (None, None), (800, None), (801, ""), (802, " -- "), (803, "w7 " * 60_000)]
    shared = text(12)
    items = [(k, shared + " " + text(6)) for k in range(10)] + [(k, text(rng.randrange(1, 25))) for k in range(10, 30)]
    items += [(40, None), (41, ""), (42, "nothingholdsthis"), (3, "w8 w9 w10"), (None, "w1 w4"), (43, "w1 W1 w1")]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame([(*r, 0) for r in docs], "doc_id bigint, text string, n bigint").withColumn("item_id", F.lit("x"))
    i = spark.createDataFrame([(*r, 0) for r in items], "item_id bigint, text string, score int").withColumn("doc_id", F.lit("x"))
    return d, i


def test_equals_brute_force(spark):
    docs, items = tables()
    got = ls.search(Stages(spark), *frames(spark, docs, items), k=20)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(docs, items, 20)


def test_blocks_of_items_and_small_batches(spark, monkeypatch):
    docs, items = tables()
    monkeypatch.setattr(ls, "BLOCK_TERMS", 150)
    got = ls.search(Stages(spark), *frames(spark, docs, items), k=5)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(docs, items, 5)


def test_empty_tables(spark):
    d, i = frames(spark, *tables())
    assert ls.search(Stages(spark), d.limit(0), i).count() == 0
    assert ls.search(Stages(spark), d, i.limit(0)).count() == 0
    assert ls.search(Stages(spark), d.where("doc_id > 800 AND doc_id < 803"), i).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1), min_size=1, max_size=12))
def test_sharing_graph_adds_up_every_item(items):
    own = [sorted(s) for s in items]
    g = ls.mine_sharing(own, 26)
    value = np.random.default_rng(1).integers(0, 1 << 40, 26)
    part = np.zeros(g.nodes, np.int64)
    for t in {t for s in own for t in s}:
        part[g.leaf[t]] += value[t]
    for node, left, right in g.levels:
        part[node] = part[left] + part[right]
    assert part[g.item].tolist() == [int(value[s].sum()) for s in own]


def test_shared_sets_are_added_up_once():
    rng = random.Random(9)
    common = list(range(30))
    items = [sorted({*rng.sample(common, 20), 100 + k, 200 + k}) for k in range(50)]
    g = ls.mine_sharing(items, 300)
    leaves = sum(len(v) for v in {tuple(s) for s in items}) and len({t for s in items for t in s}) - g.classes
    adds = leaves + sum(len(n) for n, _, _ in g.levels)
    assert adds < 0.7 * g.adds_alone
