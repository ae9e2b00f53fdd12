import random
import re

import pytest
from pyspark.sql import functions as F

from cohortkit.llm import ngram_join as nj
from cohortkit.llm.tables import Stages

SCHEMA = "doc_id bigint, text string, n bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, words):
    own = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return frozenset(tuple(own[i:i + words]) for i in range(max(1, len(own) - words + 1))) if own else frozenset()


def brute_force(rows, words=4, percent=85):
    sets = [(i, shingle_set(t, words)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = sorted({(i, s) for i, s in sets if i is not None and s}, key=lambda x: x[0])
    for k, (i, s) in enumerate(flat):
        for j, r in flat[:k]:
            if 100 * min(len(s), len(r)) >= percent * max(len(s), len(r)):
                both = len(s & r)
                if 100 * both >= percent * (len(s) + len(r) - both):
                    a, b = find(i), find(j)
                    parent[max(a, b)] = min(a, b)
    return sorted(((i, len(s), find(i) if i is not None else None) for i, s in sets), key=str)


def rows(seed=11):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    text = lambda n: [word() for _ in range(n)]
    out = []
    base = text(150)
    for k in range(150):  # near copies that are links of some of the others only
        own = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
            own[rng.randrange(150)] = word()
        out.append((1000 + k, " ".join(own)))
    small = text(20)
    for k in range(120):  # light sets, by words at either end
        a = rng.randrange(5)
        out.append((2000 + k, " ".join(small[a:rng.randrange(a + 3, 21)])))
    for n in range(4, 45):  # around the boundary: a heavy and a light set of one pair
        own = text(n)
        out += [(6000 + 3 * n, " ".join(own)), (6001 + 3 * n, " ".join([*own, word()])), (6002 + 3 * n, " ".join(own[1:]))]
    passage = text(60)
    out += [(3000 + k, " ".join(text(15) + passage + text(15))) for k in range(60)]  # a passage that many share
    out += [(4000 + k, "Exact  COPY of\nthis\ttext here, " + "again " * 5) for k in range(40)]
    chain = text(300)
    out += [(5000 + k, " ".join(chain[6 * k:6 * k + 100])) for k in range(20)]
    out += [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE Two"), (6, "one two three"), (7, "w " * 50000), (8, "w " * 40000),
            (None, "one two"), (None, None), (9, " ".join(text(30))), (10, "İstanbul ÀB c d e"), (11, "i̇stanbul àb c d e")]
    out += [out[0], out[0], (1000, " ".join(text(40))), (9, "one two")]  # repeated rows, one id with other texts
    for k in range(30):  # two texts an id, a near copy of each
        for j in range(2):
            own = text(100)
            out += [(7000 + k, " ".join(own)), (7100 + 2 * k + j, " ".join([*own[:-1], word()]))]
    return out


def frame(spark, data):
    return spark.createDataFrame([(*r, 0) for r in data], SCHEMA).withColumn("node", F.lit("x")).withColumn("bucket", F.lit(1))


@pytest.mark.parametrize("short, block", [(32, 256), (2, 16)])
def test_equals_brute_force(spark, monkeypatch, short, block):
    monkeypatch.setattr(nj, "SHORT_LIST", short)
    monkeypatch.setattr(nj, "BLOCK_SETS", block)
    data = rows()
    got = nj.similar_documents(Stages(spark), frame(spark, data))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(data)


def test_other_words_and_percent(spark):
    data = rows(5)[100:500]
    got = nj.similar_documents(Stages(spark), frame(spark, data), words=2, percent=60)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(data, 2, 60)


def test_all_light_and_all_heavy(spark, monkeypatch):
    data = [r for r in rows(7) if len(shingle_set(r[1], 4)) <= nj.MAX_LIGHT]
    for boundary in (1, nj.MAX_LIGHT + 1):
        monkeypatch.setattr(nj, "choose_boundary", lambda sizes, percent, b=boundary: b)
        got = nj.similar_documents(Stages(spark), frame(spark, data))
        assert sorted(map(tuple, got.collect()), key=str) == brute_force(data)


def test_empty_table(spark):
    assert nj.similar_documents(Stages(spark), spark.createDataFrame([], SCHEMA)).count() == 0


def test_subsets_and_prefixes_hold_every_link():
    for a in range(1, 40):
        for b in range(a, 40):
            links = [o for o in range(a + 1) if 100 * o >= 85 * (a + b - o)]
            assert (b in nj.partners(a)) == bool(links) == (a in nj.partners(b))
            if links:
                assert links[0] == nj.need(a, b) and links[0] in nj.subset_sizes(a) and links[0] in nj.subset_sizes(b)
                assert a - nj.prefix(a) < links[0] and b - nj.prefix(b) < links[0]


def test_boundary_follows_the_cost():
    assert nj.choose_boundary({6: 1000}) > 6  # one subset a set against seven rows
    assert nj.choose_boundary({22: 1000}) <= 22  # thousands of subsets a set
    assert nj.choose_boundary({}) == 1
