"""Joins with hot and null keys, components and bucket linking against plain Python."""

import random

from cohortkit.llm.tables import Stages, connected_components, join_unique, linked_components


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_join_unique_keeps_every_row(spark):
    keys = [7] * 3000 + list(range(100, 1600)) + [None] * 500
    left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i bigint, k bigint")
    right = spark.createDataFrame([(k, k * 2, keys.count(k)) for k in [7, *range(100, 1000), 5000]], "k bigint, v bigint, n bigint")
    got = {r.i: r.v for r in join_unique(left, right, "k", ["v"], "n", len(keys)).collect()}
    assert got == {i: (k * 2 if k == 7 or (k is not None and 100 <= k < 1000) else None) for i, k in enumerate(keys)}


def test_components_of_random_graph(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    want = roots({x for e in links for x in e if e[0] != e[1]}, links)
    got = connected_components(Stages(spark), spark.createDataFrame(links, "u bigint, v bigint"))
    assert {r.node: r.component for r in got.collect()} == want
    none = connected_components(Stages(spark), spark.createDataFrame([], "u bigint, v bigint"))
    assert none.count() == 0


def test_large_bucket_is_linked_without_all_pairs(spark):
    """400 members of ten common buckets, of whose pairs two in five are links."""
    members = spark.createDataFrame([(b, i) for i in range(400) for b in range(10)] + [(20, 1000), (20, 2000)], "bucket bigint, node bigint")
    seen = []

    def confirm(pairs):
        seen.append(pairs.count())
        return pairs.where("pmod(xxhash64(u, v), 5) < 2")

    stages = Stages(spark)
    got = linked_components(stages, stages.put("m", members), confirm)
    found = {r.node: r.component for r in got.collect()}
    assert {n: found.get(n, n) for n in range(400)} == dict.fromkeys(range(400), 0)
    assert 1000 not in found and 2000 not in found
    assert sum(seen) < 12 * 400


def test_bucket_without_links_is_compared_whole(spark):
    members = spark.createDataFrame([(1, i) for i in range(60)], "bucket bigint, node bigint")
    pairs_seen = []

    def confirm(pairs):
        pairs_seen.extend((r.u, r.v) for r in pairs.collect())
        return pairs.where("u = 41 AND v = 13")

    stages = Stages(spark)
    got = linked_components(stages, stages.put("m", members), confirm)
    assert {r.node: r.component for r in got.collect()} == {41: 13, 13: 13}
    assert len(set(pairs_seen)) == len(pairs_seen) == 60 * 59 // 2
