"""Exact Jaccard join on word n-grams, heavy and light by size.

Sets of fewer than ``boundary`` elements are light. Two sets of a and b elements link when they share at least
``need(a, b)`` of them, so a light set enumerates its subsets of exactly those sizes (``subset_sizes``): two
linked light sets have such a subset in common, and all sets that hold a subset and are small enough link with the
smallest of them, so a subset gives a star of links and no pairs. Larger sets are heavy: they scan the inverted
lists of their elements, and of the light sets that are large enough to link with one. The boundary is where the
enumeration's cost, counted over the sizes that occur, passes that of the lists.

Lists. In any fixed order of all elements, linked sets share one of their first ``prefix(size)`` elements. The order
here: the elements in the lowest RARE_SHARE of the hashes come first, the rarest of them first; the others follow by
hash. So counts are needed of that share only, an element that only one set holds needs no list, and a passage that
many texts share comes last. A list's sets are compared with one of them (``_hub_pairs``), twice; what then still is
in different components is compared pair by pair in short lists, and in long ones block against block, where a block
is of sets of like size. A sketch of parities bounds the number of elements that only one of two sets has from below,
which spares most comparisons; links are confirmed on full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.tables import Stages, connected_components, join_unique, semi_join
from cohortkit.llm.textops import mix, shingles, text_chunks

SHINGLE_WORDS = 4
PERCENT = 85
MAX_LIGHT = 24  # no larger set is ever light
RARE_SHARE = 0.25
RARE_LIMIT = np.uint64(int(RARE_SHARE * 2**64))
SKETCH_BITS = 1024
SHORT_LIST = 32  # lists of at most so many sets are compared pair by pair in the end
BLOCK_SETS = 256
SUBSETS_AT_ONCE = 200_000
BROADCAST_SETS = 500_000  # rows of 24 bytes


def need(a: int, b: int, percent: int = PERCENT) -> int:
    """Elements that sets of a and b elements must share to link."""
    return -(-percent * (a + b) // (100 + percent))


def partners(size: int, percent: int = PERCENT) -> range:
    """Sizes that can link with ``size``."""
    return range(-(-percent * size // 100), 100 * size // percent + 1)


def prefix(size: int, percent: int = PERCENT) -> int:
    """So many first elements of a set, in any order, hold one of every set that links with it."""
    return size - (-(-percent * size // 100)) + 1


def subset_sizes(size: int, percent: int = PERCENT) -> list[int]:
    return sorted({need(size, other, percent) for other in partners(size, percent)})


def choose_boundary(sizes: dict[int, int], percent: int = PERCENT) -> int:
    """The smallest size of a heavy set, for ``sizes`` (size -> sets): where enumerating subsets below it
    and listing elements from the least partner of it on costs least, in rows."""
    def cost(boundary: int) -> int:
        light = sum(n * sum(math.comb(s, c) for c in subset_sizes(s, percent)) for s, n in sizes.items() if s < boundary)
        lists = sum(n * (s + prefix(s, percent)) for s, n in sizes.items() if s >= partners(boundary, percent)[0])
        return light + lists
    return min(range(1, MAX_LIGHT + 2), key=lambda b: (cost(b), b))


def _doc_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text that has a word."""
    for first, _, texts in text_chunks(column):
        hashes = texts.word_hashes()
        for k in np.flatnonzero(np.diff(texts.first_word)):
            yield first + int(k), shingles(hashes[texts.first_word[k]:texts.first_word[k + 1]], words)


def _set_id(one: np.ndarray) -> bytes:
    return hashlib.blake2b(one.tobytes(), digest_size=16).digest()


def _sketch(one: np.ndarray) -> bytes:
    """Parities of the elements that fall on each bit."""
    place = mix(one) % np.uint64(SKETCH_BITS)
    return np.packbits(np.bincount(place.astype(np.int64), minlength=SKETCH_BITS) & 1).tobytes()


SETS = "uid bigint, doc_id bigint, size bigint, set_id binary, sketch binary, rare int, elements binary"


def _sets(words: int, percent: int):
    """Each text's set: its size, name, sketch, number of elements that are ordered by count, and the elements that
    can be in its prefix (of a set that may be light, all)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            size, rare = np.zeros(n, np.int64), np.zeros(n, np.int32)
            ids, sketches, held = [None] * n, [None] * n, [None] * n
            for row, one in _doc_sets(batch.column(2), words):
                size[row], rare[row] = len(one), np.searchsorted(one, RARE_LIMIT)
                ids[row], sketches[row] = _set_id(one), _sketch(one)
                held[row] = (one if len(one) <= MAX_LIGHT else one[:max(int(rare[row]), prefix(len(one), percent))]).tobytes()
            binary = [pa.array(c, pa.binary()) for c in (ids, sketches, held)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size), binary[0], binary[1], pa.array(rare), binary[2]],
                                             names=[c.split()[0] for c in SETS.split(", ")])
    return run


def _subset_rows(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    keys, numbers = (np.ascontiguousarray(np.concatenate(x)) for x in zip(*held, strict=True))
    bucket = pa.Array.from_buffers(pa.binary(16), len(keys), [None, pa.py_buffer(keys)]).cast(pa.binary())
    return pa.RecordBatch.from_arrays([bucket, *(pa.array(numbers[:, i]) for i in range(3))], names=["bucket", "node", "size", "held"])


def _subsets(percent: int):
    """A row for each subset (bucket: two sums of hashes and the subset's size) that a light set enumerates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, made = [], 0
            for node, size, elements in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one = np.frombuffer(elements, np.uint64)
                ways = [mix(one), mix(one ^ np.uint64(0x5851F42D4C957F2D))]
                for c in subset_sizes(size, percent):
                    out = size - c
                    left_out = np.array(list(combinations(range(size), out)), np.int64).reshape(math.comb(size, out), out)
                    keys = [mix(w.sum() - w[left_out].sum(axis=1, dtype=np.uint64) + np.uint64(c)) for w in ways]
                    held.append((np.stack(keys, axis=1), np.full((len(left_out), 3), (node, size, c))))
                    made += len(left_out)
                    if made > SUBSETS_AT_ONCE:
                        yield _subset_rows(held)
                        held, made = [], 0
            if held:
                yield _subset_rows(held)
    return run


def _light_links(stages: Stages, light: DataFrame, percent: int) -> DataFrame:
    """Links among light sets (node, size, elements): of each subset's sets with the smallest of them."""
    rows = stages.put("subsets", light.select("node", "size", "elements").mapInArrow(_subsets(percent), "bucket binary, node bigint, size bigint, held bigint"))
    stars = rows.groupBy("bucket").agg(F.min(F.struct("size", "node")).alias("star"), F.count("*").alias("n")).where("n > 1")
    stars = stages.put("stars", stars)
    if stars.isEmpty():
        return stages.spark.createDataFrame([], "u bigint, v bigint")
    met = join_unique(rows, stars, "bucket", ["star"], "n", rows.count())
    met = met.where(F.col("star").isNotNull() & (F.col("star.node") != F.col("node")))
    met = met.where(percent * (F.col("size") + F.col("star.size")) <= (100 + percent) * F.col("held"))
    return met.select(F.greatest("node", "star.node").alias("u"), F.least("node", "star.node").alias("v")).distinct()


def _postings(percent: int):
    """(element, node, spare) of the elements that can be in a set's prefix; ``spare`` is by how many elements
    those that are ordered by count exceed the prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, rare = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            most = np.array([prefix(int(s), percent) for s in size], np.int64)
            sets = [np.frombuffer(e, np.uint64)[:max(int(r), int(p))] for e, r, p in zip(batch.column(3).to_pylist(), rare, most, strict=True)]
            n = [len(s) for s in sets]
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64)), pa.array(np.repeat(node, n)), pa.array(np.repeat(rare - most, n).astype(np.int32))],
                                             names=["element", "node", "spare"])
    return run


def _lists(stages: Stages, nodes: DataFrame, percent: int) -> DataFrame:
    """Inverted lists (bucket, node) of the elements in the sets' prefixes that two sets or more hold."""
    postings = nodes.select("node", "size", "rare", "elements").mapInArrow(_postings(percent), "element bigint, node bigint, spare int")
    shared = stages.put("shared", postings.groupBy("element").agg(F.count("*").alias("n")).where("n > 1"))
    total = shared.agg(F.sum("n")).first()[0]
    if not total:
        return stages.spark.createDataFrame([], "bucket bigint, node bigint")
    held = join_unique(postings, shared, "element", ["n"], "n", total).where("n IS NOT NULL")
    # elements that one set alone holds come first, so the last of the others are those beyond the prefix
    rare = F.shiftrightunsigned("element", 1) < int(RARE_LIMIT >> np.uint64(1))
    last = F.struct((~rare).alias("late"), F.when(rare, F.col("n")).otherwise(0).alias("n"), F.shiftrightunsigned("element", 1).alias("h"), "element")
    lists = held.groupBy("node").agg(F.max("spare").alias("spare"), F.sort_array(F.collect_list(last)).alias("held"))  # at most a set's own elements
    lists = lists.where("size(held) > greatest(spare, 0)")
    lists = lists.select("node", F.explode(F.slice("held", F.lit(1), F.size("held") - F.greatest("spare", F.lit(0)))).alias("e"))
    lists = stages.put("lists", lists.select(F.col("e.element").alias("bucket"), "node"))
    wide = stages.put("wide", lists.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    return stages.put("members", semi_join(lists, wide.select("bucket"), "bucket"))


def _pair(a: str, b: str) -> list:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def _fits(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _hub_pairs(open_members: DataFrame, turn: int, percent: int, total: int) -> DataFrame:
    """Each set with its list's hub: the set of least rank, which mostly is the same in the lists of like sets."""
    rank = F.struct(F.xxhash64("node", F.lit(turn)).alias("r"), "node", "size", "component")
    hubs = open_members.groupBy("bucket").agg(F.min(rank).alias("hub"), F.count("*").alias("n"))
    met = join_unique(open_members, hubs, "bucket", ["hub"], "n", total)
    met = met.where((F.col("component") != F.col("hub.component")) & _fits("size", "hub.size", percent))
    return met.select(*_pair("node", "hub.node")).distinct()


def _few_differ(percent: int):
    """Keep the pairs whose sketches allow a link: bits that differ are elements that one set alone has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (2, 3))
            both = batch.column(4).to_numpy(zero_copy_only=False) + batch.column(5).to_numpy(zero_copy_only=False)
            keep = np.bitwise_count(a ^ b).sum(axis=1) <= both - 2 * -(-percent * both // (100 + percent))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["u", "v"]).filter(pa.array(keep))
    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in (2, 3))
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(a, b, strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["u", "v"]).filter(pa.array(keep))
    return run


def _scan(percent: int):
    """Links between sets of different components of two blocks: each set of one scans the inverted lists
    of the other's elements and counts how often it meets every set there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for row in range(batch.num_rows):
                a, b = (batch.column(i)[row].values for i in (0, 1))
                node, component = ([side.field(c).to_numpy() for side in (a, b)] for c in ("node", "component"))
                sets = [[np.frombuffer(x, np.uint64) for x in side.field("shingles").to_pylist()] for side in (a, b)]
                size = np.array([len(x) for x in sets[0]])
                owner = np.repeat(np.arange(len(size)), size)
                flat = np.concatenate(sets[0])
                order = np.argsort(flat, kind="stable")
                owner = owner[order]
                lists, begin = np.unique(flat[order], return_index=True)
                length = np.diff(np.append(begin, len(flat)))
                for j, one in enumerate(sets[1]):
                    at = np.minimum(np.searchsorted(lists, one), len(lists) - 1)
                    at = at[lists[at] == one]
                    place = np.arange(length[at].sum()) - np.repeat(np.cumsum(length[at]) - length[at], length[at]) + np.repeat(begin[at], length[at])
                    both = np.bincount(owner[place], minlength=len(size))
                    i = np.flatnonzero((100 * both >= percent * (size + len(one) - both)) & (component[0] != component[1][j]))
                    u.append(np.maximum(node[0][i], node[1][j]))
                    v.append(np.minimum(node[0][i], node[1][j]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])
    return run


class _Sets:
    """Sketches and full sets of nodes; a full set is made from its text when it is asked for."""

    def __init__(self, stages: Stages, docs: DataFrame, nodes: DataFrame, words: int, percent: int):
        self.stages, self.docs, self.nodes, self.words, self.percent = stages, docs, nodes, words, percent

    def full(self, wanted: DataFrame) -> DataFrame:
        """(node, shingles) of the nodes of the written table ``wanted``."""
        words = self.words

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = [one for _, one in _doc_sets(batch.column(0), words)]
                yield pa.RecordBatch.from_arrays([pa.array([_set_id(s) for s in made], pa.binary()), pa.array([s.tobytes() for s in made], pa.binary())],
                                                 names=["set_id", "shingles"])
        own = self.stages.put("own", semi_join(self.nodes.select("node", "doc_id", "set_id"), wanted, "node"))
        texts = semi_join(self.docs, own.select("doc_id").distinct(), "doc_id").select("text")
        sets = texts.mapInArrow(run, "set_id binary, shingles binary")
        if own.count() <= BROADCAST_SETS:
            sets = sets.join(F.broadcast(own.select("node", "set_id")), "set_id")
        else:
            sets = sets.join(own.select("node", "set_id"), "set_id")
        return self.stages.put("sets", sets.select("node", "shingles").dropDuplicates(["node"]))

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) that are links."""
        pairs = self.stages.put("pairs", pairs)
        near = self._both(pairs, self.nodes.select("node", "sketch", "size"), ["sketch", "size"]).mapInArrow(_few_differ(self.percent), "u bigint, v bigint")
        near = self.stages.put("near", near)
        wanted = self.stages.put("wanted", near.select(F.explode(F.array("u", "v")).alias("node")).distinct())
        return self._both(near, self.full(wanted), ["shingles"]).mapInArrow(_confirm(self.percent), "u bigint, v bigint")

    @staticmethod
    def _both(pairs: DataFrame, rows: DataFrame, cols: list[str]) -> DataFrame:
        u = rows.select(F.col("node").alias("u"), *[F.col(c).alias(f"u_{c}") for c in cols])
        v = rows.select(F.col("node").alias("v"), *[F.col(c).alias(f"v_{c}") for c in cols])
        return pairs.join(u, "u").join(v, "v").select("u", "v", *[f"{s}_{c}" for c in cols for s in "uv"])


def _open(stages: Stages, members: DataFrame, components: DataFrame, at_least: int) -> DataFrame:
    """Members with their present component, of lists of at least so many sets that hold several components."""
    named = members.select("bucket", "node", "size").join(components, "node", "left")
    named = stages.put("named", named.select("bucket", "node", "size", F.coalesce("component", "node").alias("component")))
    mixed = named.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("a"), F.max("component").alias("b"))
    mixed = stages.put("mixed", mixed.where((F.col("a") != F.col("b")) & (F.col("n") >= at_least)).select("bucket", F.col("n").alias("held")))
    light = join_unique(named, mixed, "bucket", ["held"], "held", named.count())
    return stages.put("open", light.where("held IS NOT NULL"))


def _short_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components of lists of at most SHORT_LIST sets."""
    short = members.where(F.col("held") <= SHORT_LIST)
    x = short.select("bucket", F.col("node").alias("a"), F.col("size").alias("s"), F.col("component").alias("c"))
    y = short.select("bucket", F.col("node").alias("b"), F.col("size").alias("t"), F.col("component").alias("d"))
    return x.join(y, "bucket").where((F.col("c") < F.col("d")) & _fits("s", "t", percent)).select(*_pair("a", "b")).distinct()


def _long_links(stages: Stages, members: DataFrame, sets: _Sets, percent: int) -> DataFrame:
    """Links between different components of longer lists, block by block.

    Lists that share sets are one group. A group's sets are dealt by size to classes, of which only neighbours
    can hold links, and a class to blocks of some BLOCK_SETS sets."""
    long = stages.put("long", members.where(F.col("held") > SHORT_LIST).select("bucket", "node", "size", "component"))
    if long.isEmpty():
        return stages.spark.createDataFrame([], "u bigint, v bigint")
    nodes = stages.put("long-nodes", long.select("node", "size", "component").distinct())
    first = long.groupBy("bucket").agg(F.min("node").alias("v"), F.count("*").alias("n"))
    ties = join_unique(long.select("bucket", "node"), first, "bucket", ["v"], "n", long.count()).select(F.col("node").alias("u"), "v").where("u <> v").distinct()
    groups = connected_components(stages, ties).withColumnRenamed("component", "grp")
    kind = F.floor(F.log(F.col("size").cast("double")) / math.log(100 / percent)).cast("int")
    sized = stages.put("sized", nodes.join(groups, "node").withColumn("kind", kind))
    counts = sized.groupBy("grp", "kind").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("blocks"))
    counts = counts.join(counts.select("grp", (F.col("kind") - 1).alias("kind"), F.col("blocks").alias("above")), ["grp", "kind"], "left")
    counts = stages.put("counts", counts)
    dealt = sized.join(counts, ["grp", "kind"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    full = sets.full(stages.put("wanted", nodes.select("node")))
    held = F.collect_list(F.struct("node", "component", "shingles")).alias("held")
    block = stages.put("blocks", dealt.join(full, "node").groupBy("grp", "kind", "block", "blocks", "above").agg(held))
    own = F.transform(F.sequence("block", F.col("blocks") - 1), lambda i: F.struct(F.col("kind").alias("kind"), i.alias("block")))
    above = F.when(F.col("above") > 0, F.transform(F.sequence(F.lit(0), F.col("above") - 1), lambda i: F.struct((F.col("kind") + 1).alias("kind"), i.alias("block"))))
    left = block.select("grp", F.col("held").alias("a"), F.explode(F.concat(own, F.coalesce(above, F.slice(own, 1, 0)))).alias("to"))
    left = left.select("grp", F.col("to.kind").alias("kind"), F.col("to.block").alias("block"), "a")
    return left.join(block.select("grp", "kind", "block", F.col("held").alias("b")), ["grp", "kind", "block"]).select("a", "b").mapInArrow(
        _scan(percent), "u bigint, v bigint").distinct()


def _list_links(stages: Stages, lists: DataFrame, sets: _Sets, percent: int) -> DataFrame:
    """Links that connect all sets of a common list that links connect."""
    none = stages.spark.createDataFrame([], "u bigint, v bigint")
    members = stages.put("sized-members", lists.join(sets.nodes.select("node", "size"), "node"))
    links, components = none, none.toDF("node", "component")
    for turn in range(2):
        at = _open(stages, members, components, 2 if turn == 0 else 3)  # two sets are compared once
        total = at.count()
        if not total:
            return links
        links = stages.put("links", links.unionByName(sets.confirm(_hub_pairs(at, turn, percent, total))))
        components = connected_components(stages, links)
    at = _open(stages, members, components, 3)
    if at.isEmpty():
        return links
    short = stages.put("short-links", sets.confirm(_short_pairs(at, percent)))
    return links.unionByName(short).unionByName(_long_links(stages, at, sets, percent))


def similar_documents(stages: Stages, documents: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): doc_id, n_shingles (size of its set) and component_id,
    the smallest doc_id that links reach; sets link when 100 * intersection >= ``percent`` * union.

    Texts without words (null, empty, blank) have an empty set and link with nothing. Rows that share a doc_id
    are one vertex with the links of all their texts. Rows with a null doc_id link with nothing: component_id
    null. Repeated rows and equal sets are linked. Whole texts of any length are used; extra columns are
    ignored; an empty table gives no rows."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text").mapInArrow(_sets(words, percent), SETS)
    made = stages.put("sets", made)
    rows = made.select("uid", "doc_id", F.col("size").alias("n_shingles"), "set_id")
    # a node per distinct set, named by its first row
    classes = rows.where("set_id IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_id").agg(
        F.min("uid").alias("node"), F.min("doc_id").alias("least"), F.count("*").alias("n"))
    classes = stages.put("classes", classes)
    nodes = semi_join(made.withColumnRenamed("uid", "node"), classes.select("node"), "node")

    small = nodes.where(F.col("size") <= 2 * MAX_LIGHT).groupBy("size").agg(F.count("*").alias("n"))
    boundary = choose_boundary({r.size: r.n for r in small.collect()}, percent)  # at most 2 * MAX_LIGHT rows
    links = _light_links(stages, nodes.where(F.col("size") < boundary), percent)
    heavy = nodes.where(F.col("size") >= partners(boundary, percent)[0])
    sets = _Sets(stages, docs, nodes, words, percent)
    links = links.unionByName(_list_links(stages, _lists(stages, heavy, percent), sets, percent))

    # the texts of one doc_id belong together
    own = join_unique(rows, classes, "set_id", ["node"], "n", rows.count())
    own = stages.put("own-nodes", own.where("node IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "node").distinct())
    several = own.groupBy("doc_id").agg(F.min("node").alias("v"), F.count("*").alias("k")).where("k > 1")
    several = own.join(several, "doc_id").select(F.col("node").alias("u"), "v").where("u <> v")
    components = connected_components(stages, stages.put("all-links", links.unionByName(several)))

    named = classes.join(components, "node", "left").select("set_id", "least", "n", F.coalesce("component", "node").alias("component"))
    named = stages.put("named-sets", named)
    # components of several sets are few against all; the others are named by their own smallest doc_id
    joined = named.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("k"))
    named = join_unique(named, joined, "component", ["component_id"], "k", named.count()).select("set_id", "n", "component_id")
    named = stages.put("components", named)
    out = join_unique(rows, named, "set_id", ["component_id"], "n", rows.count())
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))


def op12_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similar_documents(Stages(spark), spark.read.parquet(f"{sf_dir}/documents.parquet"))
