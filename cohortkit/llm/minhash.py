"""MinHash near-duplicates over word shingles.

Every document gets the minima of many universal hashes (multiply-shift) over its shingles. The
signature is cut into bands; documents with an equal band are candidates. Candidates whose
signatures agree enough are confirmed on their full shingle sets, and the components of confirmed
links are found by alternating large-star and small-star.

With 40 bands of 5 minima a pair at the threshold 0.75 shares no band with probability
(1 - 0.75^5)^40 = 2e-5, and its signatures agree in fewer than 120 of 200 places with less than 1e-6.
Only the bands' hashes and the last byte of every minimum are kept.

Equal shingle sets are collapsed first, and no bucket is expanded into its pairs (see
``tables.linked_components``): members are compared with hubs, and where a bucket then still holds
several components, its documents are compared block by block on their full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from cohortkit.llm.memory import give_back
from cohortkit.llm.tables import Stages, by_place, connected_components, join_unique, linked_components, semi_join
from cohortkit.llm.textops import mix, shingles, text_chunks, weights

SHINGLE_WORDS = 5
PERCENT = 75
BANDS, ROWS = 40, 5
BLOCK_MEMBERS = 256
BROADCAST_SETS = 500_000  # rows of 24 bytes
AGREE = BANDS * ROWS * 3 // 5  # equal minima that a candidate needs to be confirmed on full sets


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, minima): least value of (a x + b) mod 2^64 for each of the hashes, upper 32 bits."""
    rng = np.random.Generator(np.random.PCG64(20240607))
    a = rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64) << np.uint64(1) | np.uint64(1)
    b = rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
    out = np.zeros((len(sets), BANDS * ROWS), np.uint32)
    at = 0
    while at < len(sets):  # some 16,000 shingles at a time stay in the processor's cache
        to, n = at, 0
        while to < len(sets) and (n == 0 or n + len(sets[to]) <= 1 << 14):
            n += len(sets[to])
            to += 1
        x = np.concatenate(sets[at:to])
        begins = np.concatenate([[0], np.cumsum([len(s) for s in sets[at:to]])[:-1]]).astype(np.int64)
        for i in range(BANDS * ROWS):
            out[at:to, i] = np.minimum.reduceat(x * a[i] + b[i], begins) >> np.uint64(32)
        at = to
    return out


def _band_hashes(minima: np.ndarray) -> np.ndarray:
    """(documents, bands): a hash of each band's number and minima."""
    rows = minima.reshape(len(minima), BANDS, ROWS).astype(np.uint64)
    return mix((rows * weights(ROWS)).sum(axis=2, dtype=np.uint64) ^ mix(np.arange(BANDS))).view(np.int64)


def _chunk_sets(column: pa.Array) -> Iterator[tuple[int, int, list[tuple[int, np.ndarray]]]]:
    """(first row, last row + 1, (row, sorted distinct shingle hashes) of every text that has a word) for chunks of texts."""
    for first, stop, texts in text_chunks(column):
        words = texts.word_hashes()
        own = [words[texts.first_word[k]:texts.first_word[k + 1]] for k in range(len(texts))]
        yield first, stop, [(first + k, shingles(w, SHINGLE_WORDS)) for k, w in enumerate(own) if len(w)]


SIGNATURES = "doc_id bigint, n_shingles bigint, set_id binary, bands array<bigint>, sketch binary"


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, stop, held in _chunk_sets(batch.column(1)):
            n = stop - first
            sizes, ids, bands, sketches = np.zeros(n, np.int64), [None] * n, [None] * n, [None] * n
            if held:
                minima = _minima([one for _, one in held])
                for (row, one), band, least in zip(held, _band_hashes(minima), minima.astype(np.uint8), strict=True):
                    sizes[row - first], bands[row - first], sketches[row - first] = len(one), band, least.tobytes()
                    ids[row - first] = hashlib.blake2b(one.tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, n), pa.array(sizes), pa.array(ids, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                 pa.array(sketches, pa.binary())], names=["doc_id", "n_shingles", "set_id", "bands", "sketch"])
        give_back()


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, held in _chunk_sets(batch.column(1)):
            out = [one.tobytes() for _, one in held]
            ids = [hashlib.blake2b(one, digest_size=16).digest() for one in out]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(out, pa.binary())], names=["set_id", "shingles"])
        give_back()


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs with 100 * intersection >= PERCENT * union of their full sets."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = 100 * both >= PERCENT * (len(x) + len(y) - both)
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["u", "v"]).filter(pa.array(keep))
        give_back()


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose sketches agree in enough places."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, BANDS * ROWS) for i in (2, 3))
        keep = (a == b).sum(axis=1) >= AGREE
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["u", "v"]).filter(pa.array(keep))


def _paired(pairs: DataFrame, rows: DataFrame, col: str, keep) -> DataFrame:
    """``pairs`` (u, v) with ``col`` of both ends, through the filter ``keep``."""
    with_u = pairs.join(rows.select(F.col("node").alias("u"), F.col(col).alias("_a")), "u")
    with_v = with_u.join(rows.select(F.col("node").alias("v"), F.col(col).alias("_b")), "v")
    return with_v.select("u", "v", "_a", "_b").mapInArrow(keep, "u bigint, v bigint")


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between members of different components of two blocks (lists of node, component, shingles)."""
    for batch in batches:
        u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for row in range(batch.num_rows):
            a, b = (batch.column(i)[row].values for i in (0, 1))
            sets = [[np.frombuffer(x.as_py(), np.uint64) for x in side.field("shingles")] for side in (a, b)]
            node, component = ([side.field(c).to_numpy() for side in (a, b)] for c in ("node", "component"))
            sizes = [np.array([len(x) for x in side]) for side in sets]
            flat = [np.concatenate(side) for side in sets]
            common = np.intersect1d(*(np.unique(x) for x in flat), assume_unique=True)
            held = []
            for x, size in zip(flat, sizes, strict=True):
                at = np.searchsorted(common, x)
                hit = np.flatnonzero(common[np.minimum(at, len(common) - 1)] == x) if len(common) else np.zeros(0, np.int64)
                held.append((np.repeat(np.arange(len(size)), size)[hit], at[hit]))
            both = np.zeros((len(sizes[0]), len(sizes[1])), np.float32)
            for start in range(0, len(common), 4096):  # shingles at once: counts stay exact in single precision
                sides = []
                for (who, at), size in zip(held, sizes, strict=True):
                    inside = (at >= start) & (at < start + 4096)
                    m = np.zeros((len(size), 4096), np.float32)
                    m[who[inside], at[inside] - start] = 1
                    sides.append(m)
                both += sides[0] @ sides[1].T
            total = sizes[0][:, None] + sizes[1][None, :] - both
            i, j = np.nonzero((100 * both >= PERCENT * total) & (component[0][:, None] != component[1][None, :]))
            u.append(np.maximum(node[0][i], node[1][j]))
            v.append(np.minimum(node[0][i], node[1][j]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])
        give_back()


def _group_links(stages: Stages, rest: DataFrame, tried: DataFrame, sets: DataFrame) -> DataFrame:
    """All links between different components among the members of open buckets.

    Members of a bucket were compared with the same hub, so the components of those comparisons hold
    whole buckets. Each is dealt to blocks of some BLOCK_MEMBERS members, and every two blocks are
    compared by one small matrix product on their full sets; only links leave it."""
    nodes = stages.put("open-nodes", rest.select("node", "component").distinct())
    compared = tried.join(nodes.select(F.col("node").alias("u")), "u", "left_semi").join(nodes.select(F.col("node").alias("v")), "v", "left_semi")
    groups = connected_components(stages, compared).withColumnRenamed("component", "grp")
    sized = stages.put("groups", nodes.join(groups, "node"))
    counts = sized.groupBy("grp").agg(F.count("*").alias("n"))
    dealt = join_unique(sized, counts, "grp", ["n"], "n", sized.count())
    blocks = F.ceil(F.col("n") / BLOCK_MEMBERS).cast("int")
    dealt = dealt.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    member = F.struct("node", "component", "shingles")
    block = dealt.join(sets, "node").groupBy("grp", "block", "blocks").agg(F.collect_list(member).alias("held"))
    block = stages.put("blocks", block)
    left = block.select("grp", F.col("held").alias("a"), F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("other"))
    right = block.select("grp", F.col("block").alias("other"), F.col("held").alias("b"))
    return left.join(right, ["grp", "other"]).select("a", "b").mapInArrow(_block_links, "u bigint, v bigint").distinct()


def near_duplicates(stages: Stages, documents: DataFrame) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Texts without words (null, empty, blank) have an empty set and are linked with nothing. Rows that
    share a doc_id are one vertex. Rows with a null doc_id are linked with nothing: component_id null,
    kept. Repeated rows, equal sets and ties get the smallest doc_id reachable. Whole texts of any
    length are used; extra columns are ignored; an empty table gives no rows."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sig = stages.put("signatures", docs.mapInArrow(_signatures, SIGNATURES))

    # one node per distinct set
    classes = sig.where("set_id IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_id").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = stages.put("classes", classes.withColumn("node", F.monotonically_increasing_id()))
    light = join_unique(sig.select("doc_id", "n_shingles", "set_id"), classes, "set_id", ["node"], "n", sig.count())
    light = stages.put("light", light.select("doc_id", "n_shingles", "node"))
    # the sets of a doc_id with several texts belong together
    shared = light.where("node IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "node").distinct()
    several = shared.groupBy("doc_id").agg(F.count("*").alias("k"), F.min("node").alias("v")).where("k > 1")
    shared = stages.put("shared", shared.join(several, "doc_id").select(F.col("node").alias("u"), "v").where("u <> v"))

    # bands that at least two classes share
    members = classes.select("node", F.explode("bands").alias("bucket"))
    wide = stages.put("wide", members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"))
    members = stages.put("members", semi_join(members, wide, "bucket"))
    nodes = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "set_id", "least", "sketch")
    nodes = stages.put("nodes", nodes)
    # a text that shares its doc_id with the one wanted is told apart by its set
    texts = semi_join(docs, nodes.select(F.col("least").alias("doc_id")).distinct(), "doc_id")
    names = nodes.select("set_id", "node")
    names = F.broadcast(names) if names.count() <= BROADCAST_SETS else names
    sets = texts.mapInArrow(_full_sets, "set_id binary, shingles binary").join(names, "set_id").select("node", "shingles")
    sets = stages.put("sets", sets.dropDuplicates(["node"]))

    def confirmed(pairs: DataFrame) -> DataFrame:
        likely = stages.put("likely", _paired(pairs, nodes, "sketch", _agree))
        return _paired(likely, sets, "shingles", _confirm)

    components = linked_components(stages, members, confirmed, lambda rest, tried: _group_links(stages, rest, tried, sets), shared)

    named = classes.join(components, "node", "left").select("node", "least", "n", F.coalesce("component", "node").alias("component"))
    named = stages.put("named", named)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("k"))
    named = join_unique(named, least, "component", ["component_id"], "k", named.count()).select("node", "n", "component_id")
    out = join_unique(light, stages.put("component-ids", named), "node", ["component_id"], "n", light.count())
    # a text without words may share its doc_id with one that has some
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one_of_each(stages: Stages, documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose doc_id :func:`near_duplicates` keeps, all columns. Of repeated rows of a doc_id
    and text one stays, that of the least hash of its columns; different texts of a doc_id all stay. Texts without
    words (null, empty, blank) are linked with nothing and stay, as do rows without doc_id. An empty table gives no
    rows; the names of other columns may be any."""
    found = near_duplicates(stages, documents)
    rows, own = by_place(documents)
    doc = F.col(own["doc_id"]).cast("long")
    kept = found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"))
    kept = stages.put("kept", kept)
    once = rows.join(kept.where("n = 1"), doc == F.col("doc_id"), "left_semi")
    repeated = rows.join(kept.where("n > 1"), doc == F.col("doc_id"), "left_semi")
    plain = [f.name for f in repeated.schema.fields if not isinstance(f.dataType, MapType)]
    one = F.min_by(F.struct(*rows.columns), F.struct(F.xxhash64(*plain), F.xxhash64(F.lit(1), *plain)))
    repeated = repeated.groupBy(doc.alias("_doc"), F.col(own["text"]).alias("_text")).agg(one.alias("_one")).select("_one.*")
    return once.unionByName(repeated).unionByName(rows.where(doc.isNull())).toDF(*documents.columns)


def op5_minhash_near_duplicates(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(Stages(spark), docs)
