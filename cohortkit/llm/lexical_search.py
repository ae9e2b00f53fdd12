"""Ranked lexical search of many items at once, with the work that items share done once.

A document's score for an item is a sum over the item's terms, so terms and sets of terms that several
items hold need one partial score each. The sharing is mined from the items (``mine_sharing``): terms
held by the same items form a class; every item is the sequence of its classes, most shared first; and
neighbours that stand together in several items become one node, again and again, until every item is
a node. The nodes form a directed acyclic graph whose leaves are classes. For a block of documents the
classes' partial scores are accumulated once, and the graph is added up level by level.

Scale: documents are tokenised once, and only their hits (term numbers and counts) are written. A task
scores its own documents and hands on no more than the ``k`` best of each item, so what is shuffled
hangs on items and tasks, not on documents. Items are searched in blocks of some BLOCK_TERMS terms, which
bounds the terms and graph every task is given, and what the driver holds; each block reads all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit.llm.tables import Stages
from cohortkit.llm.textops import text_chunks

K = 50
BLOCK_TERMS = 1_000_000  # (item, term) pairs searched at once, about
BLOCK_CELLS = 1 << 22  # partial scores a task holds at once
# Bytes that separate terms (every other byte, and all of other characters, is part of one).
GAP = np.zeros(256, bool)
for _first, _last in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    GAP[_first:_last + 1] = True


@dataclass
class Sharing:
    """``leaf``: class of each term (by its number). ``levels``: (nodes, left, right) to be added up in
    turn, classes being the first nodes. ``item``: the node of each item. ``nodes``: their number."""

    leaf: np.ndarray
    classes: int
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    item: np.ndarray
    nodes: int
    adds_alone: int  # additions of partial scores if nothing were shared


def mine_sharing(items: list[list[int]], terms: int) -> Sharing:
    """The sharing graph of ``items``, each a list of distinct term numbers (below ``terms``), none empty."""
    holders: dict[int, list[int]] = {}
    for i, own in enumerate(items):
        for t in own:
            holders.setdefault(t, []).append(i)
    classes: dict[tuple[int, ...], int] = {}
    leaf = np.zeros(terms, np.int64)
    for t in sorted(holders):
        leaf[t] = classes.setdefault(tuple(holders[t]), len(classes))
    rows: list[list[int]] = [[] for _ in items]
    for held, c in sorted(classes.items(), key=lambda x: (-len(x[0]), x[1])):  # the most shared classes first
        for i in held:
            rows[i].append(c)
    nodes, levels = len(classes), []
    depth = [0] * nodes
    made: list[tuple[int, int, int]] = []
    while any(len(r) > 1 for r in rows):
        seen = Counter(pair for r in rows for pair in zip(r, r[1:], strict=False))
        shared = any(n > 1 for n in seen.values())
        name: dict[tuple[int, int], int] = {}
        for i, r in enumerate(rows):
            out, at = [], 0
            while at < len(r):
                pair = (r[at], r[at + 1]) if at + 1 < len(r) else None
                # a pair gives way to its right neighbour if that is shared by more items
                better = pair and at + 2 < len(r) and seen[r[at + 1], r[at + 2]] > seen[pair]
                if pair and (not shared or (seen[pair] > 1 and not better)):
                    if pair not in name:
                        name[pair] = nodes
                        made.append((nodes, *pair))
                        depth.append(1 + max(depth[pair[0]], depth[pair[1]]))
                        nodes += 1
                    out.append(name[pair])
                    at += 2
                else:
                    out.append(r[at])
                    at += 1
            rows[i] = out
    for level in range(1, max(depth, default=0) + 1):
        own = np.array([m for m in made if depth[m[0]] == level], np.int64).reshape(-1, 3)
        levels.append((own[:, 0], own[:, 1], own[:, 2]))
    return Sharing(leaf, len(classes), levels, np.array([r[0] for r in rows], np.int64), nodes, sum(map(len, items)) - len(items))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, texts in text_chunks(batch.column(1), GAP):
            rows = np.repeat(np.arange(a, b), np.diff(texts.first_word))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(texts.word_hashes().view(np.int64))], names=["item_id", "term"])


HITS = "doc_id bigint, n bigint, terms array<int>, counts array<int>"


def _hits(wanted: np.ndarray):
    """Terms of each text that are among the sorted hashes ``wanted``, by their place there, and how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(1), GAP):
                words = texts.word_hashes()
                at = np.minimum(np.searchsorted(wanted, words), len(wanted) - 1)
                hit = np.flatnonzero(wanted[at] == words)
                doc = np.searchsorted(texts.first_word, hit, "right") - 1
                code, count = np.unique(doc * len(wanted) + at[hit], return_counts=True)
                ends = np.searchsorted(code, np.arange(len(texts) + 1) * len(wanted))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (code % len(wanted), count)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(texts.first_word)), *lists], names=["doc_id", "n", "terms", "counts"])
    return run


def _best(sharing: Sharing, weight: np.ndarray, docs: int, length: int, k: int):
    """The ``k`` best documents of each item among a task's (item number, doc_id, score)."""
    size = max(1, BLOCK_CELLS // sharing.nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = len(sharing.item)
        least = np.ones(items, np.int64)  # a score that still gets into an item's list
        held = [np.zeros((0, 3), np.int64) for _ in range(items)]  # score, without id, doc_id
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                rows = batch.slice(at, size)
                doc = rows.column(0)
                without = doc.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                doc = doc.fill_null(0).to_numpy(zero_copy_only=False)
                n = rows.column(1).to_numpy(zero_copy_only=False)
                m = 100 - 50 + (50 * n * docs) // length
                term, tf = (rows.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))
                who = np.repeat(np.arange(len(doc)), np.diff(rows.column(2).offsets.to_numpy()))
                part = np.zeros((sharing.nodes, len(doc)), np.int64)
                np.add.at(part, (sharing.leaf[term], who), weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[who])))
                for node, left, right in sharing.levels:
                    part[node] = part[left] + part[right]
                scores = part[sharing.item]
                item, place = np.nonzero(scores >= least[:, None])
                ends = np.searchsorted(item, np.arange(items + 1))
                for i in np.unique(item):
                    p = place[ends[i]:ends[i + 1]]
                    all_ = np.concatenate([held[i], np.stack([scores[i, p], without[p], doc[p]], axis=1)])
                    held[i] = all_[np.lexsort((all_[:, 2], all_[:, 1], -all_[:, 0]))[:k]]
                    if len(held[i]) == k:
                        least[i] = held[i][-1, 0]
        found = np.concatenate(held) if held else np.zeros((0, 3), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(items), [len(h) for h in held]), pa.int32()), pa.array(found[:, 2], mask=found[:, 1] > 0), pa.array(found[:, 0])],
            names=["item", "doc_id", "score"])
    return run


RANKED = "item_id bigint, rank int, doc_id bigint, score bigint"


def _search_block(stages: Stages, docs: DataFrame, asked: DataFrame, k: int) -> DataFrame | None:
    """Ranked documents of the items of ``asked`` (item_id, term), which a task can hold."""
    pairs = asked.select("item_id", "term").toArrow()
    if not pairs.num_rows:
        return None
    wanted, number = np.unique(pairs["term"].to_numpy().view(np.uint64), return_inverse=True)
    ids = pairs["item_id"].to_pylist()
    place: dict = {}
    items: list[list[int]] = []
    for i, t in zip(ids, number.tolist(), strict=True):
        if place.setdefault(i, len(items)) == len(items):
            items.append([])
        items[place[i]].append(t)
    sharing = mine_sharing(items, len(wanted))

    hits = stages.put("hits", docs.mapInArrow(_hits(wanted), HITS))
    total = hits.agg(F.count(F.expr("CASE WHEN n > 0 THEN 1 END")), F.sum("n")).first()
    n_docs, length = total[0], total[1] or 0
    if not length:
        return None
    df = np.zeros(len(wanted), np.int64)
    for r in hits.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toArrow().to_pylist():
        df[r["t"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    found = hits.where("n > 0 AND size(terms) > 0").mapInArrow(_best(sharing, weight, n_docs, length, k), "item int, doc_id bigint, score bigint")
    found = stages.put("best", found)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = stages.spark.createDataFrame([(n, i) for i, n in place.items()], "item int, item_id bigint")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # one row per item of the block


def search(stages: Stages, documents: DataFrame, benchmark: DataFrame, k: int = K) -> DataFrame:
    """The ``k`` highest-scoring rows of ``documents`` (doc_id, text) for each item of ``benchmark`` (item_id,
    text): item_id, rank (from 1), doc_id, score.

    Null, empty and blank texts have no terms: such documents are ranked nowhere, such items get no rows.
    Rows that share an item_id (null too) are one item of all their terms, each term once. Every row of
    ``documents`` is a document, repeated ones too; equal scores are ranked by doc_id, null last. Only
    scores above 0 count. Whole texts of any length; terms are known by 64-bit hashes. Extra columns are
    ignored; an empty table gives no rows."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = stages.put("asked", items.mapInArrow(_item_terms, "item_id bigint, term bigint").distinct())
    blocks = max(1, -(-asked.count() // (BLOCK_TERMS // 2))) if asked.count() > BLOCK_TERMS else 1
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = None
    for b in range(blocks):
        part = _search_block(stages, docs, asked.where(block == b), k)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    return stages.spark.createDataFrame([], RANKED) if found is None else found


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return search(Stages(spark), docs, items)


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH words AS (SELECT row, doc_id, unnest({_TERMS}) AS term FROM (SELECT row_number() OVER () AS row, * FROM documents)),
sizes AS (SELECT row, count(*) AS n FROM words GROUP BY row),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
postings AS (SELECT row, doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, whole GROUP BY term),
parts AS (
  SELECT p.row, p.doc_id, p.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // length))) AS part
  FROM postings p JOIN weights USING (term) JOIN sizes USING (row), whole),
scored AS (SELECT item_id, row, doc_id, CAST(sum(part) AS BIGINT) AS score FROM asked JOIN parts USING (term) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= {K}
"""
