"""Best-fit packing planned over the histogram of lengths.

The plan never sees a document: lengths with their counts (at most MAX_TOKENS of them) are placed
longest first into the tightest open sequences, as many of one length at once as fit. It yields slots
(length, ranks, sequences, offset); a piece takes the slot of its rank within its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.memory import give_back
from cohortkit.llm.tables import Stages
from cohortkit.llm.tokens import encode_column

MAX_TOKENS = 1024
END_ID = 2
BATCH_ROWS = 1000  # documents whose pieces a worker holds at once


@dataclass
class Slots:
    """Ranks [first, first + count) of a length, ``per`` in each sequence from ``sequence`` on,
    one behind the other from ``offset``."""

    length: int
    first: int
    count: int
    per: int
    sequence: int
    offset: int


def plan_best_fit(histogram: dict[int, int], size: int = MAX_TOKENS) -> tuple[list[Slots], int]:
    """Best-fit decreasing over ``histogram`` (length -> pieces); returns slots and the number of
    sequences. Open sequences of equal room are one group of consecutive numbers; a length changes
    every group it meets as a whole but for the last, which is split in three at most."""
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> groups (first sequence, number)
    slots: list[Slots] = []
    made = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0

        def put(first: int, number: int, free: int, per: int) -> None:
            nonlocal left, rank
            slots.append(Slots(length, rank, number * per, per, first, size - free))
            rank, left = rank + number * per, left - number * per
            if free - per * length:
                room.setdefault(free - per * length, []).append((first, number))

        while left:
            free = min((f for f in room if f >= length), default=0)
            if free:
                first, number = room[free].pop()
                if not room[free]:
                    del room[free]
            else:
                free, first = size, made
                number = -(-left // (size // length))
                made += number
            per = free // length
            full = min(number, left // per)
            if full < number:  # the last pieces: one sequence takes some, the rest stays open
                some = left - full * per
                unused = first + full + (1 if some else 0)
                if unused < first + number:
                    room.setdefault(free, []).append((unused, first + number - unused))
                if full:
                    put(first, full, free, per)
                if some:
                    put(first + full, 1, free, some)
            else:
                put(first, full, free, per)
    return slots, made


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, place bigint"


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, max(1, batch.num_rows), BATCH_ROWS):
        yield batch.slice(at, BATCH_ROWS)
    give_back()


def _pieces(tokenizer: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(MAX_TOKENS + 1, np.int64)
        for batch in (some for whole in batches for some in _slices(whole)):
            rows: list[tuple] = []
            docs = batch.column(0).to_pylist()
            for doc, ids in zip(docs, encode_column(batch.column(1), tokenizer), strict=True):
                ids = np.append(ids, END_ID).astype("<u4")
                first = (len(ids) - 1) % MAX_TOKENS + 1
                cuts = [0, *range(first, len(ids) + 1, MAX_TOKENS)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    own = ids[a:b].tobytes()
                    rows.append((doc, piece, a, b - a, zlib.crc32(own), task, int(seen[b - a]), *([own] if with_ids else [])))
                    seen[b - a] += 1
            names = [x.split()[0] for x in PIECES.split(", ")] + ["ids"] * with_ids
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()] + [pa.binary()] * with_ids
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
    return run


def _place(slots: list[Slots]):
    by_length = {}
    for length in {s.length for s in slots}:
        own = [s for s in slots if s.length == length]  # ranks ascend as planned
        by_length[length] = [np.array([getattr(s, k) for s in own], np.int64) for k in ("first", "per", "sequence", "offset")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            length, rank = (batch.column(at(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for one in np.unique(length):
                rows = np.flatnonzero(length == one)
                first, per, seq, off = by_length[int(one)]
                k = np.searchsorted(first, rank[rows], "right") - 1
                inside = rank[rows] - first[k]
                sequence[rows] = seq[k] + inside // per[k]
                offset[rows] = off[k] + inside % per[k] * one
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], names=[*batch.schema.names, "sequence_id", "offset"])
    return run


def pack_documents(stages: Stages, documents: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """Pieces of ``documents`` (doc_id, text) with their place: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset (and ``ids``, little-endian unsigned 32-bit, if asked for).

    A document is its text's ids and END_ID; null or empty text: END_ID alone. Longer ones are cut
    into MAX_TOKENS-token pieces, the remainder first. Repeated rows, ties and null doc_ids are
    pieces like any other: ranks within a length come from the place in the written pieces table.
    Extra columns are ignored; an empty table gives no rows."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = stages.put("pieces", docs.mapInArrow(_pieces(tokenizer, with_ids), PIECES + (", ids binary" if with_ids else "")))
    counts = stages.put("counts", pieces.groupBy("task", "length").agg(F.count("*").alias("n")))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # MAX_TOKENS rows at most
    slots, _ = plan_best_fit(histogram)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(starts, ["task", "length"]).withColumn("rank", F.col("before") + F.col("place"))
    out = ranked.select(*[c for c in pieces.columns if c not in ("task", "place")], "rank")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema) + ", sequence_id bigint, offset bigint"
    return out.mapInArrow(_place(slots), schema).drop("rank")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences' token ids (``packed`` with ``ids``): sequence_id, n_tokens, ids."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("n_tokens"))
    return parts.select("sequence_id", "n_tokens", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(Stages(spark), docs, public_tokenizers.path("byte_bpe_50k.json"))
