"""Quality rules with cross-document line frequency.

Lines are normalised (words, A-Z lower-cased, joined by one space) and hashed. A line is above the
limit of its host (column ``source``) when it stands in more than ``max(MIN_DOCUMENTS, HOST_PERCENT %
of the host's documents)`` distinct documents of that host; documents with the same text count
once, so copies do not condemn their own lines. Lines above the limit are removed everywhere, and a
document that loses more than DEPLETED_PERCENT % of its words is rejected, as is one that fails the
base rules (too few words, or too many in repeated three-word windows).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cohortkit.llm.memory import give_back
from cohortkit.llm.tables import Stages, by_place, join_unique
from cohortkit.llm.textops import Texts, run_hashes, text_chunks, window_hashes

MIN_WORDS = 50
REPEAT_PERCENT = 50
MIN_DOCUMENTS = 10
HOST_PERCENT = 10
DEPLETED_PERCENT = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_NEWLINE = 10


def _line_bounds(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all lines (an end of text ends a line), and the index of each text's first line."""
    ends = np.sort(np.concatenate([np.flatnonzero(texts.data == _NEWLINE), texts.bounds[1:]]))
    newlines = np.concatenate([[0], np.cumsum(texts.data == _NEWLINE)])[texts.bounds]
    return ends, newlines + np.arange(len(texts) + 1)


def _repeats(words: np.ndarray) -> int:
    """Words in three-word windows that occur twice or more, the first occurrence included."""
    if len(words) < 4:
        return 0
    _, where, times = np.unique(window_hashes(words, 3), return_inverse=True, return_counts=True)
    covered = np.zeros(len(words), bool)
    twice = times[where] > 1
    for k in range(3):
        covered[k:len(words) - 2 + k] |= twice
    return int(covered.sum())


MEASURES = ("uid bigint, doc_id bigint, host string, text_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
            "n_dup_lines bigint, n_repeat_words bigint, lines array<struct<line: bigint, words: bigint>>")


def _lists_of(ids: list[np.ndarray], held: list[np.ndarray]) -> pa.Array:
    """A list of (line, words) for each text."""
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    flat = [pa.array(np.concatenate(x).astype(np.int64, copy=False)) for x in (ids, held)]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(flat, names=["line", "words"]))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base counts of each text, and its distinct lines with the words they hold in all. A worker holds the rows of
    one chunk of texts at a time."""
    names = [x.split()[0] for x in MEASURES.split(", ")[:9]] + ["lines"]
    for batch in batches:
        for at, to, texts in text_chunks(batch.column(3)):
            columns: list[list] = [[] for _ in range(6)]
            line_ids, line_words = [], []
            hashes, exact = texts.word_hashes(), texts.word_hashes(lower=False)
            # code points of words: bytes that are not UTF-8 continuations
            heads = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
            chars = np.concatenate([[0], np.cumsum(heads[texts.ends] - heads[texts.begins])])
            symbols = np.concatenate([[0], np.cumsum(_SYMBOL[texts.data])])[texts.bounds]
            ends, first_line = _line_bounds(texts)
            first = np.searchsorted(texts.begins, np.concatenate([[0], ends[:-1]]))
            stop = np.searchsorted(texts.begins, ends)
            normal = run_hashes(hashes, first, stop)
            begins = np.concatenate([[0], ends[:-1] + 1])
            begins[first_line[:-1]] = texts.bounds[:-1]
            verbatim = run_hashes(texts.data, np.minimum(begins, ends), ends)
            filled = stop > first
            whole = run_hashes(hashes, texts.first_word[:-1], texts.first_word[1:])
            for k in range(len(texts)):
                a, b = texts.first_word[k], texts.first_word[k + 1]
                own = np.arange(first_line[k], first_line[k + 1])
                own = own[filled[own]]
                ids, where = np.unique(normal[own], return_inverse=True)
                line_ids.append(ids.view(np.int64))
                line_words.append(np.bincount(where, weights=(stop - first)[own], minlength=len(ids)))
                for column, value in zip(columns, (
                        int(whole[k].view(np.int64)), int(b - a), int(chars[b] - chars[a]), int(symbols[k + 1] - symbols[k]),
                        len(own) - len(np.unique(verbatim[own])), _repeats(exact[a:b])), strict=True):
                    column.append(value)
            rows = batch.slice(at, to - at)
            out = [rows.column(0), rows.column(1), rows.column(2), *(pa.array(c, pa.int64()) for c in columns), _lists_of(line_ids, line_words)]
            yield pa.RecordBatch.from_arrays(out, names=names)
        give_back()


def _frequent_lines(stages: Stages, measured: DataFrame) -> DataFrame:
    """(host, line) above the host's limit, with ``rows``, the documents (copies too) that hold it."""
    docs = measured.select("host", "text_id", F.explode("lines.line").alias("line"))
    limit = F.greatest(F.lit(MIN_DOCUMENTS), F.floor(F.col("documents") * HOST_PERCENT / 100))
    hosts = measured.groupBy("host").agg(F.countDistinct("text_id").alias("documents")).select("host", limit.alias("most"))
    one = docs.groupBy("host", "line", "text_id").agg(F.count("*").alias("copies"))
    counted = one.groupBy("host", "line").agg(F.count("*").alias("documents"), F.sum("copies").alias("rows"))
    often = counted.where(F.col("documents") > MIN_DOCUMENTS)
    return stages.put("frequent", often.join(hosts, often.host.eqNullSafe(hosts.host)).where("documents > most").select(often.host, "line", "rows"))


def quality_rules(stages: Stages, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verdicts per row of ``documents`` (doc_id, text, source), and the (host, line) pairs removed.

    Verdict columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, n_removed_words, uid. Null or empty text: no words, which fails the base rules. A null host
    is a host of its own. Every row is a document; rows with equal words count once for line
    frequency. Ties need no order. Extra columns are ignored; an empty table gives no rows."""
    docs = documents.select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("host"), F.col("text").cast("string").alias("text"))
    measured = stages.put("measured", docs.mapInArrow(_measure, MEASURES))
    frequent = _frequent_lines(stages, measured)
    held = measured.select("uid", "host", F.explode("lines").alias("l")).select("uid", F.col("host"), "l.line", "l.words")
    held = held.withColumn("key", F.xxhash64("host", "line")).select("uid", "key", "words")
    keys = frequent.select(F.xxhash64("host", "line").alias("key"), F.lit(True).alias("often"), "rows")
    total = measured.agg(F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()[0]
    removed = join_unique(held, keys, "key", ["often"], "rows", total).where("often").groupBy("uid").agg(F.sum("words").alias("n"))
    out = measured.drop("lines", "text_id", "host").join(removed, "uid", "left").withColumn("n_removed_words", F.coalesce("n", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    depleted = 100 * F.col("n_removed_words") > DEPLETED_PERCENT * F.col("n_words")
    verdicts = out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "n_removed_words", "uid")
    return verdicts, frequent


def _clean(schema: list[str], text: str):
    """Texts without their host's frequent lines (last column), of the documents that pass."""
    text_at = schema.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frequent = batch.column(len(schema))
            lines, bounds = frequent.values.to_numpy(zero_copy_only=False), frequent.offsets.to_numpy()
            some = frequent.is_valid().to_numpy(zero_copy_only=False)
            for at, to, texts in text_chunks(batch.column(text_at)):
                kept, out = [], []
                hashes, exact = texts.word_hashes(), texts.word_hashes(lower=False)
                ends, first_line = _line_bounds(texts)
                first = np.searchsorted(texts.begins, np.concatenate([[0], ends[:-1]]))
                stop = np.searchsorted(texts.begins, ends)
                normal = run_hashes(hashes, first, stop).view(np.int64)
                for k in range(len(texts)):
                    a, b = texts.first_word[k], texts.first_word[k + 1]
                    if b - a < MIN_WORDS or 100 * _repeats(exact[a:b]) > REPEAT_PERCENT * (b - a):
                        continue
                    own = np.arange(first_line[k], first_line[k + 1])
                    words = stop[own] - first[own]
                    host = lines[bounds[at + k]:bounds[at + k + 1]] if some[at + k] else lines[:0]
                    gone = np.isin(normal[own], host) & (words > 0)
                    if 100 * words[gone].sum() > DEPLETED_PERCENT * (b - a):
                        continue
                    data = texts.data[texts.bounds[k]:texts.bounds[k + 1]].tobytes()
                    if gone.any():
                        data = b"\n".join(x for x, g in zip(data.split(b"\n"), gone, strict=True) if not g)
                    kept.append(k)
                    out.append(data.decode("utf-8"))
                rows = batch.slice(at, to - at).take(pa.array(kept, pa.int64()))
                columns = [rows.column(i) if i != text_at else pa.array(out, pa.string()) for i in range(len(schema))]
                yield pa.RecordBatch.from_arrays(columns, names=schema)
            give_back()
    return run


def clean_documents(stages: Stages, documents: DataFrame) -> DataFrame:
    """The kept rows of ``documents`` with the lines above the limit removed; the same columns.

    A host has at most 100 / HOST_PERCENT times its mean lines a document of such lines, so they
    travel as one array per host. ``n_chars``, where there is one, is counted anew."""
    docs = documents.select(
        F.monotonically_increasing_id().alias("uid"), F.lit(None).cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("host"), F.col("text").cast("string").alias("text"))
    measured = stages.put("measured", docs.mapInArrow(_measure, MEASURES))
    frequent = _frequent_lines(stages, measured)
    host_key = F.xxhash64(F.coalesce("host", F.lit("")), F.col("host").isNull()).alias("host_key")
    lines = frequent.groupBy(host_key).agg(F.collect_list("line").alias("lines"))
    sizes = measured.groupBy(host_key).agg(F.count("*").alias("n"))
    hosts = stages.put("hosts", lines.join(sizes, "host_key"))
    rows, own = by_place(documents)
    host = F.col(own["source"])
    rows = rows.withColumn("host_key", F.xxhash64(F.coalesce(host.cast("string"), F.lit("")), host.isNull()))
    out = join_unique(rows, hosts, "host_key", ["lines"], "n", measured.count())
    places = list(own.values())
    kept = out.select(*places, "lines").mapInArrow(_clean(places, own["text"]), StructType([StructField(own[f.name], f.dataType) for f in documents.schema]))
    if "n_chars" in own:
        kept = kept.withColumn(own["n_chars"], F.char_length(own["text"]).cast(documents.schema["n_chars"].dataType))
    return kept.toDF(*documents.columns)


def op1_line_frequency(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return quality_rules(Stages(spark), docs)[0].drop("uid")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, array_to_string(regexp_extract_all(low, '[^\x20\x09-\x0D]+'), ' ') AS whole
  FROM d),
win AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (
  SELECT count(DISTINCT i + k) AS n, doc_id
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM win), (SELECT unnest([0, 1, 2]) AS k)
  WHERE times > 1 GROUP BY doc_id),
raw AS (SELECT doc_id, source, whole, unnest(string_split(text, chr(10))) AS line FROM w),
l AS (
  SELECT doc_id, source, whole, line, regexp_extract_all(
           translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS lw
  FROM raw),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l WHERE len(lw) > 0 GROUP BY doc_id),
f AS (
  SELECT source, lw FROM l WHERE len(lw) > 0 GROUP BY source, lw
  HAVING count(DISTINCT whole) > greatest({MIN_DOCUMENTS}, floor((SELECT count(DISTINCT h.whole) FROM w h WHERE h.source IS NOT DISTINCT FROM l.source) * {HOST_PERCENT} / 100))),
gone AS (SELECT doc_id, sum(len(l.lw)) AS n FROM l JOIN f ON l.lw = f.lw AND l.source IS NOT DISTINCT FROM f.source GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(twice.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN twice USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words)
         AND NOT 100 * n_removed_words > {DEPLETED_PERCENT} * n_words AS kept, n_removed_words
FROM m
"""
