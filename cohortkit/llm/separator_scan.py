"""Token counts by scanning flat token files for the end-of-document id.

A flat file is nothing but token ids (little-endian unsigned 16-bit): no header, no index. Files are
cut into blocks; each block is searched at once with numpy and yields its separators' places. A
prefix scan over a file's blocks (documents ended before, last separator before) stitches documents
that cross blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit.llm.tables import Stages
from cohortkit.llm.tokens import encode_column

END_ID = 50256
WIDTH = "<u2"
BLOCK_TOKENS = 1 << 16


def write_token_files(documents: DataFrame, folder: str, tokenizer: str) -> None:
    """Write the ids of ``documents`` (text), each followed by END_ID, as one flat file per partition.

    The text writer puts a row's bytes as they are and then its line separator, here END_ID's bytes."""
    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x.astype(WIDTH).tobytes() for x in encode_column(batch.column(0), tokenizer, special_ids=False)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])

    end = np.array([END_ID], WIDTH).tobytes().decode("latin-1")
    rows = documents.select(F.col("text").cast("string")).mapInArrow(ids, "ids binary")
    rows.select(F.col("ids").cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option("lineSep", end).text(folder)


BLOCKS = "file string, block bigint, n_tokens bigint, ends array<bigint>"


def _blocks(end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                data = np.frombuffer(content.as_buffer(), np.uint8)
                data = data[:len(data) // 2 * 2].view(WIDTH)
                found = np.flatnonzero(data == end_id)
                sizes = np.diff(np.append(np.arange(0, len(data), BLOCK_TOKENS), len(data)))
                cuts = np.searchsorted(found, np.arange(len(sizes) + 1) * BLOCK_TOKENS)
                ends = [found[a:b] - k * BLOCK_TOKENS for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path.as_py()] * len(sizes), pa.string()), pa.array(np.arange(len(sizes))), pa.array(sizes), pa.array(ends, pa.list_(pa.int64()))],
                    names=["file", "block", "n_tokens", "ends"])
    return run


def scan_documents(spark: SparkSession, folder: str, end_id: int = END_ID) -> DataFrame:
    """One row per document of the flat files in ``folder``: file, ordinal (from 0 in the file), start
    (its first token's place in the file), n_tokens (END_ID left out), ended (false for tokens
    behind a file's last separator). A file is read by one task and may have 2 GB; an odd last byte
    is no token. Documents of no tokens are rows of n_tokens 0; an empty file has none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    blocks = files.mapInArrow(_blocks(end_id), BLOCKS)
    base = F.col("block") * BLOCK_TOKENS
    blocks = blocks.withColumn("ends", F.transform("ends", lambda x: x + base))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    tail = (F.col("last_end") + 1 < F.col("tokens")) & (base + F.col("n_tokens") == F.col("tokens"))
    scanned = blocks.select(
        "*", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("ordinal0"),
        F.coalesce(F.max(F.array_max("ends")).over(before), F.lit(-1)).alias("end0"),
        F.coalesce(F.max(F.array_max("ends")).over(whole), F.lit(-1)).alias("last_end"), F.sum("n_tokens").over(whole).alias("tokens"))
    ends = F.transform("ends", lambda e: F.struct(e.alias("at"), F.lit(True).alias("ended")))
    ends = F.when(tail, F.concat(ends, F.array(F.struct(F.col("tokens").alias("at"), F.lit(False).alias("ended"))))).otherwise(ends)
    docs = scanned.select("file", "ordinal0", "end0", ends.alias("ends"))
    start = lambda i: F.coalesce(F.get("ends", i - 1)["at"], F.col("end0")) + 1
    rows = F.transform("ends", lambda e, i: F.struct(
        (F.col("ordinal0") + i).alias("ordinal"), start(i).alias("start"), (e["at"] - start(i)).alias("n_tokens"), e["ended"].alias("ended")))
    return docs.select("file", F.inline(rows))


def token_counts(stages: Stages, documents: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, file, ordinal, start, n_tokens of every row of ``documents`` (doc_id, text), counted by
    writing flat token files and scanning them.

    ``documents`` must keep its order within partitions when run again (a file scan does); files and
    documents are matched by place, and a count that does not fit raises an error. Null or empty
    text: 0 tokens. Null doc_ids and repeated rows are rows like any other. Extra columns are ignored;
    an empty table gives no rows."""
    spark = stages.spark
    folder = stages.path("tokens")
    place = F.monotonically_increasing_id()
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), place.alias("place"))
    rows = stages.put("places", rows.select("doc_id", F.shiftright("place", 33).cast("int").alias("file"), F.col("place").bitwiseAND((1 << 33) - 1).alias("ordinal")))
    write_token_files(documents, folder, tokenizer)
    found = scan_documents(spark, folder)
    found = found.withColumn("file", F.regexp_extract("file", r"part-(\d+)[^/]*$", 1).cast("int"))
    both = rows.join(found, ["file", "ordinal"], "full")
    unfit = F.raise_error("token files and documents do not fit").cast("long")
    n = F.when(F.col("n_tokens").isNull() | ~F.coalesce("ended", F.lit(False)) | rows["ordinal"].isNull(), unfit).otherwise(F.col("n_tokens"))
    return both.select("doc_id", "file", "ordinal", "start", n.alias("n_tokens"))


def op2_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts(Stages(spark), docs, public_tokenizers.path("byte_bpe_50k.json"))
