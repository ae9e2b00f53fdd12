"""Fill-in-the-middle transformation by block rotation inside one buffer.

A text is cut into prefix, middle and suffix at two places that hang on a keyed digest of its id. The
text's bytes are scanned once for the cuts (places are code points, a code point is found by its first
byte), each block gets its sentinel in a bytearray, and neighbouring blocks change places by three
reversals: both blocks are reversed on their own, then the two together. A rotation is undone by
rotating back, so the source is rebuilt from the output and its form alone.

Rows are independent: no shuffle, and a task holds one Arrow batch and the buffer of one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
FIM_PERCENT = 90
SPM_PERCENT = 20
SEED = 1


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2^32 from the SHA-256 of ``seed:doc_id`` (a null id: nothing after the colon)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def rotate(buf: bytearray, start: int, mid: int, end: int) -> None:
    """Exchange buf[start:mid] and buf[mid:end] in place by three reversals."""
    for a, b in ((start, mid), (mid, end), (start, end)):
        block = buf[a:b]
        block.reverse()
        buf[a:b] = block


def cut_places(text: bytes, h1: int, h2: int) -> tuple[int, int, int, int, int]:
    """Code points, the two cuts in code points, and the two cuts in bytes."""
    if text.isascii():
        n = len(text)
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        return n, a, b, a, b
    first = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)  # bytes that begin a code point
    n = len(first)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    at = [int(first[k]) if k < n else len(text) for k in (a, b)]
    return n, a, b, at[0], at[1]


def transform(text: bytes, doc_id: int | None, seed: int = SEED, fim_percent: int = FIM_PERCENT,
              spm_percent: int = SPM_PERCENT) -> tuple[bytes, str, int, int | None, int | None]:
    """(output, form, code points, those of the prefix, those of the middle)."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    n, a, b, at, to = cut_places(text, h1, h2)
    if not text or h3 % 100 >= fim_percent or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return text, PLAIN, n, None, None
    buf = bytearray(text)
    buf[to:to] = SUFFIX
    buf[at:at] = MIDDLE
    buf[0:0] = PREFIX
    second, third = at + len(PREFIX), to + len(PREFIX) + len(MIDDLE)  # where the blocks of middle and suffix begin
    rotate(buf, second, third, len(buf))
    if h4 % 100 < spm_percent:
        rotate(buf, 0, second, second + len(buf) - third)
        return bytes(buf), SPM, n, a, b - a
    return bytes(buf), PSM, n, a, b - a


def restore(output: bytes, form: str) -> bytes:
    """The source of an output: rotations undone, sentinels taken out.

    A source with a sentinel's string stays plain, and no sentinel can arise across a cut, so each is
    found exactly once."""
    if form == PLAIN:
        return output
    buf = bytearray(output)
    if form == SPM:
        rotate(buf, 0, buf.index(PREFIX), buf.index(MIDDLE))
    second, third = buf.index(SUFFIX), buf.index(MIDDLE)
    rotate(buf, second, third, len(buf))
    third = buf.index(SUFFIX)
    del buf[third:third + len(SUFFIX)]
    del buf[second:second + len(MIDDLE)]
    del buf[0:len(PREFIX)]
    return bytes(buf)


FORMED = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def _bytes(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def _texts(values: list[bytes], like: pa.DataType) -> pa.Array:
    return pa.array(values, pa.large_binary() if like == pa.large_string() else pa.binary()).cast(like)


def _transform_batches(seed: int, fim_percent: int, spm_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [transform(text, doc, seed, fim_percent, spm_percent) for doc, text in zip(batch.column(0).to_pylist(), _bytes(batch.column(1)), strict=True)]
            output, form, n, prefix, middle = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                 _texts(list(output), batch.column(1).type)], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def _restore_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        output, form = batch.column(batch.num_columns - 1), batch.column(batch.schema.get_field_index("form"))
        back = [restore(text, kind) for text, kind in zip(_bytes(output), form.to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, _texts(back, output.type)], names=[*batch.schema.names, "restored"])


def fill_in_middle(documents: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): doc_id, n (code points), form (plain, psm or spm),
    prefix_chars, middle_chars (null if plain) and output.

    Null and empty texts are plain and empty. A null doc_id draws like an empty one; repeated rows and
    rows that share a doc_id and a text get the same output. Whole texts of any length are cut; extra
    columns are ignored; an empty table gives no rows."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_transform_batches(seed, fim_percent, spm_percent), FORMED)


def restore_texts(formed: DataFrame) -> DataFrame:
    """``formed`` (any columns, with form and output) and ``restored``: the source text of each output.

    A null form counts as plain, a null output as empty."""
    cols = [c for c in formed.columns if c not in ("form", "output", "restored")]
    own = formed.select(*cols, F.coalesce("form", F.lit(PLAIN)).alias("form"), "output")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
    return own.mapInArrow(_restore_batches, schema + ", restored string")


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    back = restore_texts(fill_in_middle(docs))
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4 FROM d),
f AS (
  SELECT doc_id, text, n, least(c1, c2) AS a, greatest(c1, c2) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= {FIM_PERCENT} THEN 'plain'
         WHEN h4 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (
  SELECT *, substr(text, 1, a) AS x, substr(text, a + 1, b - a) AS y, substr(text, b + 1, n - b) AS z FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
         ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
