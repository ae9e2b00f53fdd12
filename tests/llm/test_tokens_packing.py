import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortkit.llm import packing, separator_scan
from cohortkit.llm.tables import Stages
from cohortkit.llm.tokens import encode_column

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", " ", "  two  spaces ", "tab\tand\n new\n\n lines \n", "it's o'clock, don't!", "a b  c　 d", "x \x1c y", "<|endoftext|> in text<|endoftext|>",
         "ünï cödé 中文 🙂🙂", "1234 56,7", "word " * 3000, "#" * 50, " lead", "trail ", None, "é" * 5000, "no spaces at all " + "q" * 30000, "  \n  \n"]
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_tokenizer(tokenizer):
    got = list(encode_column(pa.array(TEXTS), PATH))
    for text, ids in zip(TEXTS, got, strict=True):
        assert ids.tolist() == (tokenizer.encode(text, add_special_tokens=False).ids if text else []), repr(text)[:40]
    import pyarrow.parquet as pq
    column = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].combine_chunks()
    for text, ids in zip(column.to_pylist(), encode_column(column, PATH), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_separator_scan_counts(spark, tokenizer):
    rows = list(enumerate(TEXTS)) + [(None, "null id"), (3, "again"), (3, "again"), (99, "long word " * 60000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_tokens", F.lit("x")).withColumn("file", F.lit(0))
    stages = Stages(spark)
    df = stages.put("docs", df)
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    want = sorted((str(i), len(plain.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens) for r in separator_scan.token_counts(stages, df, PATH).collect()) == want
    assert separator_scan.token_counts(stages, stages.put("none", df.limit(0)), PATH).count() == 0


def test_documents_across_blocks_are_stitched(spark, tmp_path):
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 4, 400_000).astype("<u2")
    ids[100_000:300_000] = 1  # a document over several blocks
    (tmp_path / "part-00000-x").write_bytes(ids.tobytes() + b"\x07")
    (tmp_path / "part-00001-x").write_bytes(b"")
    (tmp_path / "part-00002-x").write_bytes(np.array([3, 3, 0], "<u2").tobytes())
    got = sorted((r.file[-7:], r.ordinal, r.start, r.n_tokens, r.ended) for r in separator_scan.scan_documents(spark, str(tmp_path), end_id=3).collect())
    want, start, k = [], 0, 0
    for at in [*np.flatnonzero(ids == 3), len(ids)]:
        if at < len(ids) or at > start:
            want.append(("00000-x", k, start, int(at - start), bool(at < len(ids))))
        start, k = int(at) + 1, k + 1
    want += [("00002-x", 0, 0, 0, True), ("00002-x", 1, 1, 0, True), ("00002-x", 2, 2, 1, False)]
    assert got == sorted(want)


def item_best_fit(lengths, size):
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= n]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - n)
        else:
            free.append(size - n)
    return len(free)


@pytest.mark.parametrize("seed", range(6))
def test_plan_equals_best_fit_over_items(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.integers(5, 90))
    lengths = rng.integers(1, size + 1, int(rng.integers(1, 600))) if seed % 2 else rng.choice(rng.integers(1, size + 1, 5), 700)
    histogram = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
    slots, made = packing.plan_best_fit(histogram, size)
    used = {}
    for s in slots:
        for r in range(s.count):
            used.setdefault(s.sequence + r // s.per, []).append((s.offset + r % s.per * s.length, s.length))
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    assert len(used) == made == item_best_fit(lengths.tolist(), size)
    for n, count in histogram.items():
        assert sorted(r for s in slots if s.length == n for r in range(s.first, s.first + s.count)) == list(range(count))
    assert packing.plan_best_fit({}, size) == ([], 0)


def test_packed_documents(spark, tokenizer):
    rows = list(enumerate(TEXTS)) * 3 + [(None, "null id"), (1, "x " * 1022), (2, "x " * 1023), (4, "x " * 1024), (5, "y " * 5000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("length", F.lit(1)).withColumn("task", F.lit(1)).withColumn("rank", F.lit(1))
    packed = packing.pack_documents(Stages(spark), df, PATH, with_ids=True)
    got = packed.collect()
    want = []
    for i, t in rows:
        ids = (tokenizer.encode(t, add_special_tokens=False).ids if t else []) + [2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            raw = struct.pack(f"<{b - a}I", *ids[a:b])
            want.append((str(i), p, a, b - a, zlib.crc32(raw), raw))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length, bytes(r.ids)))
    for parts in by.values():
        end = 0
        for offset, length, _ in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(by) == item_best_fit([w[3] for w in want], 1024)
    joined = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert joined == {s: b"".join(p for _, _, p in sorted(parts)) for s, parts in by.items()}
    assert packing.pack_documents(Stages(spark), df.limit(0), PATH).count() == 0
