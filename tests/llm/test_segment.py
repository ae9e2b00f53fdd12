import itertools

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import segment as s

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", None, "the", " a  b ", "ünï 中文 🙂!", "tab\tnew\nline", "aaaa aaaa", "▁▁ x", "q" * 3000, "word " * 4000, "Hello, it's 10:30."]


def all_paths(pieces, text):
    """Every segmentation (score, ids) of a short text, by recursion over its characters."""
    by_text = {t: i for i, t in pieces.text.items()}

    def walk(at):
        if at == len(text):
            yield 0.0, ()
            return
        for stop in range(at + 1, len(text) + 1):
            piece = by_text.get(text[at:stop])
            if piece is None and not (stop == at + 1):
                continue
            score = pieces.unknown if piece is None else pieces.score[piece]
            ids = tuple(pieces.bytes_ids[b] for b in text[at].encode()) if piece is None else (piece,)
            for rest, more in walk(stop):
                yield score + rest, ids + more

    return sorted(walk(0), key=lambda p: -p[0])


@pytest.fixture(scope="module")
def pieces():
    return s.load_pieces(MODEL)


@pytest.mark.parametrize("text", ["the cat", "international", "aab  ba", "中x🙂", "a\nb", "3.14 = pi", "ab ab ab"])
def test_n_best_are_the_best_of_all_paths(spark, pieces, text):
    normal = s.SPACE + text.replace(" ", s.SPACE)
    want = all_paths(pieces, normal)
    got = s.segment_documents(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), MODEL, n_best=5).first()
    assert np.allclose(got.scores, [w[0] for w in want[:5]])
    known = {ids: score for score, ids in want}
    found = [tuple(np.frombuffer(x, "<i4").tolist()) for x in got.ids]
    assert len(set(found)) == len(found) and all(np.isclose(known[f], sc) for f, sc in zip(found, got.scores, strict=True))
    assert got.round_trip and pieces.decode(list(found[0])) == text


def test_whole_texts(spark, pieces):
    rows = list(enumerate(TEXTS)) + [(None, "null id"), (2, "the")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("scores", F.lit(1)).withColumn("ids", F.lit(1))
    for digests in (False, True):
        out = s.segment_documents(df, MODEL, digests=digests).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == sorted((i is None, i or 0) for i, _ in rows)
        for r in out:
            text = None if r.doc_id is None else TEXTS[r.doc_id]
            assert r.round_trip == (s.SPACE not in (text or "")) or r.doc_id == 1
            assert r.scores == sorted(r.scores, reverse=True) and 1 <= r.n_segmentations <= 4
            if not digests and text:
                for x in r.ids:
                    assert pieces.decode(np.frombuffer(x, "<i4").tolist()) == text.replace(s.SPACE, " ")
            if r.doc_id in (0, 1):
                assert (r.n_pieces, r.n_segmentations, r.scores) == (0, 1, [0.0])
    assert s.segment_documents(df.limit(0), MODEL).count() == 0


def test_cached_and_fresh_chunks_agree(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    first = sorted(map(str, s.segment_documents(docs, MODEL, digests=True).collect()))
    monkeypatch.setattr(s, "CHUNK_CHARS", 1000)
    assert sorted(map(str, s.segment_documents(docs, MODEL, digests=True).collect())) == first
    assert all("round_trip=True" in r for r in first)


def test_least_sums():
    options = [[(0.0, b""), (1.5, b""), (2.0, b"")], [(0.0, b""), (1.0, b"")], [(0.0, b""), (0.25, b""), (9.0, b"")]]
    want = sorted((sum(o[j][0] for o, j in zip(options, pick, strict=True)), pick) for pick in itertools.product(range(3), range(2), range(3)))
    assert s._least_sums(options, 7) == want[:7] and s._least_sums([], 4) == [(0.0, ())]


def test_a_full_cache_keeps_the_chunks_of_the_texts_at_hand(pieces, monkeypatch):
    solved, solve = [], s._solve
    monkeypatch.setattr(s, "CACHED_CHUNKS", 4)
    monkeypatch.setattr(s, "_solve", lambda pieces, texts: solved.append(sorted(texts)) or solve(pieces, texts))
    known = {}
    for text in ("a b c", "a b d e f"):
        got = s._segment_some(pieces, known, pa.array([1]), [text], 2, True)
        assert got.equals(s._segment_some(pieces, {}, pa.array([1]), [text], 2, True))
    assert solved[0::2] == [["▁a", "▁b", "▁c"], ["▁d", "▁e", "▁f"]]
    assert len(known) == 5


def test_chunks_are_decoded_one_by_one_and_in_a_row(pieces):
    texts = ["▁ab", "ü中🙂", "x"]
    ids = [c.ids for c in s._solve(pieces, texts)]
    assert pieces.decode_to(ids, texts) and pieces.decode_to([], [])
    assert not pieces.decode_to(ids, ["▁a", "bü中🙂", "x"])  # the same bytes in a row
    assert not pieces.decode_to(ids, ["▁ab", "ü中🙂", "y"])
