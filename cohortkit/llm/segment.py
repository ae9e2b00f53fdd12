"""N-best SentencePiece segmentation and decoding.

A text is normalised as its model says (a space in front, spaces written as U+2581) and becomes a
lattice of vocabulary pieces; a character that is no piece is one edge below all scores and is
written as its UTF-8 bytes' pieces. The score of a segmentation is the sum of its pieces' scores.

No piece crosses into a run of U+2581 or a character outside all pieces, so the lattice falls apart
at these places into chunks, and a text's best segmentations combine its chunks' best ones. For the
distinct chunks of a batch the forward Viterbi scores are computed at once with numpy, and with the
backward ones the loss of each chunk's second-best path. Only the chunks of a text with the least
such losses can differ from their best in its N best; for them a backward A* search, whose
heuristic is the forward score and so exact, gives the chunk's N best paths in order.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.textops import run_hashes

N_BEST = 4
SPACE = "▁"
CHUNK_CHARS = 1 << 22  # characters handled at once; a longer text is handled alone
CACHED_CHUNKS = 300_000  # solved chunks a task keeps; then it starts anew with those of the texts at hand
UNKNOWN_PENALTY = 10.0
_WIDTH = np.int64(1 << 21)  # more than any code point


class Pieces:
    """The vocabulary as a trie: transitions (state, character) and the piece that ends in a state."""

    def __init__(self, pieces: list[tuple[int, str, float]], bytes_ids: list[int]):
        self.text = {i: p for i, p, _ in pieces}
        self.bytes_ids = bytes_ids
        self.bytes_of = {i: p.replace(SPACE, " ").encode("utf-8") for i, p, _ in pieces} | {i: bytes([b]) for b, i in enumerate(bytes_ids)}
        self.n_bytes = np.zeros(max(self.bytes_of) + 1, np.int64)
        self.n_bytes[list(self.bytes_of)] = [len(b) for b in self.bytes_of.values()]
        next_state: dict[tuple[int, int], int] = {}
        ends: list[int] = [-1]
        score = {}
        for i, piece, s in pieces:
            state = 0
            for c in map(ord, piece):
                to = next_state.setdefault((state, c), len(ends))
                if to == len(ends):
                    ends.append(-1)
                state = to
            ends[state] = i
            score[i] = s
        keys = np.array([a * int(_WIDTH) + c for a, c in next_state], np.int64)
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.array(list(next_state.values()), np.int64)[order]
        self.ends = np.array(ends, np.int64)
        self.first = np.zeros(0x110000, np.int64)  # the state after a character, 0 if no piece begins with it
        begin = self.keys < _WIDTH
        self.first[self.keys[begin]] = self.next[begin]
        self.unknown = min(score.values()) - UNKNOWN_PENALTY
        self.score = np.full(max(score) + 1, np.nan)
        self.score[list(score)] = list(score.values())
        self.known = np.zeros(0x110000, bool)
        self.known[[ord(c) for _, p, _ in pieces for c in p]] = True
        inner = [p for _, p, _ in pieces if SPACE in p.lstrip(SPACE)]
        if inner:
            raise ValueError(f"pieces that hold a space inside: {inner[:3]}")

    def edges(self, chars: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All edges (start, stop, piece or -1, score) of ``chars``; ``end``: where each one's chunk ends."""
        at, state, step = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0
        found = []
        single = np.zeros(len(chars), bool)
        while len(at):
            if step == 0:
                to = self.first[chars]
                hit = to > 0
                at, state = at[hit], to[hit]
            else:
                key = state * _WIDTH + chars[at + step]
                j = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[j] == key
                at, state = at[hit], self.next[j[hit]]
            step += 1
            piece = self.ends[state]
            full = piece >= 0
            if step == 1:
                single[at[full]] = True
            found.append((at[full], at[full] + step, piece[full], self.score[piece[full]]))
            on = at + step < end[at]
            at, state = at[on], state[on]
        lone = np.flatnonzero(~single)
        found.append((lone, lone + 1, np.full(len(lone), -1), np.full(len(lone), self.unknown)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def ids(self, path: list[int], chunk: str) -> bytes:
        """Ids (little-endian, 32-bit) of a path; -1 stands for a character and becomes its bytes' pieces."""
        out, at = [], 0
        for piece in path:
            if piece < 0:
                out += [self.bytes_ids[b] for b in chunk[at].encode("utf-8")]
                at += 1
            else:
                out.append(piece)
                at += len(self.text[piece])
        return np.array(out, "<i4").tobytes()

    def decode_chunks(self, ids: list[bytes]) -> list[bytes]:
        """What the ids of each chunk stand for."""
        flat = list(map(self.bytes_of.__getitem__, np.frombuffer(b"".join(ids), "<i4").tolist()))
        ends = np.cumsum([len(i) // 4 for i in ids]).tolist()
        return [b"".join(flat[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def decode_to(self, ids: list[bytes], texts: list[str]) -> bool:
        """Whether the ids of every chunk stand for its text: all bytes in a row, and their number in each chunk."""
        flat = np.frombuffer(b"".join(ids), "<i4")
        whole = "".join(texts).replace(SPACE, " ")
        if b"".join(map(self.bytes_of.__getitem__, flat.tolist())) != whole.encode():
            return False
        chars = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        widths = 1 + (chars > 0x7F).astype(np.int64) + (chars > 0x7FF) + (chars > 0xFFFF)
        ends = [np.cumsum(np.array(n, np.int64)) for n in ([len(i) // 4 for i in ids], [len(t) for t in texts])]
        at = [np.concatenate([[0], np.cumsum(n)])[e] for n, e in zip((self.n_bytes[flat], widths), ends, strict=True)]
        return np.array_equal(*at)

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: bytes of byte pieces, spaces for U+2581, the space in front dropped."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8")[1:]


@lru_cache(maxsize=2)
def load_pieces(model: str) -> Pieces:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    own = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
    by_byte = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if sp.is_byte(i)}
    return Pieces([(i, sp.id_to_piece(i), sp.get_score(i)) for i in own], [by_byte[f"<0x{b:02X}>"] for b in range(256)])


def _best_into(n: int, source: np.ndarray, target: np.ndarray, score: np.ndarray, order_key: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Viterbi over all chunks at once: best score of each place from the places ``start``, and the
    edge it comes by. ``order_key``: the target's distance from its chunk's start; edges are taken in
    that order, so a source is final before it is used."""
    order = np.argsort((order_key << 40) | target, kind="stable")
    source, target, score, steps = source[order], target[order], score[order], order_key[order]
    best = np.full(n, -np.inf)
    best[start] = 0.0
    by = np.full(n, -1)
    cuts = np.flatnonzero(np.diff(steps)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(steps)], strict=True):
        if a == b:
            continue
        value = best[source[a:b]] + score[a:b]
        first = np.flatnonzero(np.concatenate([[True], np.diff(target[a:b]) != 0]))
        top = np.maximum.reduceat(value, first)
        groups = np.repeat(np.arange(len(first)), np.diff(np.append(first, b - a)))
        at = np.flatnonzero(value == top[groups])
        at = at[np.concatenate([np.diff(groups[at]) != 0, [True]])]  # ties: the longest piece
        best[target[a:b][first]] = top
        by[target[a:b][first]] = order[a:b][at]
    return best, by


class Lattice:
    """The lattices of some chunks: places of all chunks in a row, each with one more for its end."""

    def __init__(self, pieces: Pieces, chars: np.ndarray, lengths: np.ndarray):
        self.lengths = lengths
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        chunk = np.repeat(np.arange(len(lengths)), lengths)
        a, b, self.piece, self.score = pieces.edges(chars, (begin + lengths)[chunk])
        own = chunk[a]
        self.start, self.stop, n = a + own, b + own, int(lengths.sum()) + len(lengths)
        self.first = begin + np.arange(len(lengths))
        self.last = self.first + lengths
        self.forward, self.by = _best_into(n, self.start, self.stop, self.score, b - begin[own], self.first)
        backward, _ = _best_into(n, self.stop, self.start, self.score, lengths[own] - (a - begin[own]), self.last)
        loss = self.forward[self.last][own] - (self.forward[self.start] + self.score + backward[self.stop])
        on_best = np.zeros(len(a), bool)
        self.pieces_of: list[tuple[np.ndarray, np.ndarray]] = []  # (chunk, piece), from the last piece on
        at, who = self.last.copy(), np.arange(len(lengths))
        while len(at):
            edge = self.by[at]
            on_best[edge] = True
            self.pieces_of.append((who, self.piece[edge]))
            at = self.start[edge]
            more = at > self.first[who]
            at, who = at[more], who[more]
        self.second = np.full(len(lengths), np.inf)  # loss of the second-best path
        others = np.flatnonzero(~on_best)
        np.minimum.at(self.second, own[others], np.maximum(loss[others], 0))
        self.by_stop = None

    def best_paths(self) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all best paths, and each chunk's bounds among them."""
        who = np.concatenate([w for w, _ in reversed(self.pieces_of)] or [np.zeros(0, np.int64)])
        piece = np.concatenate([p for _, p in reversed(self.pieces_of)] or [np.zeros(0, np.int64)])
        bounds = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(self.lengths)))])
        return piece[np.argsort(who, kind="stable")], bounds

    def n_best(self, chunk: int, n: int) -> list[tuple[float, list[int]]]:
        """The chunk's ``n`` best paths (score, pieces): A* from its end, the forward score being the
        exact rest. Ties: in the order of the pieces from the end."""
        if self.by_stop is None:
            self.by_stop = np.argsort(self.stop, kind="stable")
            self.sorted_stop = self.stop[self.by_stop]
        found: list[tuple[float, list[int]]] = []
        heap = [(-self.forward[self.last[chunk]], (), 0.0, int(self.last[chunk]))]
        while heap and len(found) < n:
            _, path, gained, place = heapq.heappop(heap)
            if place == self.first[chunk]:
                found.append((gained, list(path[::-1])))
                continue
            a, b = np.searchsorted(self.sorted_stop, [place, place + 1])
            for e in self.by_stop[a:b]:
                to, more = int(self.start[e]), gained + float(self.score[e])
                heapq.heappush(heap, (-(more + self.forward[to]), (*path, int(self.piece[e])), more, to))
        return found


def _chunk_bounds(pieces: Pieces, chars: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of chunks: before a run of spaces and around characters that are in no piece."""
    space = chars == ord(SPACE)
    known = pieces.known[chars]
    cut = np.ones(len(chars), bool)
    cut[1:] = (space[1:] & ~space[:-1]) | ~known[1:] | ~known[:-1]
    cut[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(cut)


def _schema(digests: bool) -> tuple[str, list[str]]:
    ids = "ids_crc32 array<bigint>" if digests else "ids array<binary>"
    schema = f"doc_id bigint, n_pieces bigint, n_segmentations int, scores array<double>, {ids}, round_trip boolean"
    return schema, [x.split()[0] for x in schema.split(", ")]


def _segment(model: str, n_best: int, digests: bool):
    def texts_at_once(column: pa.Array) -> Iterator[list[str]]:
        held, size = [], 0
        for text in column:
            text = text.as_py() or ""
            held.append(text)
            size += len(text)
            if size >= CHUNK_CHARS:
                yield held
                held, size = [], 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = load_pieces(model), {}
        for batch in batches:
            at = 0
            for texts in texts_at_once(batch.column(1)):
                docs = batch.column(0).slice(at, len(texts))
                at += len(texts)
                yield _segment_some(pieces, known, docs, texts, n_best, digests)
    return run


class Chunk:
    """A chunk's best ids, score, loss of its second-best path and, once asked for, its best paths; and whether its
    ids decode to its text."""

    __slots__ = ("text", "ids", "score", "second", "best", "whole")

    def __init__(self, text: str, ids: bytes, score: float, second: float):
        self.text, self.ids, self.score, self.second, self.best, self.whole = text, ids, score, second, None, True


def _lattice_of(pieces: Pieces, texts: list[str]) -> Lattice:
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    return Lattice(pieces, chars, np.array([len(t) for t in texts], np.int64))


def _solve(pieces: Pieces, texts: list[str]) -> list[Chunk]:
    lattice = _lattice_of(pieces, texts)
    ids, bounds = lattice.best_paths()
    data = ids.astype("<i4").tobytes()
    best = lattice.forward[lattice.last].tolist()
    out = [Chunk(t, data[4 * a:4 * b], s, o) for t, a, b, s, o in zip(
        texts, bounds.tolist(), bounds[1:].tolist(), best, lattice.second.tolist(), strict=False)]
    for c in np.unique(np.searchsorted(bounds, np.flatnonzero(ids < 0), "right") - 1).tolist():
        out[c].ids = pieces.ids(ids[bounds[c]:bounds[c + 1]].tolist(), texts[c])
    if not pieces.decode_to([c.ids for c in out], texts):
        for c in out:
            c.whole = pieces.decode_chunks([c.ids]) == [c.text.replace(SPACE, " ").encode()]
    return out


def _find_best(pieces: Pieces, chunks: list[Chunk], n_best: int) -> None:
    """Fill in ``best``, (loss, ids) of the best paths, of chunks that lack it."""
    chunks = [c for c in chunks if c.best is None]
    if chunks:
        lattice = _lattice_of(pieces, [c.text for c in chunks])
        for k, c in enumerate(chunks):
            c.best = [(c.score - s, pieces.ids(p, c.text)) for s, p in lattice.n_best(k, n_best)]


def _least_sums(options: list[list[tuple[float, bytes]]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` least sums of one loss of each option, with the choices; ties: by the choices."""
    if not options:
        return [(0.0, ())]
    total = np.zeros(())
    for o in options:
        total = total[..., None] + np.array([loss for loss, _ in o])
    flat = total.ravel()
    top = np.argsort(flat, kind="stable")[:n]
    return [(float(flat[t]), tuple(int(i) for i in np.unravel_index(t, total.shape))) for t in top]


def _segment_some(pieces: Pieces, known: dict[int, Chunk], docs: pa.Array, texts: list[str], n_best: int, digests: bool) -> pa.RecordBatch:
    normal = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
    whole = "".join(normal)
    chars = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in normal])]).astype(np.int64)
    begins = _chunk_bounds(pieces, chars, bounds)
    ends = np.append(begins[1:], len(chars)) if len(begins) else begins
    which, distinct = pd.factorize(run_hashes(chars, begins, ends))
    first = np.full(len(distinct), len(which), np.int64)
    np.minimum.at(first, which, np.arange(len(which)))
    keys = distinct.tolist()
    if len(known) + len(keys) > CACHED_CHUNKS:
        used = {key: known[key] for key in keys if key in known}
        known.clear()
        known.update(used)
    new = [c for c, key in enumerate(keys) if key not in known]
    places = zip(begins[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
    for c, chunk in zip(new, _solve(pieces, [whole[a:b] for a, b in places]) if new else [], strict=True):
        known[keys[c]] = chunk
    chunks = [known[key] for key in keys]
    best_ids = np.empty(len(chunks), object)
    best_ids[:] = [c.ids for c in chunks]
    whole_chunk = np.array([c.whole for c in chunks], bool)
    score = np.array([c.score for c in chunks])
    second = np.array([c.second for c in chunks])
    chunk_at = np.searchsorted(begins, bounds)
    owns, fews = [], []
    for k in range(len(texts)):
        own = which[chunk_at[k]:chunk_at[k + 1]]
        loss = second[own]
        least = np.argpartition(loss, n_best - 2)[:n_best - 1] if len(own) >= n_best and n_best > 1 else np.arange(len(own))[:n_best - 1]
        limit = loss[least].max() if len(least) else 0
        # of equal losses the first places count
        few = np.flatnonzero(loss <= limit)
        few = few[np.argsort(loss[few], kind="stable")][:n_best - 1]
        owns.append(own)
        fews.append(np.sort(few[np.isfinite(loss[few])]).tolist())
    wanted = {int(own[i]) for own, few in zip(owns, fews, strict=True) for i in few}
    _find_best(pieces, [chunks[c] for c in sorted(wanted)], n_best)
    rows: list[tuple] = []
    for text, own, few in zip(texts, owns, fews, strict=True):
        ids = best_ids[own].tolist()
        options = [chunks[own[i]].best for i in few]
        # between the chunks that can differ all segmentations are the same
        parts = [b"".join(ids[a + 1:b]) for a, b in zip([-1, *few], [*few, len(ids)], strict=True)]
        out, scores, total, count = [], [], float(score[own].sum()), 0
        for loss, pick in _least_sums(options, n_best):
            joined = b"".join([parts[0], *(x for o, j, p in zip(options, pick, parts[1:], strict=True) for x in (o[j][1], p))])
            out.append(zlib.crc32(joined) if digests else joined)
            scores.append(total - loss)
            count = count or len(joined) // 4
        # U+2581 in a text becomes a space; the chunks that can differ are decoded in their best form
        kept = SPACE not in text and bool(whole_chunk[own].all()) and pieces.decode_chunks([o[0][1] for o in options]) == [
            chunks[own[i]].text.replace(SPACE, " ").encode() for i in few]
        rows.append((count, len(out), scores, out, kept))
    kinds = [pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.int64() if digests else pa.binary()), pa.bool_()]
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([docs, *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=_schema(digests)[1])


def segment_documents(documents: DataFrame, model: str, n_best: int = N_BEST, digests: bool = False) -> DataFrame:
    """The ``n_best`` best segmentations of every row of ``documents`` (doc_id, text), best first: doc_id,
    n_pieces (of the best), n_segmentations, scores, ids (little-endian signed 32-bit, one binary a
    segmentation, or ids_crc32, their checksums, with ``digests``), round_trip (decoding the best gives
    the text; a text that itself holds U+2581 gets spaces for it, as in SentencePiece).

    Null or empty text: one segmentation, of no pieces. Ties of whole texts go to the smaller change
    at the first place they differ. Null doc_ids and repeated rows are rows like any other; extra
    columns are ignored; texts may be of any length; an empty table gives no rows."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_segment(model, n_best, digests), _schema(digests)[0])


def op10_n_best_segmentation(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return segment_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), digests=True)
