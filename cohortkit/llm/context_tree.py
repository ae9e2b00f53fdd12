"""Context-tree weighting over bytes: code lengths of texts under a model of the training texts.

A byte is decomposed into eight binary decisions. Every context of 0 to DEPTH preceding bytes and
every prefix of the byte is a node with the training counts a (zeros) and b (ones), whose
Krichevsky-Trofimov estimate is Pe(a, b); the weighted probability of a node is
Pw = (Pe + product of its children's Pw) / 2, children having one more byte of context. The
probability of a bit mixes the estimates along its context path with the weights that follow.

Scale: texts are dealt to blocks of some BLOCK_BYTES by a hash. A block reports its distinct words and
(DEPTH + 1)-grams with their training counts; their totals give the model, tree by tree in shards
that share the last two context bytes; and the block gets back the values of its own words and
grams only. So neither the vocabulary nor the tree is ever held whole by a task or the driver; the
driver sees the nodes of contexts of at most one byte (65,535).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.memory import give_back
from cohortkit.llm.tables import Stages
from cohortkit.llm.textops import Texts, text_chunks

DEPTH = 5
BLOCK_BYTES = 24 << 20
SHARD_GRAMS = 60_000
HELD_KEYS = 500_000  # keys of several chunks a task holds before it adds them up, or twice those that are left then
END = 0xFF  # not a UTF-8 byte: stands before every text (context) and after it (symbol)
GRAM, WORD = 0, 1
LOG_HALF = np.log(0.5)


def grams(texts: Texts, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text and its end: the byte below its ``depth`` context bytes, as one
    number; and the texts' bounds among them."""
    pad = depth + 1
    starts = texts.bounds[:-1] + pad * np.arange(len(texts))
    padded = np.full(len(texts.data) + pad * len(texts), END, np.uint8)
    lengths = np.diff(texts.bounds)
    padded[np.arange(len(texts.data)) + np.repeat(pad * np.arange(len(texts)) + depth, lengths)] = texts.data
    out = np.zeros(len(padded), np.uint64)
    for d in range(depth, -1, -1):
        out[d:] = (out[d:] << np.uint64(8)) | padded[:len(padded) - d]
    real = np.ones(len(padded), bool)
    for d in range(depth):
        real[starts + d] = False
    bounds = texts.bounds + np.arange(len(texts) + 1)
    return out[real], bounds


def _counted(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    where, distinct = pd.factorize(np.concatenate(keys))
    return distinct, np.bincount(where, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)


VOCABULARY = "block bigint, kind int, key bigint, n bigint"


def _vocabulary(depth: int):
    def run(table: pa.Table) -> pa.Table:
        give_back()  # what earlier groups held
        train = ~table["held_out"].combine_chunks().to_numpy(zero_copy_only=False)
        parts: dict[int, tuple[list, list]] = {GRAM: ([], []), WORD: ([], [])}
        for a, b, texts in text_chunks(table["text"]):
            symbols, bounds = grams(texts, depth)
            for kind, keys, ends in ((GRAM, symbols, bounds), (WORD, texts.word_hashes(), texts.first_word)):
                where, distinct = pd.factorize(keys)
                weight = np.repeat(train[a:b], np.diff(ends)).astype(np.float64)
                parts[kind][0].append(distinct)
                parts[kind][1].append(np.bincount(where, weights=weight, minlength=len(distinct)))
                if sum(map(len, parts[kind][0])) > max(HELD_KEYS, 2 * len(parts[kind][0][0])):  # the first: those added up before
                    key, n = _counted(*parts[kind])
                    parts[kind] = ([key], [n])
        give_back()
        out = []
        for kind, (keys, counts) in parts.items():
            key, n = _counted(keys, counts)
            out.append(pa.table({"block": np.full(len(key), table["block"][0].as_py()), "kind": np.full(len(key), kind, np.int32), "key": key.view(np.int64), "n": n}))
        return pa.concat_tables(out)
    return run


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for x > 0 (Stirling's series from 8 on)."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift = np.where(low, shift + np.log(np.where(low, y, 1)), shift)
        y = np.where(low, y + 1, y)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7) - shift


# log gamma of n + 0.5 and of n + 1 for counts n below TABLE; most counts are small
TABLE = 1 << 12
HALF, ONE = (log_gamma(np.arange(TABLE) + shift) for shift in (0.5, 1.0))


def _log_gamma_of_counts(n: np.ndarray, table: np.ndarray, shift: float) -> np.ndarray:
    out = table[np.minimum(n, TABLE - 1).astype(np.int64)]
    large = np.flatnonzero(n >= TABLE)
    out[large] = log_gamma(n[large] + shift)
    return out


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov estimate of a zeros and b ones (whole numbers)."""
    return _log_gamma_of_counts(a, HALF, 0.5) + _log_gamma_of_counts(b, HALF, 0.5) - _log_gamma_of_counts(a + b, ONE, 1.0) - np.log(np.pi)


class Level:
    """Nodes of one depth: key (context bytes above the prefix of the next byte), a, b, log Pw, the
    weight of the node's own estimate, and each deeper node's place among them."""

    def __init__(self, key, a, b, below=None):
        self.key, self.a, self.b = key, a, b
        own = log_kt(a, b)
        self.log_pw = own if below is None else np.logaddexp(LOG_HALF + own, LOG_HALF + below)
        self.weight = np.ones(len(a)) if below is None else np.exp(LOG_HALF + own - self.log_pw)
        self.one = (b + 0.5) / (a + b + 1)


def _grouped(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    where, distinct = pd.factorize(key)
    return distinct, where, [np.bincount(where, weights=v, minlength=len(distinct)) for v in values]


def _shorter(key: np.ndarray, depth: int) -> np.ndarray:
    """Keys without their oldest context byte, leaving ``depth`` of them."""
    return key & np.uint64((1 << (8 * (depth + 1))) - 1)


def _bits(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(grams, 8) node keys at full depth, and the bits."""
    x = gram & np.uint64(255)
    j = np.arange(8, dtype=np.uint64)
    prefix = (np.uint64(1) << j) | (x[:, None] >> (np.uint64(8) - j))
    return ((gram >> np.uint64(8)) << np.uint64(8))[:, None] | prefix, ((x[:, None] >> (np.uint64(7) - j)) & np.uint64(1)).astype(bool)


def _tree(gram: np.ndarray, n: np.ndarray, depth: int, top: int) -> tuple[dict[int, Level], dict[int, np.ndarray], np.ndarray, np.ndarray]:
    """Levels ``depth`` down to ``top`` of the grams' nodes; where[d]: place of level d + 1's nodes in
    level d; the grams' places at full depth, and their bits."""
    keys, bits = _bits(gram)
    times = np.repeat(n.astype(np.float64)[:, None], 8, axis=1)
    key, place, (a, b) = _grouped(keys.ravel(), np.where(bits, 0, times).ravel(), np.where(bits, times, 0).ravel())
    levels, where = {depth: Level(key, a, b)}, {}
    for d in range(depth - 1, top - 1, -1):
        child = levels[d + 1]
        key, where[d], (a, b, below) = _grouped(_shorter(child.key, d), child.a, child.b, child.log_pw)
        levels[d] = Level(key, a, b, below)
    return levels, where, place.reshape(-1, 8), bits


def _top_sums(depth: int):
    """What the nodes of one context byte need of a shard: sums of a, b and log Pw of their children."""
    def run(table: pa.Table) -> pa.Table:
        level = _tree(table["key"].to_numpy().view(np.uint64), table["n"].to_numpy(), depth, 2)[0][2]
        key, _, (a, b, below) = _grouped(_shorter(level.key, 1), level.a, level.b, level.log_pw)
        give_back()
        return pa.table({"key": key.view(np.int64), "a": a, "b": b, "below": below})
    return run


def _down(level: Level, rest: np.ndarray, done: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mass left, and probability of a one gathered, after the nodes of ``level``."""
    return rest * (1 - level.weight), done + rest * level.weight * level.one


def _code_lengths(depth: int, top_key: np.ndarray, top_rest: np.ndarray, top_done: np.ndarray):
    """log10 of the probability of each gram's byte after its context."""
    def run(table: pa.Table) -> pa.Table:
        gram = table["key"].to_numpy().view(np.uint64)
        levels, where, place, bits = _tree(gram, table["n"].to_numpy(), depth, 2)
        above = np.searchsorted(top_key, _shorter(levels[2].key, 1))
        rest, done = top_rest[above], top_done[above]
        for d in range(2, depth):
            rest, done = _down(levels[d], rest, done)
            rest, done = rest[where[d]], done[where[d]]
        one = (done + rest * levels[depth].one)[place]
        value = np.log10(np.where(bits, one, 1 - one)).sum(axis=1)
        del levels, where, place, bits, one, rest, done, above
        give_back()
        return pa.table({"key": table["key"], "value": value})
    return run


def train_tree(stages: Stages, counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, value): log10 probability of every (depth + 1)-gram's last byte given the others, from
    ``counts`` (key, n). Grams of count 0 are scored too; a context never trained gives 1/2 a bit."""
    if not 2 <= depth <= 6:
        raise ValueError("depth must be 2 to 6 bytes")
    counts = stages.put("grams", counts)
    stages.drop()
    shards = max(1, -(-counts.count() // SHARD_GRAMS))
    shard = F.pmod(F.xxhash64(F.shiftrightunsigned("key", 8).bitwiseAND(0xFFFF)), F.lit(shards)).alias("shard")
    dealt = counts.select(shard, "key", "n").groupBy("shard")
    sums = dealt.applyInArrow(lambda t: _top_sums(depth)(t), "key bigint, a double, b double, below double")
    top = sums.groupBy("key").agg(F.sum("a"), F.sum("b"), F.sum("below")).orderBy("key").toArrow()  # 65,280 rows at most
    stages.drop()  # shuffle files of the ended jobs
    if not top.num_rows:
        return counts.select("key", F.lit(0.0).alias("value"))
    key = top.column(0).to_numpy().view(np.uint64)
    one = Level(key, *(top.column(i).to_numpy() for i in (1, 2)), top.column(3).to_numpy())
    key0, where, (a, b, below) = _grouped(_shorter(key, 0), one.a, one.b, one.log_pw)
    zero = Level(key0, a, b, below)
    rest, done = _down(zero, np.ones(len(key0)), np.zeros(len(key0)))
    rest, done = _down(one, rest[where], done[where])
    return dealt.applyInArrow(lambda t: _code_lengths(depth, key, rest, done)(t), "key bigint, value double")


SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, log_counts double, score double, new_words bigint, train_tokens bigint"


def _score(depth: int):
    def run(docs: pa.Table, values: pa.Table) -> pa.Table:
        n = docs.num_rows
        kind, key, value = (values[c].to_numpy() for c in ("kind", "key", "value"))
        lookup = {}
        for one in (GRAM, WORD):
            keys = key[kind == one].view(np.uint64)
            order = np.argsort(keys)
            lookup[one] = (keys[order], value[kind == one][order])
        new_words = int((values["first"].to_numpy(zero_copy_only=False) & (value > 0) & (kind == WORD)).sum())
        del kind, key, value, keys, order

        def found(one: int, keys: np.ndarray) -> np.ndarray:
            where, distinct = pd.factorize(keys)
            known, own = lookup[one]
            at = np.searchsorted(known, distinct)
            if len(distinct) and (at.max() >= len(known) or (known[at] != distinct).any()):
                raise ValueError("a block lacks values of its own words or grams")
            return own[at][where]

        train = ~docs["held_out"].combine_chunks().to_numpy(zero_copy_only=False)
        tokens, known, logs, score = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        for a, b, texts in text_chunks(docs["text"]):
            symbols, bounds = grams(texts, depth)
            score[a:b] = np.add.reduceat(found(GRAM, symbols), bounds[:-1])
            c = np.append(found(WORD, texts.word_hashes()), 0.0)
            sums = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[texts.first_word])  # noqa: E731, B023
            tokens[a:b] = np.diff(texts.first_word)
            known[a:b] = sums(c[:-1] > 0)
            full = np.flatnonzero(tokens[a:b])
            if len(full):
                logs[a + full] = np.add.reduceat(np.log10(c[:-1] + 1), texts.first_word[:-1][full])
        new = np.zeros(n, np.int64)
        if n:
            new[0] = new_words
        lookup.clear()
        give_back()
        return pa.table({"doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": tokens + 1, "n_known": known, "log_counts": logs,
                         "score": score, "new_words": new, "train_tokens": np.where(train, tokens + 1, 0)})
    return run


def score_documents(stages: Stages, documents: DataFrame, held_out, depth: int = DEPTH) -> DataFrame:
    """Scores of every row of ``documents`` (doc_id, text) under a model of those not ``held_out``.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (words with add-one
    counts) and score (log10 probability of the text's bytes and its end under the context tree).
    Null text: empty, an end alone. Null
    ``held_out``: training. Repeated rows train and are scored each. Words are known by 64-bit hashes.
    Extra columns are ignored; an empty table gives no rows."""
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, -(-size // BLOCK_BYTES)))))
    vocabulary = stages.put("vocabulary", docs.groupBy("block").applyInArrow(lambda t: _vocabulary(depth)(t), VOCABULARY))
    stages.drop()  # the texts' shuffle; the blocks' texts are brought together again for their scores
    by_key = Window.partitionBy("key")
    words = vocabulary.where(F.col("kind") == WORD).select(
        "block", "kind", "key", F.sum("n").over(by_key).cast("double").alias("value"),
        (F.row_number().over(by_key.orderBy("block")) == 1).alias("first"))
    own = vocabulary.where(F.col("kind") == GRAM)
    tree = train_tree(stages, own.groupBy("key").agg(F.sum("n").alias("n")), depth)
    own = own.select("block", "kind", "key").join(tree, "key").select("block", "kind", "key", "value", F.lit(False).alias("first"))
    scored = docs.groupBy("block").cogroup(words.unionByName(own).groupBy("block")).applyInArrow(lambda d, v: _score(depth)(d, v), SCORES)
    scored = stages.put("scored", scored)
    total = scored.agg(F.sum("train_tokens"), F.sum("new_words"), F.sum(F.expr("CAST(train_tokens > 0 AS BIGINT)"))).first()
    n, words_known, ends = (x or 0 for x in total)
    distinct = words_known + (1 if ends else 0)
    logs = F.col("log_counts") + float(np.log10(ends + 1)) - F.col("n_tokens") * float(np.log10(n + distinct + 1))
    return scored.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + (1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), logs.alias("base_score"), "score")


def op4_context_tree(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7
    return score_documents(Stages(spark), docs, part == 2)
