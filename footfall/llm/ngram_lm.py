"""Interpolated modified Kneser-Ney language model (order 2), counted in
Spark, kept as sorted hash arrays that workers map into memory.

Counting: each task reduces its words to distinct pairs (context, word) with
counts, cut by the range of the pair's hash into shards and packed as one
compressed block a shard, so what is shuffled is pre-aggregated.  A shard's
blocks are merged into one sorted array of pair hashes with an array of
counts beside it, written to the folder that all executors share, and reduced
again to what each word needs (count, distinct words before, distinct words
after by count).  These are merged by the word's hash range in the same way.
Shards grow in number with the text, never in size; a word on a third of all
tokens is split over all shards.

Scoring: workers map the arrays and look up the distinct pairs of a batch in
order.  Words and pairs are known by 64-bit hashes.  The shared folder must
be a file system that workers can map (a local path or file: address).

Defined results: a null text is an empty text (one token, its end); a null
doc_id counts as the empty text in the hold-out rule; repeated rows count and
score as often as they occur; very long texts go through in one piece; an
empty training set gives every token probability 1; extra columns are
ignored.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import id_text, scratch_path, stored, table

BYTES_PER_SHARD = 24_000_000     # text behind one shard
LEAST_SHARDS = 32                # for parallel work on a smaller text
CHUNK_TOKENS = 2_500_000         # tokens reduced at once by a counting task
SCORE_TOKENS = 500_000           # tokens looked up at once

START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_U64 = np.uint64


def token_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words (runs without ASCII white space, A-Z lower
    case), then the end."""
    words = text.encode("utf-8").lower().split()
    out = np.empty(len(words) + 1, _U64)
    out[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U64, len(words))
    out[-1] = END
    return out


def contexts(words: np.ndarray) -> np.ndarray:
    """The word before each token of one text."""
    return np.concatenate([[START], words[:-1]])


def pair_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (context ^ (context >> _U64(29))) * _U64(0xBF58476D1CE4E5B9) + word * _U64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U64(32))) * _U64(0x94D049BB133111EB)
        return x ^ (x >> _U64(29))


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Range of a hash; ranges are in hash order."""
    return ((h >> _U64(32)) * _U64(shards) >> _U64(32)).astype(np.int64)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte planes apart, compressed."""
    planes = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays)
    return len(arrays[0]).to_bytes(8, "little") + zstandard.compress(planes, 1)


def _unpacked(blob: bytes, *dtypes) -> list[np.ndarray]:
    n, raw = int.from_bytes(blob[:8], "little"), zstandard.decompress(blob[8:]) if len(blob) > 8 else b""
    out, at = [], 0
    for t in dtypes:
        width = np.dtype(t).itemsize
        plane = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(plane.T).view(t).reshape(n))
        at += n * width
    return out


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and the sums of each value array."""
    if not len(keys):
        return keys, *values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], *(np.add.reduceat(v[order], first, dtype=np.int64) for v in values)


def _pair_blocks(context: np.ndarray, word: np.ndarray, shards: int) -> Iterator[tuple[int, bytes]]:
    """A block for each shard: the distinct words of its pairs (sorted), then
    each pair as two places in that list, with its count."""
    g = pair_hash(context, word)
    order = np.argsort(g, kind="stable")
    g = g[order]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(g))).astype(np.uint32)
    context, word, where = context[order[first]], word[order[first]], shard_of(g[first], shards)
    edges = np.searchsorted(where, np.arange(shards + 1))
    for s in range(shards):
        a, b = edges[s], edges[s + 1]
        if a < b:
            names, place = np.unique(np.concatenate([context[a:b], word[a:b]]), return_inverse=True)
            place = place.astype(np.uint32)
            left, right = place[:b - a], place[b - a:]
            by = np.lexsort((right, left))
            pairs = _packed(left[by], right[by], count[a:b][by])
            yield s, len(pairs).to_bytes(8, "little") + pairs + _packed(names)


def _block_pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    left, right, count = _unpacked(blob[8:8 + n], np.uint32, np.uint32, np.uint32)
    names, = _unpacked(blob[8 + n:], _U64)
    return names[left], names[right], count.astype(np.int64)


def local_path(uri: str) -> str:
    """The path behind a shared folder's address."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{uri}: the model's folder must be one that workers can map into memory")
    return unquote(parts.path) if parts.scheme else uri


def _save(path: str, array: np.ndarray) -> None:
    """Whole or not at all, the same whichever attempt writes it."""
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        np.save(f, array)
    os.replace(part, path)


@dataclass(frozen=True)
class Discounts:
    """Discounts for counts 1, 2 and 3 or more, from the numbers of items
    seen 1 to 4 times."""
    d: tuple[float, float, float]

    @staticmethod
    def of(n1: int, n2: int, n3: int, n4: int) -> Discounts:
        n = (n1, n2, n3, n4)
        if min(n[:3]) == 0:
            return Discounts((0.5, 0.75, 0.9))          # too few items to estimate from
        y = n1 / (n1 + 2 * n2)
        return Discounts(tuple(min(k, max(0.05, k - (k + 1) * y * n[k] / n[k - 1])) for k in (1, 2, 3)))

    def at(self, counts: np.ndarray) -> np.ndarray:
        return np.array((0.0, *self.d))[np.minimum(counts, 3).astype(np.int64)]


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the totals; small whatever the text."""
    path: str
    shards: int
    tokens: int              # training tokens, ends included
    words: int               # distinct ones
    pairs: int               # distinct pairs
    pair_discounts: Discounts
    word_discounts: Discounts
    word_backoff: float      # share of the uniform distribution


_WORD_FIELDS = ("word", "count", "before", "after1", "after2", "after3")


def train(texts: DataFrame, shards: int | None = None) -> Model:
    """Count ``text`` of all rows and write the arrays."""
    spark = texts.sparkSession
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    shards = shards or max(LEAST_SHARDS, -(-size // BYTES_PER_SHARD))
    path = local_path(scratch_path(spark, "ngram-lm"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def blocks():
            rows = list(_pair_blocks(np.concatenate([contexts(w) for w in held]), np.concatenate(held), shards))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                               pa.array([r[1] for r in rows], pa.binary())], names=["shard", "block"])

        for batch in batches:
            for text in batch.column(0):
                w = token_hashes(text.as_py())
                held.append(w)
                n += len(w)
                if n >= CHUNK_TOKENS:
                    yield blocks()
                    held, n = [], 0
        if n:
            yield blocks()

    def merge_pairs(group: pa.Table) -> pa.Table:
        os.makedirs(path, exist_ok=True)
        shard = group.column("shard")[0].as_py()
        context, word, n = (np.concatenate(x) for x in zip(
            *(_block_pairs(b.as_py()) for b in group.column("block")), strict=True))
        g = pair_hash(context, word)
        order = np.argsort(g, kind="stable")
        g, n = g[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        g, n = g[first], np.add.reduceat(n, first)
        context, word = context[order[first]], word[order[first]]
        n_pairs = len(g)
        _save(f"{path}/pair-{shard}.npy", g)
        _save(f"{path}/pair-count-{shard}.npy", n.astype(np.uint32) if n.max() < 2 ** 32 else n)
        times = [int((n == k).sum()) for k in (1, 2, 3, 4)]
        after = _sums(context, n == 1, n == 2, n >= 3, n)
        as_word = _sums(word, n, np.ones(len(n), bool))
        del context, word, n
        words = np.union1d(after[0], as_word[0])
        data = np.zeros((6, len(words)), np.int64)
        data[:2, np.searchsorted(words, as_word[0])] = as_word[1:]
        data[2:, np.searchsorted(words, after[0])] = after[1:]
        where = shard_of(words, shards)
        edges = np.searchsorted(where, np.arange(shards + 1))
        rows = [(s, _packed(words[a:b], *data[:, a:b])) for s, a, b in zip(range(shards), edges, edges[1:]) if a < b]
        return pa.table({"shard": pa.array([r[0] for r in rows] + [-1], pa.int32()),
                         "block": pa.array([r[1] for r in rows] + [None], pa.binary()),
                         "totals": pa.array([None] * len(rows) + [[n_pairs, *times]], pa.list_(pa.int64()))})

    def merge_words(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        parts = [_unpacked(b.as_py(), _U64, *[np.int64] * 6) for b in group.column("block")]
        words, total, before, a1, a2, a3, as_context = _sums(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        _save(f"{path}/word-{shard}.npy", words)
        _save(f"{path}/word-data-{shard}.npy", np.column_stack([total, before, a1, a2, a3, as_context]))
        seen = total > 0                                   # not the start, which is a context only
        times = [int((before == k).sum()) for k in (1, 2, 3, 4)]
        return pa.table({"totals": pa.array([[int(total.sum()), int(seen.sum()), *times, int((before >= 3).sum())]],
                                            pa.list_(pa.int64()))})

    blocks = texts.mapInArrow(count, "shard int, block binary")
    merged = stored(blocks.groupBy("shard").applyInArrow(
        merge_pairs, "shard int, block binary, totals array<bigint>"), "ngram-words")
    by_word = stored(merged.where("shard >= 0").select("shard", "block").groupBy("shard").applyInArrow(
        merge_words, "totals array<bigint>"), "ngram-totals")
    # one short row a shard, summed in Spark
    total = lambda df, n: [x or 0 for x in df.agg(*(F.sum(F.col("totals")[k]) for k in range(n))).first()]
    pairs, *pair_times = total(merged.where("shard < 0"), 5)
    tokens, words, *rest = total(by_word, 7)
    word_times, three = rest[:4], rest[4]
    wd = Discounts.of(*word_times)
    spare = wd.d[0] * word_times[0] + wd.d[1] * word_times[1] + wd.d[2] * three
    return Model(path, shards, tokens, words, pairs, Discounts.of(*pair_times), wd, spare / pairs if pairs else 1.0)


class Scorer:
    """Looks tokens up in the mapped arrays."""

    def __init__(self, model: Model):
        self.m = model
        self.maps: dict[str, np.ndarray | None] = {}

    def _map(self, name: str) -> np.ndarray | None:
        if name not in self.maps:
            path = f"{self.m.path}/{name}.npy"
            self.maps[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
        return self.maps[name]

    def _find(self, kind: str, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For sorted keys: (shard, which keys were found, their places)."""
        edges = np.searchsorted(shard_of(keys, self.m.shards), np.arange(self.m.shards + 1))
        for s in range(self.m.shards):
            a, b = int(edges[s]), int(edges[s + 1])
            known = self._map(f"{kind}-{s}") if a < b else None
            if known is None:
                continue
            at = np.searchsorted(known, keys[a:b])
            hit = np.flatnonzero(known[np.minimum(at, len(known) - 1)] == keys[a:b])
            yield s, a + hit, at[hit]

    def words(self, keys: np.ndarray) -> np.ndarray:
        """Rows of word data for sorted keys; zeros where unknown."""
        out = np.zeros((len(keys), len(_WORD_FIELDS)), np.int64)
        for s, which, at in self._find("word", keys):
            out[which] = self._map(f"word-data-{s}")[at]
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        for s, which, at in self._find("pair", keys):
            out[which] = self._map(f"pair-count-{s}")[at]
        return out

    def log10(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(model's log10 probability, training count) of each token."""
        m = self.m
        names, place = np.unique(np.concatenate([context, word]), return_inverse=True)
        data = self.words(names)
        ctx, own = place[:len(context)], place[len(context):]
        count, before = data[:, 0], data[:, 1]
        uniform = 1.0 / (m.words + 1)
        if m.pairs == 0:
            return np.full(len(word), np.log10(uniform)), count[own]
        base = np.maximum(before - m.word_discounts.at(before), 0) / m.pairs + m.word_backoff * uniform
        as_context = data[:, 5]
        d = m.pair_discounts.d
        backoff = np.where(as_context > 0, (data[:, 2:5] @ np.array(d)) / np.maximum(as_context, 1), 1.0)
        pairs, at = np.unique(pair_hash(context, word), return_inverse=True)
        c = self.pair_counts(pairs)
        own_share = np.maximum(c - m.pair_discounts.at(c), 0)[at] / np.maximum(as_context[ctx], 1)
        return np.log10(own_share + backoff[ctx] * base[own]), count[own]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` has doc_id, text and held_out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        unit = float(model.tokens + model.words + 1)
        for batch in batches:
            row = 0
            while row < batch.num_rows:
                words, sizes, start = [], [], row
                while row < batch.num_rows and sum(sizes) < SCORE_TOKENS:
                    words.append(token_hashes(batch.column(1)[row].as_py()))
                    sizes.append(len(words[-1]))
                    row += 1
                before = np.concatenate([contexts(w) for w in words])
                value, count = scorer.log10(before, np.concatenate(words))
                plain = np.log10((count + 1) / unit)
                at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[start:row], batch.column(2)[start:row], pa.array(sizes, pa.int64()),
                     pa.array(np.add.reduceat((count > 0).astype(np.int64), at)),
                     pa.array([model.tokens] * len(sizes), pa.int64()),
                     pa.array([float(np.sum(plain[a:a + n])) for a, n in zip(at, sizes, strict=True)]),
                     pa.array([float(np.sum(value[a:a + n])) for a, n in zip(at, sizes, strict=True)])],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text", "held_out").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
             "base_score double, score double")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def held_out(docs: DataFrame) -> DataFrame:
    """The hold-out rule: crc32 of the id as text, modulo 7, is 2."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return docs.withColumn("held_out", F.crc32(key) % 7 == 2)


def query(spark, sf_dir):
    docs = held_out(id_text(table(spark, sf_dir, "documents")))
    return score(docs, train(docs.where(~F.col("held_out")).select("text")))
