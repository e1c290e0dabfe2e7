"""The language model against a dictionary-based one."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from footfall.llm import ngram_lm as L
from footfall.llm.common import id_text, table
from tests.conftest import SF_SMALL


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


class Plain:
    def __init__(self, texts):
        self.pair, self.word = Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.word.update(w)
            self.pair.update(zip([None, *w], w))
        self.before, self.after, self.ctx = Counter(), defaultdict(Counter), Counter()
        for (h, w), c in self.pair.items():
            self.before[w] += 1
            self.after[h][min(c, 3)] += 1
            self.ctx[h] += c
        times = lambda c: [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
        self.d2, self.d1 = L.Discounts.of(*times(self.pair)).d, L.Discounts.of(*times(self.before)).d
        self.n = len(self.pair)

    def p(self, h, w):
        if not self.n:
            return 1.0
        b = self.before[w]
        spare = sum(self.d1[min(v, 3) - 1] for v in self.before.values()) / self.n
        base = (b - self.d1[min(b, 3) - 1] if b else 0) / self.n + spare / (len(self.word) + 1)
        if not self.ctx[h]:
            return base
        c = self.pair[h, w]
        backoff = sum(self.d2[k - 1] * v for k, v in self.after[h].items()) / self.ctx[h]
        return (c - self.d2[min(c, 3) - 1] if c else 0) / self.ctx[h] + backoff * base


def _held(doc_id):
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % 7 == 2


def _check(got, rows):
    m = Plain([t for i, t in rows if not _held(i)])
    n, v = sum(m.word.values()), len(m.word)
    want = []
    cache = {}
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((m.word[x] + 1) / (n + v + 1)) for x in w)
        for q in zip([None, *w], w):
            if q not in cache:
                cache[q] = math.log10(m.p(*q))
        want.append((i, _held(i), len(w), sum(m.word[x] > 0 for x in w), n, base, sum(cache[q] for q in zip([None, *w], w))))
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    for a, b in zip(sorted((tuple(r)[:7] for r in got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_probabilities_sum_to_one():
    m = Plain(["a b a c a b", "b a b", "c c d"] * 2 + ["e f g a", "a a"])
    for h in [None, b"a", b"b", b"d", b"unseen"]:
        assert sum(m.p(h, w) for w in m.word) + m.p(h, b"unknown") == pytest.approx(1)


def test_table_equals_plain_model_and_beats_the_base(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").limit(60).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    docs = L.held_out(id_text(df))
    model = L.train(docs.where("not held_out").select("text"), shards=5)
    _check(L.score(docs, model).collect(), rows)


def test_held_out_text_is_likelier_than_under_the_base(spark):
    r = L.query(spark, SF_SMALL).where("held_out").groupBy().sum("score", "base_score").first()
    assert r[0] > r[1]


def test_edges(spark):
    rows = [(1, None), (None, ""), (2, "A b a\x0bB é \x1c x"), (2, "A b a\x0bB é \x1c x"), (3, "word " * 200_000),
            (4, "only here"), (5, "\n")]
    df = spark.createDataFrame([(*r, True, "x") for r in rows], "doc_id long, text string, held_out boolean, shard string")
    docs = L.held_out(id_text(df))
    _check(L.score(docs, L.train(docs.where("not held_out").select("text"))).collect(), rows)
    none = L.train(docs.limit(0).select("text"))
    assert [r.score for r in L.score(docs, none).collect()] == [0.0] * len(rows)
    assert L.score(docs.limit(0), none).count() == 0


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    c, w = rng.integers(0, 50, 5000).astype(np.uint64), rng.integers(0, 50, 5000).astype(np.uint64)
    got = Counter()
    for _, blob in L._pair_blocks(c, w, 7):
        for a, b, n in zip(*L._block_pairs(blob)):
            got[int(a), int(b)] += int(n)
    assert got == Counter(zip(c.tolist(), w.tolist()))
