"""Classes of near copies against all pairs."""

import random

import numpy as np
import pytest

from footfall.llm import ngram_join as J
from footfall.llm.common import table
from tests.conftest import SF_SMALL


def _set(text):
    w = (text or "").encode().split()
    return frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """Class of each row by all pairs; rows are (doc_id, text)."""
    sets = [_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = {}
    for g in groups.values():
        ids = [rows[i][0] for i in g if rows[i][0] is not None]
        for i in g:
            out[i] = (min(ids) if ids else None, len(g))
    return [(rows[i][0], *out[i]) for i in range(len(rows))]


def _key(r):
    return tuple((x is not None, x or 0) for x in r)


def _check(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, node string, th int")
    got = J.join(df).collect()
    assert sorted(((r.doc_id, r.class_id, r.class_size) for r in got), key=_key) == sorted(brute(rows), key=_key)
    assert all((r.n_links > 0) == (r.class_size > 1) for r in got)


def test_depth_is_shortened_until_the_recall():
    d = J.least_depth()
    assert 1 - (1 - 0.8 ** d) ** J.TREES >= J.RECALL > 1 - (1 - 0.8 ** (d + 1)) ** J.TREES


def test_signature_agreement_estimates_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        s = np.unique(rng.integers(0, 2 ** 63, 4000).astype(np.uint64))
        k = int(len(s) * (1 - share) / (1 + share))
        a, b = s[k:], s[:len(s) - k]
        true = J.similarity(a, b)
        x, y = (np.frombuffer(J.signature(v), "<u2") for v in (a, b))
        assert abs((x == y).mean() - true) < 5 * (true * (1 - true) / len(x)) ** 0.5


def test_whole_table_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    got = {r.doc_id: r for r in J.query(spark, SF_SMALL).collect()}
    for doc_id, name, size in brute(rows):
        assert (got[doc_id].class_id, got[doc_id].class_size) == (name, size)


@pytest.mark.parametrize("cell", [J.CELL, 5])
def test_drifting_copies_and_edges(spark, cell, monkeypatch):
    monkeypatch.setattr(J, "CELL", cell)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, n = [], 0
    for base in range(3):                         # each copy changes one word of another copy: classes drift
        text = [word() for _ in range(90)]
        family = [text]
        for _ in range(25):
            t = list(rng.choice(family))
            t[rng.randrange(90)] = word()
            family.append(t)
        for t in family:
            rows.append((n, " ".join(t)))
            n += 1
    rows += [(200, None), (201, ""), (202, " \n"), (203, "two words"), (204, "two  words"), (205, "a b c d"),
             (None, "a b c d"), (None, rows[0][1]), (7, rows[7][1]), (None, "only null id"), (300, "x y " * 30_000),
             (301, "x y " * 20_000)]
    _check(spark, rows)


def test_copies_around_the_least_similarity(spark):
    rng = random.Random(6)
    base, rows = [f"w{k}" for k in range(150)], []
    for n in range(120):                          # one to twenty changed words: similar to some, not to others
        t = list(base)
        for _ in range(rng.randrange(1, 20)):
            t[rng.randrange(150)] = f"x{rng.randrange(10 ** 6)}"
        rows.append((n, " ".join(t)))
    _check(spark, rows)


def test_keep_one(spark):
    a, b = " ".join(f"w{k}" for k in range(60)), " ".join(f"v{k}" for k in range(60))
    rows = [(5, a, "n"), (3, a + " end", "m"), (9, b, None), (9, b, None), (1, None, "z"), (2, "", "z"), (None, a, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string")
    out = J.keep_one(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.row or "") for r in out.collect()) == [(1, "z"), (2, "z"), (3, "m"), (9, "")]
    assert J.keep_one(df.limit(0)).count() == 0 and J.join(df.limit(0)).count() == 0


@pytest.mark.parametrize("cell", [J.COUNT_CELL, 7])
def test_n_links_equals_all_pairs(spark, cell, monkeypatch):
    monkeypatch.setattr(J, "COUNT_CELL", cell)
    rng, rows = random.Random(8), []
    for base, changes in ((0, 1), (1, 16)):       # all pairs are links; some are
        text = [f"b{base}w{k}" for k in range(150)]
        for n in range(40):
            t = list(text)
            for _ in range(rng.randrange(changes) + 1):
                t[rng.randrange(150)] = f"x{rng.randrange(10 ** 6)}"
            rows.append((100 * base + n, " ".join(t)))
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, "alone here"), (303, None)]
    sets = [_set(t) for _, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_links for r in J.join(df).collect()}
    for (doc_id, _), a in zip(rows, sets):
        texts = {b for b in sets if a and b and b != a and 5 * len(a & b) >= 4 * len(a | b)}
        assert got[doc_id] == len(texts) + (sets.count(a) - 1 if a else 0)
    assert got[1] == 39 and got[300] == 41
