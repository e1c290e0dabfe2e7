"""Repeated strings against a dictionary of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from footfall.llm import suffix_dedup as S
from footfall.llm.common import release_memory, table
from tests.conftest import SF_SMALL


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 2, np.int64)
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        mask = np.cumsum(gone)[:len(d)] > 0
        kept = bytes(np.frombuffer(d, np.uint8)[~mask])
        out.append((len(d), int(mask.sum()), int((np.diff(mask.astype(int), prepend=0) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return out


def brute_words(texts, size):
    """(runs, words) of each text that passages of ``size`` words cover which
    stand in two places, whatever parts the words."""
    data = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(d[i:i + size]) for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        mask = np.zeros(len(d), bool)
        for i in range(len(d) - size + 1):
            if count[tuple(d[i:i + size])] > 1:
                mask[i:i + size] = True
        out.append((int((np.diff(mask.astype(int), prepend=0) == 1).sum()), int(mask.sum())))
    return out


def _check(spark, rows, length, words=51, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, th string, spans int")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.n_passages,
                  r.n_passage_words) for r in S.digests(df, length, words, **more).collect())
    texts = [r[1] for r in rows]
    want = [(*a, *b) for a, b in zip(brute(texts, length), brute_words(texts, words))]
    assert got == sorted((r[0] is not None, r[0] or 0, *w) for r, w in zip(rows, want))


def test_suffix_array_equals_sorted_suffixes():
    rng = random.Random(0)
    for _ in range(1500):
        v = rng.choice([1, 2, 3, 9])
        s = [rng.randrange(1, v + 1) for _ in range(rng.randrange(50))] + [0]
        assert S.suffix_array(np.array(s)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])
    assert S.suffix_array(np.array([], int)).tolist() == []


def test_repeated_starts_of_regions():
    rng = random.Random(1)
    for length in (64, 100, 400):
        base = bytes(rng.randrange(97, 101) for _ in range(3000))
        regions = []
        for _ in range(60):
            a = rng.randrange(2000)
            cut = bytearray(base[a:a + rng.randrange(length, 900 + length)])
            if rng.random() < 0.5:
                cut[rng.randrange(len(cut))] = 120
            regions.append(bytes(cut))
        regions += [b"z" * (length + 40), b"zx" * length]
        copies = [rng.choice([1, 1, 2]) for _ in regions]
        count = Counter()
        for r, c in zip(regions, copies):
            for i in range(len(r) - length + 1):
                count[r[i:i + length]] += c
        got = S.repeated_starts(regions, copies, S.byte_search(length))
        for r, g in zip(regions, got):
            assert g.tolist() == [i for i in range(len(r) - length + 1) if count[r[i:i + length]] > 1]


def test_whole_table_equals_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents").collect()
    want = [(*a, *b) for a, b in zip(brute([d.text for d in docs], S.LENGTH), brute_words([d.text for d in docs], S.PASSAGE))]
    got = {r.doc_id: r for r in S.query(spark, SF_SMALL).collect()}
    assert len(got) == len(docs) and sum(w[1] for w in want) > 0
    for d, w in zip(docs, want):
        r = got[d.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.n_passages, r.n_passage_words) == w, d.doc_id


@pytest.mark.parametrize("hot", [S.SHARD_BYTES, 1])
def test_passages_copies_and_edges(spark, hot):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    passage = word(300)
    rows = [(k, word(rng.randrange(200)) + passage[rng.randrange(60):300 - rng.randrange(60)] + word(150), "x", 1)
            for k in range(40)]
    rows += [(50, passage, None, None), (50, passage, None, None), (51, None, None, 1), (None, "", "", 1),
             (None, word(90), "", 1), (52, "a" * 30_000, "", 1), (53, "ab" * 400, "", 1), (54, word(99), "", 1),
             (55, passage[:100] + "É" + passage[100:], "", 1), (55, passage[:100] + "è" + passage[100:], "", 1)]
    _check(spark, rows, 100, words=9, hot_bytes=hot)


def test_many_rows_without_an_id_and_one_hot_passage(spark):
    """Rows of one id are told apart; a passage in all of them is one key."""
    words = [f"w{k}" for k in range(60)]
    rows = [(None, " ".join([f"own{i}"] + words + [f"end{i}x{j}" for j in range(i % 7)]), "x", 1) for i in range(150)]
    rows += [(None, "a text of its own " + "q" * 90, "x", 1)] * 3
    for hot in (S.SHARD_BYTES, 200):
        _check(spark, rows, 64, hot_bytes=hot)


def test_empty_table_and_kept_columns(spark):
    df = spark.createDataFrame([(1, "x" * 1000 + "é" * 300, "a", 2), (2, None, "b", 3), (3, "y" * 10, None, None)],
                               "doc_id long, text string, row string, spans int")
    assert S.digests(df.limit(0)).count() == 0 and S.remove_repeats(df.limit(0)).count() == 0
    out = S.remove_repeats(df)
    assert out.columns == df.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[2].text is None and rows[3].text == "y" * 10 and rows[1].text == "" and rows[2].row == "b"
    assert S.remove_repeats(df.select("doc_id", "text")).columns == ["doc_id", "text"]


def test_release_memory_hands_back_what_small_objects_leave():
    try:
        status = lambda: int(next(x for x in open("/proc/self/status") if x.startswith("VmRSS")).split()[1])
        status()
    except OSError:
        pytest.skip("no /proc here")
    held = [bytes(2000) for _ in range(100_000)]
    held = held[::500]                           # a few stay and keep the heap from shrinking by itself
    before = status()
    release_memory()
    assert before - status() > 100_000 and len(held) == 200


def test_runs_of_texts_searched_together_are_those_of_each():
    rng = np.random.default_rng(4)
    for search in (S.byte_search(40), S.word_search(6), S.Search(1, gram=1), S.Search(5, gram=5)):
        texts = [rng.integers(0, v, n).astype(search.dtype) for n in (0, 3, 39, 40, 41, 500, 5, 6, 7, 200, 1, 0) for v in (1, 3, 200)]
        data, size = np.concatenate(texts), np.array(list(map(len, texts)))
        key, a, b = S.runs_of(data, search, size)
        got = list(zip(key.tolist(), a.tolist(), b.tolist(), S.region_hashes(data, a, b + search.length - 1).tolist()))
        want, at = [], 0
        for x in texts:
            key, a, b = S.runs_of(x, search)
            h = S.region_hashes(x, a, b + search.length - 1)
            want += list(zip(key.tolist(), (a + at).tolist(), (b + at).tolist(), h.tolist()))
            starts = np.concatenate([np.arange(i, j) for i, j in zip(a, b)]) if len(a) else a
            assert starts.tolist() == list(range(max(0, len(x) - search.length + 1)))
            at += len(x)
        assert got == want and want


def test_powers_are_computed_once():
    for n in (1, 2, 5, 4_096, 4_097, S.KEPT_POWERS + 3, 7):
        got = S._powers(S._INVERSE, n)
        assert len(got) == n and all(int(got[k]) == pow(S._INVERSE, k, 1 << 64) for k in {0, n // 2, n - 1})
    assert np.shares_memory(S._powers(S._INVERSE, 100), S._powers(S._INVERSE, 3_000))
    assert max(map(len, S._kept_powers.values())) <= S.KEPT_POWERS
