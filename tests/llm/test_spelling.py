"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from footfall.llm import spelling
from tests.conftest import SF_SMALL


def near(a, b):
    """Exactly one edit apart, by the common prefix and suffix."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + (len(a) == len(b)):] == b[p + 1:]


def brute_words(rows, noise=31, least=7, count=2):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if noise and h % noise == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += len(w) >= least
    return {w: k for w, k in n.items() if k >= count}


def brute(words, factor=10):
    form, out = {}, []
    for w, n in words.items():
        close = sorted((-m, v) for v, m in words.items() if near(w, v))
        best = close[0] if close and -close[0][0] >= factor * n else None
        form[w] = best and best[1]
        out.append([w, form[w], w, n, len(close), best and -best[0]])
    for row in out:
        while form[row[2]]:
            row[2] = form[row[2]]
    return sorted(map(tuple, out))


def some_words(rng, count, length, letters="abé"):
    words = {}
    for _ in range(count):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(7, length)))
        words[w] = rng.choice((2, 3, 30, 400, 5000))
    return words


def frame(spark, words):
    return spark.createDataFrame(sorted(words.items()), "word string, n long")


def test_scan_equals_all_pairs():
    rng = random.Random(3)
    for size in (0, 1, 2, 9):
        rests = sorted({"".join(rng.choice("ab") for _ in range(rng.choice((size, size + 1)))) for _ in range(40)})
        other = sorted({"".join(rng.choice("abÿ") for _ in range(size + 1)) for _ in range(20)})
        scan = spelling.Scan(rests + other, np.array([0, len(rests)]))
        q, w = scan.pairs(np.arange(len(rests) + len(other)))
        everything = [(i, j) for part, base in ((rests, 0), (other, len(rests))) for i, a in enumerate(part, base)
                      for j, b in enumerate(part, base) if near(a, b)]
        assert sorted(zip(q, w)) == everything


def test_every_pair_is_found_once_however_lists_are_cut(spark):
    rng = random.Random(5)
    words = some_words(rng, 400, 9) | some_words(rng, 60, 30, "a") | {"b" * 5000: 4, "b" * 2500 + "c" + "b" * 2499: 90, "b" * 4999: 7}
    for cells in (1, 60, 1 << 14):
        got = spelling.variants(frame(spark, words), cells=cells).collect()
        assert sorted(map(tuple, got), key=lambda r: r[0]) == brute(words)


def test_whole_table(spark):
    from footfall.llm.common import table
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    got = spelling.vocabulary(table(spark, SF_SMALL, "documents"), noise=31).collect()
    assert {r.word: r.n for r in got} == brute_words(rows) and len(got) > 500


def test_edges(spark):
    long_word = "x" * 30_000
    rows = [(1, None), (None, "Straße STRASSE strasse 1straße strasse"), (None, None), (2, ""), (3, "çaÉÇ÷×éçx " * 3),
            (4, f"{long_word} {long_word[:-1]}Y {long_word}"), (4, f"{long_word} {long_word[:-1]}y"), (5, "ＡＢＣabcdefgİabcdefg"),
            (6, "receive " * 300 + "recieve receive recive recive"), (6, "reciive reciive")]
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    words = {r.word: r.n for r in spelling.vocabulary(df, noise=31).collect()}
    assert words == brute_words(rows)
    got = spelling.variants(spelling.vocabulary(df)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == brute(brute_words(rows, noise=0))
    assert spelling.variants(spelling.vocabulary(df.limit(0))).count() == 0


def test_roots_follow_long_chains(spark):
    rows = [(f"w{k:03d}", f"w{k + 1:03d}" if k % 40 != 39 else None) for k in range(120)]
    got = {r.word: r.root for r in spelling.rooted(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {w: f"w{int(w[1:]) // 40 * 40 + 39:03d}" for w, _ in rows}


def test_a_scan_holds_a_bounded_number_of_ranges(monkeypatch):
    import itertools

    import numpy as np

    from footfall.llm import spelling
    rests = sorted("".join(w) for w in itertools.product("abcde", repeat=3))
    scan = spelling.Scan(rests, np.array([0]))
    whole = set(zip(*(x.tolist() for x in scan.pairs(np.arange(len(rests))))))
    most, repeat = [0], np.repeat
    monkeypatch.setattr(spelling, "MOST_RANGES", 200)
    monkeypatch.setattr(spelling.np, "repeat", lambda a, n, *r: most.append(int(np.sum(n))) or repeat(a, n, *r))
    cut = list(zip(*(x.tolist() for x in scan.pairs(np.arange(len(rests))))))
    assert max(most) <= 200 and len(cut) == len(set(cut)) and set(cut) == whole
    assert len(whole) == 125 * 12                # one of three letters is one of four others
