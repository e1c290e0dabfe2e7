"""The pipeline against the plain versions of its stages."""

import re
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from footfall.llm import packing, quality_rules
from footfall.llm.bpe import vocabulary_path
from footfall.llm.common import stored, table
from tests.conftest import SF_SMALL
from tests.llm import test_bpe, test_ngram_join, test_pii

MARKS = ("<EMAIL>", "<IP>", "<CARD>", "<PHONE>")


def _cut(texts, length, size):
    """Texts without the strings of ``length`` bytes and the passages of
    ``size`` words that stand in two places."""
    data = [t.encode() for t in texts]
    words = [[m.span() for m in re.finditer(rb"\S+", d)] for d in data]
    spans = [[(i, i + length, d[i:i + length]) for i in range(len(d) - length + 1)]
             + [(at[i][0], at[i + size - 1][1], tuple(d[x:y] for x, y in at[i:i + size])) for i in range(len(at) - size + 1)]
             for d, at in zip(data, words)]
    seen = Counter(key for found in spans for _, _, key in found)
    out = []
    for d, found in zip(data, spans):
        gone = np.zeros(len(d) + 1, np.int64)
        for i, j, key in found:
            if seen[key] > 1:
                gone[i] += 1
                gone[j] -= 1
        keep = np.cumsum(gone)[:len(d)] == 0
        out.append(bytes(np.frombuffer(d, np.uint8)[keep]).decode("utf-8", "ignore"))
    return out


def test_stages_equal_plain_versions(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_join", "suffix_dedup", "pii", "packing"]
    docs = table(spark, SF_SMALL, "documents")
    stages = dict(corpus_pipeline.STAGES)
    run = lambda name, d: stored(stages[name](spark, d, SF_SMALL), "t")

    kept = run("quality_rules", docs)
    assert kept.columns == docs.columns
    verdicts = {r.doc_id for r in quality_rules.apply_rules(docs).where("kept").collect()}
    rows = kept.collect()
    assert {r.doc_id for r in rows} == verdicts and len(rows) == len(verdicts)

    one = run("ngram_join", kept)
    classes = test_ngram_join.brute([(r.doc_id, r.text) for r in rows])
    rows = one.collect()
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in rows) == sorted({c for _, c, _ in classes})

    cut = run("suffix_dedup", one)
    want = {r.doc_id: t for r, t in zip(rows, _cut([r.text for r in rows], 400, corpus_pipeline.PASSAGE)) if t.strip()}
    rows = cut.collect()
    assert cut.columns == docs.columns and {r.doc_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)

    clean = run("pii", cut)
    before, rows = {r.doc_id: r.text for r in rows}, clean.collect()
    assert clean.columns == docs.columns and {r.doc_id for r in rows} == set(before)
    for r in rows:
        spans = test_pii.brute(before[r.doc_id])
        assert not any(test_pii.brute(r.text).values())
        if not re.search("<[A-Z]+>", r.text):
            assert r.text == before[r.doc_id] and not any(spans.values())
        for (kind, found), mark in zip(spans.items(), MARKS):
            assert not found or mark in r.text or "<SECRET>" in r.text or "<ACCOUNT>" in r.text, kind

    t = Tokenizer.from_file(vocabulary_path())
    ids = {r.doc_id: [[*t.encode(r.text, add_special_tokens=False).ids, 0]] for r in rows}
    n = test_bpe._check_packing(run("packing", clean).collect(), ids, packing.CAPACITY)
    assert n <= 1.02 * -(-sum(len(x[0]) for x in ids.values()) // packing.CAPACITY) + 1


def test_run_equals_the_stages_in_order(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert rows and len({(r.doc_id, r.piece) for r in rows}) == len(rows)


def test_edges(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows,
    many rows without an id, other columns with the stages' own names."""
    base = " ".join(f"the word{k} of" for k in range(80))
    long_ = " ".join(f"the long{k} and" for k in range(40_000))
    rows = [(1, base + " mail a@b.co", "en", "s", 5), (None, base, "en", None, None), (2, None, None, None, None),
            (3, "", "en", "s", 0), (4, base.replace("word", "thing"), "en", "s", 1), (4, base.replace("word", "thing"), "en", "s", 1),
            (5, " \n\t \n", "en", "s", 1), (6, long_, None, "s", None)]
    rows += [(None, base.replace("word", f"n{k}x"), "en", "s", 1) for k in range(30)] + [(None, " \n", "en", "s", 1)] * 30
    clash = ", th string, row int, spans string, node string, kept string, sequence_id int"
    docs = spark.createDataFrame([(*r, "t", 1, "s", "n", "k", 3) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long" + clash)
    for empty in (docs.limit(0), docs):
        d = empty
        for name, stage in corpus_pipeline.STAGES[:-1]:
            d = stored(stage(spark, d, SF_SMALL), "t")
            assert d.columns == docs.columns, name
        assert sorted(r.doc_id or 0 for r in d.collect()) == ([] if empty is not docs else [0] * 30 + [1, 4, 6])
        assert all("a@b.co" not in r.text and r.n_chars == len(r.text) and r.th == "t" for r in d.collect())
        packed = stored(corpus_pipeline.STAGES[-1][1](spark, d, SF_SMALL), "t").collect()
        assert sorted({r.doc_id or 0 for r in packed}) == ([] if empty is not docs else [0, 1, 4, 6])


def test_passage_of_52_words_under_400_bytes_is_cut(spark):
    passage = " ".join(f"p{k:03d}" for k in range(52))
    assert len(passage.encode()) < 400
    own = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    rows = [(1, f"{own('a', 60)} {passage} {own('b', 40)}", "en", "s", 1), (2, f"{own('c', 50)} \n{passage}", "en", "s", 1),
            (3, f"{own('d', 30)} {' '.join(passage.split()[:50])} {own('e', 30)}", "en", "s", 1),
            (4, own("f", 55).replace(" ", "  ") + own(" g", 9), "en", "s", 1), (5, own("h", 9) + " " + own("f", 55), "en", "s", 1)]
    docs = spark.createDataFrame(rows, table(spark, SF_SMALL, "documents").schema)
    cut = {r.doc_id: r.text.split() for r in dict(corpus_pipeline.STAGES)["suffix_dedup"](spark, docs, SF_SMALL).collect()}
    assert cut[1] == f"{own('a', 60)} {own('b', 40)}".split() and cut[2] == own("c", 50).split()
    assert cut[3] == rows[2][1].split()          # 50 words are no passage
    assert cut[4][-8:] == [f"g{k}" for k in range(1, 9)] and len(cut[4]) <= 9 and cut[5] == own("h", 9).split()


def test_suffix_dedup_stage_cuts_repeated_bytes_and_words(spark):
    """The stage on the whole table against dictionaries of all strings."""
    docs = table(spark, SF_SMALL, "documents")
    rows = docs.collect()
    want = {r.doc_id: t for r, t in zip(rows, _cut([r.text for r in rows], 400, 51)) if t.strip()}
    got = dict(corpus_pipeline.STAGES)["suffix_dedup"](spark, docs, SF_SMALL)
    assert {r.doc_id: r.text for r in got.collect()} == want
