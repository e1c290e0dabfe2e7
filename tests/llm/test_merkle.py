"""Merkle trees against a plain recursive version."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from footfall.llm import merkle
from footfall.llm.common import table
from tests.conftest import SF_SMALL


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes, branch):
    """Root and, for each node, its steps (before, after)."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = i - i % branch
            steps[k].append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + branch])))
        nodes = [H(*nodes[a:a + branch]) for a in range(0, len(nodes), branch)]
        at = [i // branch for i in at]
    return nodes[0], steps


def lower(t):
    return t if t is None else t.encode().lower().decode()


def brute(rows, branch=8):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        groups["-" if r[2] is None else "=" + r[2]].append((r[0] is not None, r[0] or 0, leaf(r), leaf((*r[:4], lower(r[4]))) if hit else leaf(r), r[0]))
    trees = {g: climb([x[2] for x in sorted(v, key=lambda x: x[:3])], branch) for g, v in groups.items()}
    order = sorted(groups, key=str.encode)
    root, above = climb([trees[g][0] for g in order], branch) if order else (None, [])
    out = []
    for g, up in zip(order, above):
        for x, own in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            now = x[3]
            for a, b in [*own, *up]:
                now = H(a, now, b)
            out.append((x[4], x[2], trees[g][0], root, H(*[a + b for a, b in [*own, *up]]), now, now == root))
    return Counter(out)


def tree_rows(spark, df, block_levels, branch):
    tree = merkle.manifest(merkle.document_leaves(df), "lang", ["doc_id"], block_levels, branch)
    return Counter(map(tuple, merkle.proofs(tree, "doc_id", "changed").collect()))


def test_layout_is_a_recursive_split_at_half_height():
    for branch, levels in [(2, 1), (2, 5), (3, 4), (8, 3), (8, 5)]:
        places = [merkle.address(levels, d, np.arange(branch ** d), branch) for d in range(levels)]
        assert sorted(np.concatenate(places)) == list(range(merkle.nodes_in(levels, branch))) and places[0][0] == 0
    # five levels of two: top of two levels, then four bottom trees of three levels
    assert [list(merkle.address(5, d, np.arange(2 ** d), 2)) for d in (0, 1, 2)] == [[0], [1, 2], [3, 10, 17, 24]]


def test_blocks_store_and_load():
    for m in (1, 7, 8, 9, 63, 65):
        leaves = [H(str(k)) for k in range(m)]
        block = merkle.Block.build(np.array(leaves, "S64"), 4)
        again = merkle.Block.load(4, m, block.dump())
        assert again.root == block.root and again.siblings(3) == block.siblings(3)
        want = climb(leaves, 8)[1]
        got = {}
        for run, upper in again.paths([]):
            for i in range(run, min(run + 8, m)):
                got[i] = [again.siblings(3)[i], *upper]
        for i in range(m):
            assert [(a.decode(), b.decode()) for a, b in got[i]][:len(want[i])] == want[i]


def test_whole_table(spark):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    assert Counter(map(tuple, merkle.query(spark, SF_SMALL).collect())) == brute(rows)


@pytest.mark.parametrize("block_levels, branch", [(1, 8), (2, 2), (4, 8)])
def test_edges(spark, block_levels, branch):
    rows = [(k, "s", ("en", "de")[k % 2], k, f"Text {k}") for k in range(70)]
    rows += [(k, None, None, None, None) for k in (3, 100, 101)] + [(None, "s", "en", 1, "N"), (None, None, "", None, "")]
    rows += [(5, "s", "fr", 1, "Lone")] + [(12, "s", "en", 2, "Twice")] * 3 + [(12, "s", "en", 2, "other"), (900, "s", "él", 1, "Z" * 300_000)]
    schema = "doc_id long, source string, lang string, n_chars long, text string, leaf string, n int, g string"
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema)
    assert tree_rows(spark, df, block_levels, branch) == brute(rows, branch)
    assert not tree_rows(spark, df.limit(0), block_levels, branch)
    one = [(None, None, None, None, None)]
    assert tree_rows(spark, spark.createDataFrame([(*one[0], "x", 1, "y")], schema), block_levels, branch) == brute(one, branch)


def test_many_equal_rows(spark):
    rows = [(1, "s", "en", 2, "Same")] * 2300 + [(k, "s", "en", 2, "Own") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert tree_rows(spark, df, 2, 8) == brute(rows)
