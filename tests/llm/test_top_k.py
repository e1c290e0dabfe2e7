"""Exact search against all pairs."""

import math

import duckdb
import numpy as np

from footfall.llm import top_k
from footfall.llm.common import table
from tests.conftest import SF_SMALL


def brute(rows, k, every):
    """rows: (id, vector); result as sorted (query, rank, id, score)."""
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(good):
        if i % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(good)
                            if a != b and len(v) == len(w))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def test_whole_table_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF_SMALL}/embeddings.parquet')")
    want = sorted(con.execute(top_k.ORACLE).fetchall())
    assert sorted(map(tuple, top_k.query(spark, SF_SMALL).collect())) == want
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_SMALL, "embeddings").collect()]
    assert want == brute(rows, 20, 20)


def test_edges(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(x) for x in rng.normal(size=5).round(1)]) for k in range(60)]
    rows += [(3, rows[3][1]), (20, rows[20][1]), (20, rows[20][1]), (61, None), (62, []), (63, [1.0, None]), (None, [1.0]),
             (64, [float("nan")] * 5), (65, [float("inf")] * 5), (80, [1.0, 2.0]), (81, [-1.0, 2.0]), (100, [3.0]),
             (200, [1e7, 0.3, -1e7, 0.0, 2.0]), (140, [0.0] * 5)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                               "vec_id long, embedding array<double>, uid int, block string")
    assert sorted(map(tuple, top_k.search(df, 7).collect())) == brute(rows, 7, 20)
    assert top_k.search(df.limit(0)).count() == 0


def test_huge_components_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (20, [3e7, 1.0]), (21, [2e7, -2e7]), (22, [4e7, 1.0]), (40, [1e300, 0.0]), (23, [-9e17, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k.search(df, 5).collect())) == brute(rows[:3], 5, 20)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(8, 64)) * 20
    c = np.floor(np.repeat(centre[:, ::16], 16, axis=1)[rng.integers(0, 8, 4096)] * 2 + rng.normal(size=(4096, 64)))
    q = c[:64]
    exact = q @ c.T
    for level in top_k.LEVELS:
        assert (top_k.statistics(q, level) @ top_k.statistics(c, level).T >= exact - 1e-6).all()
    s = top_k.Scorer(np.arange(64), q, 20)
    order = np.argsort(-(c * c).sum(axis=1), kind="stable")
    for a in range(0, 4096, 512):
        part = order[a:a + 512]
        s.meet(part, part, c[part])
    assert s.exact < 0.5 * s.seen
