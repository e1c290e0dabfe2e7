"""Shards against a plain rendezvous hash."""

import hashlib
import math
import zlib
from collections import Counter

import pytest

from footfall.llm import sharding
from footfall.llm.common import table
from tests.conftest import SF_SMALL


def plain(key, weights):
    def draw(s):
        u = (int(hashlib.md5(f"{key}/{s}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        return -math.log(u) / weights[s]
    return min(range(len(weights)), key=lambda s: (draw(s), s))


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def check(rows, want, weights):
    got = Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in rows)
    more = [*weights, 1.0]
    assert got == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), plain(field(i), weights),
                           plain(field(i), more)) for i, t in want)
    for s in range(len(weights)):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert all(r.grown_shard in (r.shard, len(weights)) and r.law == "key" for r in rows)


def test_whole_table(spark):
    rows = sharding.query(spark, SF_SMALL).collect()
    check(rows, [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()], [1.0] * 16)


def test_edges(spark):
    want = [(None, "x"), (None, None), (1, None), (1, ""), (2, "Aé" * 50_000), (3, "y"), (3, "y")] + [(k, "t") for k in range(10, 60)]
    want += [(7, "copy")] * 2500                       # more equal rows than one counted row stands for
    df = spark.createDataFrame([(i, t, "a", 1, "c") for i, t in want], "doc_id long, text string, shard string, n int, slot string")
    weights = [1.0, 3.0, 0.5]
    check(sharding.place(df, weights).collect(), want, weights)
    assert sharding.place(df.limit(0)).count() == 0
    assert {r.grown_shard for r in sharding.place(df, weights, grown_by=None).collect()} == {None}
    with pytest.raises(ValueError):
        sharding.assign(df, weights)
    with pytest.raises(ValueError):
        sharding.assign(df.select("doc_id"), [1.0, 0.0])


def test_weights_growth_and_moves(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    weights = [1.0, 2.0, 1.0]
    n = Counter(r.shard for r in sharding.assign(df, weights).collect())
    assert all(abs(n[s] - 20_000 * w / 4) < 400 for s, w in enumerate(weights))
    moved = sharding.moved(df, weights, [*weights, 1.0]).collect()
    assert {r.new_shard for r in moved} == {3} and abs(len(moved) - 4_000) < 400
    moved = sharding.moved(df, [*weights, 1.0], weights).collect()      # one shard less: only its rows move
    assert {r.shard for r in moved} == {3}
    assert {r.shard for r in sharding.moved(df, weights, [1.0, 4.0, 1.0]).collect()} == {0, 2}     # into the heavier one


def test_written_shards(spark):
    docs = table(spark, SF_SMALL, "documents")
    back = spark.read.parquet(sharding.write_shards(docs, [1.0] * 4, ["doc_id", "lang"]))
    want = {r.doc_id: r.shard for r in sharding.assign(docs, [1.0] * 4, ["doc_id", "lang"]).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == want and back.count() == docs.count()
