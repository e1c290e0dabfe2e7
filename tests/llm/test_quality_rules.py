"""Quality rules against plain Python."""

import re
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm import quality_rules as Q
from footfall.llm.common import table
from tests.conftest import SF_SMALL


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    c = Counter(zip(w, w[1:], w[2:]))
    covered = {k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def _base(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_whole_table_equals_brute_force(spark):
    got = {r.doc_id: r for r in Q.query(spark, SF_SMALL).collect()}
    docs = table(spark, SF_SMALL, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = brute(d.text)
        assert _base(got[d.doc_id]) == want
        assert got[d.doc_id].base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_labelled_documents(spark):
    got = Q.query(spark, SF_SMALL).join(table(spark, SF_SMALL, "labels"), "doc_id").where(~F.col("base_failed"))
    good = got.where("quality = 1")
    assert good.where("not kept").count() == 0
    assert got.where("quality = 0 and kept").count() == 0


def test_edge_cases(spark):
    texts = [None, "", " \n\t ", "a", "a b c", "a b c a b c", "a b a b a b a b", "x\n\nx\n x\nx\x0b", "é ü ß",
             "the cat " * 60000, "a b c d " * 2 + "e a b c"]
    df = spark.createDataFrame([(k, t, "q", 1) for k, t in enumerate(texts)] + [(None, "a b", None, None)],
                               "doc_id long, text string, row string, w int")
    got = {r.doc_id: r for r in Q.apply_rules(df).collect()}
    for k, t in enumerate(texts):
        assert _base(got[k]) == brute(t), t
    twice = df.where("doc_id = 9").union(df.where("doc_id = 9"))
    assert Q.apply_rules(twice).count() == 2
    assert Q.apply_rules(df.limit(0)).count() == 0
    kept = Q.keep_documents(df)
    assert kept.columns == df.columns and kept.count() == 0


def test_plan_is_one_projection(spark):
    plan = Q.query(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_threshold_table_is_compiled(spark):
    df = spark.createDataFrame([(1, "the cat of dogs and " * 20 + " ".join(f"w{i}" for i in range(200)))],
                               "doc_id long, text string")
    assert Q.apply_rules(df).first().kept
    assert not Q.apply_rules(df, (Q.Rule("n_words", 1000, None),)).first().kept


def test_registered_sql_equals_spark(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF_SMALL}/documents.parquet')")
    cur = con.execute(Q.ORACLE)
    names = [d[0] for d in cur.description]
    df = Q.query(spark, SF_SMALL)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(cur.fetchall())
