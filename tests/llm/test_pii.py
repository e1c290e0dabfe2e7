"""Anchored spans against plain regular expressions."""

import hashlib
import random
import re

from pyspark.sql import types as T

from footfall.llm import pii
from footfall.llm.common import table
from tests.conftest import SF_SMALL

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(d):
    s = [int(c) for c in d][::-1]
    return (sum(s[::2]) + sum(sum(divmod(2 * x, 10)) for x in s[1::2])) % 10 == 0


def _valid(kind, m):
    digits = re.sub(r"[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return {k: [m.span() for m in re.finditer(p, text) if _valid(k, m[0])] for k, p in PATTERNS.items()}


def test_random_texts_equal_the_patterns():
    rng, a = random.Random(5), pii.build_automaton()
    alphabets = ["0123456789 -", "0123456789.x", "+0123456789 ().-a", "ab@.-1_+%", "a1@.+ -(://ééİ"]
    for k in range(6000):
        t = "".join(rng.choice(alphabets[k % 5]) for _ in range(rng.randrange(40)))
        got = pii.find_spans(t, a)
        assert {x: got[x] for x in pii.BASE} == brute(t), t


def test_planted_spans():
    a = pii.build_automaton()
    t = ('IBAN GB82 WEST 1234 5698 7654 32 token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2" '
         "ftp://bob:pw@host.org card 4111 1111 1111 1111 tel +1 (743) 555-3824 x")
    got = pii.find_spans(t, a)
    assert [t[i:j] for i, j in got["account"]] == ["GB82 WEST 1234 5698 7654 32"]
    assert [t[i:j] for i, j in got["secret"]] == ["f33e61083db5dbdf4bd2369d2f80176e57f7fda2"]
    assert [t[i:j] for i, j in got["login"]] == ["bob:pw"]
    assert "4111" not in pii.redact(t, got) and "<PHONE>" in pii.redact(t, got)


def test_whole_table_equals_brute_force(spark):
    rows = {r.doc_id: r for r in pii.query(spark, SF_SMALL).collect()}
    docs = table(spark, SF_SMALL, "documents").collect()
    assert len(rows) == len(docs)
    for d in docs:
        want, r = brute(d.text or ""), rows[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(want[k]) for k in pii.BASE]
        joined = ",".join(f"{k}:{i}:{j}" for k in pii.BASE for i, j in want[k])
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def test_nulls_empty_long_repeats_and_extra_columns(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("spans", T.StringType())])
    long = "x " * 200_000 + "a@b.co"
    data = [(1, None, "s"), (None, "", None), (2, long, "s"), (2, long, "s")]
    df = spark.createDataFrame(data, schema)
    got = sorted((r.doc_id or 0, r.n_email, r.spans) for r in pii.scan(df).collect())
    assert got == [(0, 0, ""), (1, 0, ""), (2, 1, "email:400000:400006"), (2, 1, "email:400000:400006")]
    assert pii.scan(df.limit(0)).count() == 0
    red = pii.redact_documents(df).collect()
    assert {r.text if r.text is None else r.text[-8:] for r in red} == {None, "", " <EMAIL>"}
    assert red[0].spans == "s"


def test_accounts_before_capitals_and_cues_beside_other_letters():
    automaton = pii.build_automaton()
    iban = "ES91 2100 0418 4502 0005 1332"
    for after in (" Please", " PLEASE", " AB12", ", x", "", " 1234"):
        assert pii.find_spans(iban + after, automaton)["account"] == [(0, len(iban))], after
    assert pii.find_spans("GB82 WEST 1234 5698 7654 32", automaton)["account"] == [(0, 27)]
    assert not pii.find_spans("ES91 2100 0418 4502 0005 1333 Please", automaton)["account"]
    text = "\u0130 Password: abcdefgh12345678X"
    assert pii.find_spans(text, automaton)["secret"] == [(12, len(text))]
