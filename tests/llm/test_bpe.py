"""BPE operators against the tokenizers library on whole texts."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import bpe_chunks, packing, token_store
from footfall.llm.bpe import PieceEncoder, vocabulary_path
from footfall.llm.common import scratch_path, table
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, piece string, _h string, block long"
ROWS = [(3, None, "a", "b", 1), (None, "", "a", "b", 1), (1, "x y", None, None, None), (1, "x y", "", "", 0),
        (1, "a <|endoftext|>  b", "", "", 0), (2, "long words here \n\n " * 40_000, "", "", 0)]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids, t


def _texts(n, seed):
    rng = random.Random(seed)
    parts = ["a", "b", " ", " ", "\n", "\t", "é", "1", ".", "'s", "<|endoftext|>", "\x1c", "日", "  ", "😀", "'", "\xa0"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_pieces_and_chunks_equal_the_library(library):
    encode, tokenizer = library
    pieces, chunks = PieceEncoder(), bpe_chunks.ChunkEncoder(mean_chunk=16)
    for t in _texts(4000, 1):
        want = encode(t)
        assert pieces.encode(t).tolist() == want
        assert chunks.encode(t * 3).tolist() == encode(t * 3)
        assert pieces.decode(np.array(want)) == tokenizer.decode(want, skip_special_tokens=False)
    assert chunks.reused > 0


def test_shared_passage_is_encoded_once():
    rng = random.Random(2)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(2000))
    c = bpe_chunks.ChunkEncoder()
    c.encode("one start " + passage)
    known = len(c.chunks)
    c.encode("quite another beginning, " + passage)
    assert c.reused > 10 and len(c.chunks) <= known + 4


def test_op8_whole_table(spark, library):
    encode, tokenizer = library
    got = {r.doc_id: r for r in bpe_chunks.query(spark, SF_SMALL).collect()}
    for d in table(spark, SF_SMALL, "documents").collect():
        ids = encode(d.text)
        r = got.pop(d.doc_id)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(
            tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert not got


def test_op8_edges(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rows = bpe_chunks.round_trip(df).collect()
    assert sorted(r.decoded for r in rows) == sorted(r[1] or "" for r in ROWS)
    assert bpe_chunks.digests(df).count() == len(ROWS) and bpe_chunks.digests(df.limit(0)).count() == 0


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 7, 300, 4000):
        for v in (1, 2, 6):
            x = rng.integers(0, v, n).astype(np.uint32)
            rules, starts, lengths, seq = token_store.compress(x, 10, min_count=2, rounds=6)
            b = token_store.Block(10, rules.ravel(), starts, lengths, seq)
            assert (b.ids() == x).all() and (n < 100 or len(seq) < n)
            for _ in range(20):
                i, j = sorted(rng.integers(0, n + 1, 2).tolist())
                assert (b.ids(i, j) == x[i:j]).all()


def test_grammar_has_no_frequent_pair_left():
    rng = np.random.default_rng(5)
    passage = rng.integers(0, 5000, 2000)
    copies = np.concatenate([np.append(passage, 5000 + k) for k in range(100)])
    skewed = np.minimum(rng.zipf(1.3, 60_000), 30_000)
    for x in (copies, skewed, np.zeros(40, int)):
        rules, starts, lengths, seq = token_store.compress(x, 40_000)
        _, n = np.unique((seq[:-1].astype(np.int64) << 32) | seq[1:], return_counts=True)
        assert not (n >= token_store.MIN_COUNT).any()
        assert (token_store.Block(40_000, rules.ravel(), starts, lengths, seq).ids() == x).all()
    rules, starts, lengths, seq = token_store.compress(copies, 40_000)
    assert len(seq) <= 300 and lengths.max() >= 1000     # a copy is folded to a few symbols


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op9_whole_table(spark, library):
    encode, _ = library
    got = {r.doc_id: r for r in token_store.query(spark, SF_SMALL).collect()}
    start = 0
    for d in table(spark, SF_SMALL, "documents").orderBy("doc_id").collect():
        ids = [*encode(d.text), 2]
        r = got.pop(d.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), _crc(ids))
        start += len(ids)
    assert not got


def test_op9_edges(spark, library):
    encode, _ = library
    df = spark.createDataFrame(ROWS, SCHEMA)
    path = scratch_path(spark, "t")
    token_store.write(df, path)
    got = sorted(token_store.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 1, 1, 2, 3]
    assert sorted(r.ids_crc32 for r in got) == sorted(_crc([*encode(r[1]), 2]) for r in ROWS)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    empty = scratch_path(spark, "t")
    token_store.write(df.limit(0), empty)
    assert token_store.read(spark, empty).count() == 0


def _check_packing(rows, want, capacity):
    """want: doc id -> list of id lists; returns the number of sequences."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert by_doc.keys() == want.keys()
    for k, texts in want.items():
        expected = []
        for ids in texts:
            first = len(ids) % capacity or min(len(ids), capacity)
            edges = [0, *range(first, len(ids) + 1, capacity)]
            expected += [(n, a, b - a, _crc(ids[a:b])) for n, (a, b) in enumerate(zip(edges, edges[1:]))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[k]) == sorted(expected)
    return len(by_seq)


def test_op10_whole_table(spark, library):
    encode, _ = library
    want = {d.doc_id: [[*encode(d.text), 0]] for d in table(spark, SF_SMALL, "documents").collect()}
    n = _check_packing(packing.query(spark, SF_SMALL).collect(), want, packing.CAPACITY)
    least = -(-sum(len(x[0]) for x in want.values()) // packing.CAPACITY)
    assert n <= least * 1.01 + 1


def test_op10_edges(spark, library):
    encode, _ = library
    df = spark.createDataFrame(ROWS, SCHEMA)
    want = {}
    for r in ROWS:
        want.setdefault(r[0], []).append([*encode(r[1]), 0])
    rows = packing.pack(packing.token_pieces(df, capacity=64), capacity=64).collect()
    _check_packing(rows, want, 64)
    assert packing.pack(packing.token_pieces(df.limit(0))).count() == 0


def test_plan_is_near_the_bound_and_exact():
    rng = np.random.default_rng(3)
    for n in (1, 40, 3000):
        counts = np.bincount(np.minimum(2048, np.exp(rng.normal(6.2, 1, n)).astype(int) + 1), minlength=2049)[1:]
        fillings = packing.plan(counts)
        packed = np.zeros(2048, int)
        for f in fillings:
            assert sum(a * b for a, b in f.items) <= 2048
            for a, b in f.items:
                packed[a - 1] += b * f.times
        assert (packed == counts).all()
        least = -(-int(counts @ np.arange(1, 2049)) // 2048)
        assert sum(f.times for f in fillings) <= least * 1.02 + 1


def test_price_is_the_best_filling():
    from itertools import product
    rng = np.random.default_rng(4)
    for _ in range(20):
        v = rng.random(6)
        best = [max(sum(v[k] * c for k, c in enumerate(cs)) for cs in product(range(7), repeat=6)
                    if sum((k + 1) * c for k, c in enumerate(cs)) <= room) for room in range(7)]
        assert packing.price(v) == pytest.approx(best)


def _histograms():
    rng = np.random.default_rng(5)
    dense = np.full(2048, 100)
    dense[-1] = 0
    few = np.zeros(2048, int)
    few[[6, 300, 1200, 2046]] = 5, 1, 9, 2
    skewed = np.bincount(np.minimum(2047, np.exp(rng.normal(6, 1, 50_000)).astype(int) + 1), minlength=2049)[1:]
    return {"dense": dense, "few": few, "skewed": skewed, "none": np.zeros(2048, int)}


@pytest.mark.parametrize("name", ["dense", "few", "skewed", "none"])
def test_the_program_is_solved_and_its_rounding_places_the_pieces(name):
    counts = _histograms()[name]
    solution = packing.solve(counts)
    covered = np.zeros(2048)
    for items, x in solution.items():
        assert x > 0 and sum(k * n for k, n in items) <= 2048
        for k, n in items:
            covered[k - 1] += n * x
    assert np.allclose(covered, counts, rtol=1e-6)                 # every length, and none more than it occurs
    bound = counts @ np.arange(1, 2049) / 2048
    if name in ("dense", "skewed"):
        assert sum(solution.values()) <= 1.002 * bound
        part = packing.shares(packing.plan(counts))
        pieces = {k: n for k, (_, n) in part.items()}
        assert pieces["program"] >= 0.9 * counts.sum() and sum(pieces.values()) == counts.sum()
        assert sum(n for n, _ in part.values()) <= 1.002 * bound + 1


def test_a_word_before_punctuation_is_not_merged_twice():
    encoder = PieceEncoder()
    merged, learn = [], encoder._whole("a house, a house. A garden; (garden) Gardens!").__len__()
    words = "a house a garden, a house. garden; house! (garden)"

    class Model:
        def __init__(self, model):
            self.model = model

        def tokenize(self, text):
            merged.append(text)
            return self.model.tokenize(text)

    encoder.model = Model(encoder.model)
    assert learn and list(encoder.encode(words)) == encoder.tokenizer.encode(words, add_special_tokens=False).ids
    assert sum(t == encoder.blank + "house" for t in merged) == 1


def test_texts_are_split_in_small_slices():
    from footfall.llm import bpe
    assert bpe.SLICE_BYTES <= 4_000_000 and bpe.MAX_PIECES <= 200_000


def test_a_word_is_remembered_without_what_follows_it():
    encoder = PieceEncoder()
    texts = ["So kalt, kalt. kalt! süß; süß? süß", "kalt) süß,"]
    got = [np.frombuffer(raw, "<u4").tolist() for raw in encoder.each_bytes(pa.array(texts))]
    assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert set(encoder.pieces) - {""} == {"kalt", "süß"}


def _counted(encoder):
    """What the merge model and the batches of the library get."""
    merged, batches = [], []

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def tokenize(self, text):
            merged.append(text)
            return self.inner.tokenize(text)

        def encode_batch_fast(self, texts, **kw):
            batches.append(texts)
            return self.inner.encode_batch_fast(texts, **kw)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    encoder.model, encoder.tokenizer = Counted(encoder.model), Counted(encoder.tokenizer)
    return merged, batches


def test_new_words_of_a_column_go_to_the_library_in_batches(library):
    encode, _ = library
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijkléüÖ") for _ in range(rng.randrange(1, 12))) for _ in range(5000)]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", ",", ".", "!)"]) for _ in range(60)) for _ in range(300)]
    encoder = PieceEncoder()
    merged, batches = _counted(encoder)
    for _ in range(2):                       # and once more from memory
        got = [np.frombuffer(raw, "<u4").tolist() for raw in encoder.each_bytes(pa.array(texts))]
        assert got == [encode(t) for t in texts]
    assert len(merged) <= 2 * len(texts) + 10 and 1 <= len(batches) <= 6      # each text's first piece; marks


def test_columns_of_odd_texts_equal_the_library(library):
    encode, _ = library
    rng = random.Random(3)
    parts = ["word", "Wort,", "é!", "\n", " ", " ", " ", "don't", "x1.", "\t", "...", "\x1c", "日本,", "\xa0", "a\u0301", "ªº.", "×"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)] + ["", " ", "\n", "a ", "a\n"]
    got = [np.frombuffer(raw, "<u4").tolist() for raw in PieceEncoder().each_bytes(pa.array(texts))]
    assert got == [encode(t) for t in texts]
    assert list(PieceEncoder().each_bytes(pa.array(["", ""]))) == [b"", b""]


def test_words_are_not_joined_beside_a_special_token_with_a_blank(tmp_path):
    import json

    from tokenizers import Tokenizer
    with open(vocabulary_path(), encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"].append({**spec["added_tokens"][0], "id": 50257, "content": "b c"})
    path = tmp_path / "blank.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    tokenizer, texts = Tokenizer.from_file(str(path)), ["a ab x", "a cd x", "a b c d"]
    encoder = PieceEncoder(str(path))
    got = [np.frombuffer(raw, "<u4").tolist() for raw in encoder.each_bytes(pa.array(texts))]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def _letters(rng, alphabet, n):
    return sorted({"".join(rng.choice(alphabet) for _ in range(rng.randrange(3, 9))) for _ in range(n)})


def test_ascii_words_skip_the_pre_tokenizer(library):
    encode, _ = library
    rng = random.Random(10)
    words = _letters(rng, "abcdefghiJKL", 1500) + _letters(rng, "éüÖßāz", 700)
    rng.shuffle(words)
    texts = ["x " + " ".join(words[k:k + 50]) for k in range(0, len(words), 50)]
    encoder = PieceEncoder()
    _, batches = _counted(encoder)
    got = [np.frombuffer(raw, "<u4").tolist() for raw in encoder.each_bytes(pa.array(texts))]
    assert got == [encode(t) for t in texts]
    sent = " ".join(t for batch in batches for t in batch).split()
    assert sorted(sent) == sorted(w for w in words if not w.isascii())


def test_words_used_last_are_remembered_up_to_a_size(monkeypatch, library):
    from footfall.llm import bpe
    encode, _ = library
    monkeypatch.setattr(bpe, "WORD_BYTES", 20_000)
    rng = random.Random(11)
    often = _letters(rng, "éüÖß", 100)
    encoder = PieceEncoder()
    _, batches = _counted(encoder)
    for k in range(20):
        rare = _letters(rng, "āēīō", 100)
        texts = ["x " + " ".join(often), "y " + " ".join(w + "," for w in rare)]
        got = [np.frombuffer(raw, "<u4").tolist() for raw in encoder.each_bytes(pa.array(texts))]
        assert got == [encode(t) for t in texts]
        assert sum(len(w.encode()) + len(ids) + 12 for w, ids in zip(
            *(x.to_pylist() for x in encoder.words), strict=True)) <= 20_000
    sent = " ".join(t for batch in batches for t in batch).split()
    assert all(sent.count(w) == 1 for w in often)


def test_long_and_many_marks_after_words_equal_the_library(library):
    encode, _ = library
    texts = ["a word" + "." * n + " word" + "!)" * (n % 7) + " ñu" + "-" * n for n in range(60)]
    got = [np.frombuffer(raw, "<u4").tolist() for raw in PieceEncoder().each_bytes(pa.array(texts))]
    assert got == [encode(t) for t in texts]
