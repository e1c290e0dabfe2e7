"""Token-id files compressed by a Re-Pair grammar per block.

Documents are range-partitioned by doc_id, encoded, and their ids, each
document's end id included, written as blocks of whole documents.  In a block
frequent pairs of neighbouring ids are replaced by new symbols, round after
round until no pair is frequent: a round counts pairs (after the first one only those
beside a symbol of the round before, since no other can be frequent), gives
every frequent one a rule, and replaces its occurrences from left to right.  A block keeps the rules, the length that
each symbol expands to, and the remaining sequence, so a document is decoded
from the symbols that cover it, found by the running sum of lengths.

The file format is a Parquet table with one row a block, written by Spark to a
folder that all executors share: task attempts are committed as usual, and a
lost executor costs a retry.

Defined results: a null text is an empty text (its only id is the end id);
rows with equal doc_id follow each other in order of their text, and a null
doc_id comes first; a text longer than a block is a block of its own; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.bpe import DEFAULT_VOCABULARY, encoder_for
from footfall.llm.common import id_text, scratch_path, table, tasks_for

BLOCK_TOKENS = 1 << 18
MIN_COUNT = 24               # a pair rarer than this in a block gets no rule
DOCS_PER_TASK = 4_000
_BITS = 17                   # width of the table that counts pairs

_RAW = [("block", "bigint"), ("doc_ids", "array<{}>"), ("lengths", "array<bigint>"), ("terminals", "bigint"),
        ("rules", "binary"), ("rounds", "binary"), ("expansion", "binary"), ("symbols", "binary")]
_PACKED = [n for n, t in _RAW if t == "binary"]       # little-endian unsigned 32-bit integers


def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - _BITS)


def _frequent(seq: np.ndarray, min_count: int, newest: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(frequent pairs, places of their occurrences, pair of each place) of
    the pairs with a symbol from ``newest`` on.

    In a slot that holds enough occurrences one pair is counted directly; the
    others there are sorted, if they are still enough."""
    if newest:
        fresh = seq >= newest
        at = np.flatnonzero(fresh[:-1] | fresh[1:])
        slot = _slot(seq[at], seq[at + 1])
    else:
        at, slot = np.arange(len(seq) - 1), _slot(seq[:-1], seq[1:])
    often = (np.bincount(slot, minlength=1 << _BITS) >= min_count)[slot]
    at, slot = at[often], slot[often]
    key = (seq[at].astype(np.uint64) << np.uint64(32)) | seq[at + 1]
    one = np.zeros(1 << _BITS, np.uint64)
    one[slot] = key
    direct = one[slot] == key
    n = np.bincount(slot[direct], minlength=1 << _BITS)
    slots = np.flatnonzero(n >= min_count)
    rest = np.flatnonzero(~direct)
    rest = rest[(np.bincount(slot[rest], minlength=1 << _BITS) >= min_count)[slot[rest]]]
    others, which, count = np.unique(key[rest], return_inverse=True, return_counts=True)
    rule = np.full(1 << _BITS, -1, np.int64)
    rule[slots] = np.arange(len(slots))
    later = np.full(len(others), -1, np.int64)
    later[count >= min_count] = len(slots) + np.arange(int((count >= min_count).sum()))
    r = np.where(direct, rule[slot], -1)
    r[rest] = later[which]
    pairs = np.concatenate([one[slots], others[count >= min_count]])
    return pairs, at[r >= 0], r[r >= 0]


def compress(ids: np.ndarray, terminals: int, rounds: int | None = None, min_count: int = MIN_COUNT):
    """(rules as pairs, first rule of each round, expansion length of each
    rule, remaining symbols); symbol ``terminals + k`` is rule k.  Without
    ``rounds`` they go on until no pair is frequent."""
    seq = ids.astype(np.uint32)
    rules, starts, lengths, newest = np.empty((0, 2), np.uint32), [0], np.empty(0, np.int64), 0
    while len(seq) > min_count and (rounds is None or len(starts) <= rounds):
        # a round leaves no occurrence of a frequent pair, and the rare ones only
        # lose some: what is frequent next has a symbol of the round before
        pairs, at, r = _frequent(seq, min_count, newest)
        if not len(pairs):
            break
        # of neighbouring occurrences that overlap, every other one from the left
        begins = np.diff(at, prepend=-2) != 1
        run_start = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
        use = (np.arange(len(at)) - run_start) % 2 == 0
        at, r = at[use], r[use]
        # a pair whose occurrences all overlap others gets no rule now
        used = np.bincount(r, minlength=len(pairs)) > 0
        pairs, r = pairs[used], (np.cumsum(used) - 1)[r]
        new = np.column_stack([(pairs >> np.uint64(32)).astype(np.uint32), pairs.astype(np.uint32)])
        length = lambda s, known=lengths: np.where(
            s < terminals, 1, known[np.maximum(s.astype(np.int64) - terminals, 0)] if len(known) else 1)
        added = length(new[:, 0]) + length(new[:, 1])
        seq[at] = (terminals + len(rules) + r).astype(np.uint32)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, newest = seq[keep], terminals + len(rules)
        rules, lengths = np.concatenate([rules, new]), np.concatenate([lengths, added])
        starts.append(len(rules))
    return rules, np.array(starts, np.int32), lengths, seq


def _undo(seq: np.ndarray, terminals: int, rules: np.ndarray, starts: np.ndarray) -> np.ndarray:
    for low in starts[:-1][::-1]:
        # rules of this round and later ones are gone above; those from `low` on go now
        is_rule = seq >= terminals + int(low)
        if not is_rule.any():
            continue
        out = np.repeat(seq, np.where(is_rule, 2, 1))
        at = np.flatnonzero(is_rule)
        at = at + np.arange(len(at))
        r = seq[is_rule].astype(np.int64) - terminals
        out[at], out[at + 1] = rules[r, 0], rules[r, 1]
        seq = out
    return seq


class Block:
    """One row of the files; decodes any range of its ids."""

    def __init__(self, terminals: int, rules, rounds, expansion, symbols):
        self.terminals = int(terminals)
        self.rules = np.asarray(rules, np.int64).astype(np.uint32).reshape(-1, 2)
        self.starts = np.asarray(rounds, np.int64)
        self.expansion = np.asarray(expansion, np.int64)
        self.symbols = np.asarray(symbols, np.int64).astype(np.uint32)
        size = np.ones(len(self.symbols), np.int64)
        big = self.symbols >= self.terminals
        size[big] = self.expansion[self.symbols[big].astype(np.int64) - self.terminals]
        self.ends = np.cumsum(size)

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids from ``start`` to ``end``, from the symbols that cover them."""
        end = int(self.ends[-1]) if end is None and len(self.ends) else int(end or 0)
        if start >= end:
            return np.empty(0, np.uint32)
        a = int(np.searchsorted(self.ends, start, "right"))
        b = int(np.searchsorted(self.ends, end, "left")) + 1
        before = int(self.ends[a - 1]) if a else 0
        return _undo(self.symbols[a:b], self.terminals, self.rules, self.starts)[start - before:end - before]


def write(docs: DataFrame, path: str, end_id: int = 2, vocabulary: str = DEFAULT_VOCABULARY,
          id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the token files of ``docs`` in ascending doc_id order."""
    src = id_text(docs, id_col, text_col)
    spark = docs.sparkSession
    parts = tasks_for(spark, src.count(), DOCS_PER_TASK)
    # the text's hash in the key: one id on very many rows is still split
    dealt = (src.withColumn("_h", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "_h")
             .sortWithinPartitions("doc_id", "_h", "text").withColumn("_part", F.spark_partition_id())
             .select("doc_id", "text", "_part"))
    kind = src.schema["doc_id"].dataType
    fields = [(n, t.format(kind.simpleString())) for n, t in _RAW]
    arrow_id = dealt.limit(0).toArrow().schema.field("doc_id").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = np.array([end_id], "<u4").tobytes()
        encoder = encoder_for(vocabulary)
        terminals = max(len(encoder.token_bytes()), end_id + 1)
        doc_ids, texts, size, number = [], [], 0, 0

        def block():
            ids = np.frombuffer(b"".join(texts), "<u4")
            rules, starts, lengths, seq = compress(ids, terminals)
            # 2^32 blocks of one partition at most: blocks are numbered in doc_id order
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number], pa.int64()), pa.array([doc_ids], pa.list_(arrow_id)),
                 pa.array([np.array([len(t) // 4 for t in texts], np.int64)], pa.list_(pa.int64())),
                 pa.array([terminals], pa.int64()),
                 *(pa.array([x.astype("<u4").tobytes()], pa.binary()) for x in (rules, starts, lengths, seq))],
                names=[n for n, _ in fields])

        part = 0
        with encoder:
            for batch in batches:
                part = batch.column(2)[0].as_py() if batch.num_rows else part
                for doc_id, raw in zip(batch.column(0).to_pylist(), encoder.each_bytes(batch.column(1)), strict=True):
                    raw += tail
                    if texts and size + len(raw) // 4 > BLOCK_TOKENS:
                        yield block()
                        doc_ids, texts, size, number = [], [], 0, number + 1
                    doc_ids.append(doc_id), texts.append(raw)
                    size += len(raw) // 4
            if texts:
                yield block()

    dealt.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in fields)).write.parquet(path)


def read(spark: SparkSession, path: str, id_type: T.DataType | None = None) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before),
    n_tokens and the crc32 of the decoded ids."""
    schema = ", ".join(f"{n} {t.format((id_type or T.LongType()).simpleString())}" for n, t in _RAW)
    blocks = spark.read.schema(schema).parquet(path)
    part = F.shiftright("block", 32)
    totals = blocks.select("block", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    per_part = totals.groupBy(part.alias("part")).agg(F.sum("n").alias("n"))
    # one row a partition of the files; inside it the blocks are few
    part_start = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("s"))
    inside = totals.select("block", part.alias("part"), (F.sum("n").over(
        Window.partitionBy(part).orderBy("block")) - F.col("n")).alias("i"))
    starts = inside.join(part_start, "part").select("block", (F.col("s") + F.col("i")).alias("first"))
    kind = (id_type or T.LongType()).simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                column = lambda name: batch.column(batch.schema.get_field_index(name))[k]  # noqa: B023, E731
                block = Block(column("terminals").as_py(), *(np.frombuffer(column(n).as_buffer(), "<u4") for n in _PACKED))
                lengths = column("lengths").values.to_numpy()
                ids = block.ids().astype("<u4")
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([column("block").as_py()] * len(crc), pa.int64()), column("doc_ids").values,
                     pa.array(ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["block", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = blocks.mapInArrow(run, f"block bigint, doc_id {kind}, at bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(starts, "block").select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "token-files")
    write(docs, path)
    return read(spark, path, docs.schema["doc_id"].dataType)
