"""Best-fit packing of token pieces into sequences of a fixed length.

The lengths of all pieces form a histogram of at most ``capacity`` entries,
whatever the input's size; only that histogram reaches the driver.  There the
configuration linear program (how often to use each filling of a sequence, so
that every length is covered as often as it occurs) is solved by
multiplicative weights: a length's price falls with the share of it that is
covered, a knapsack dynamic program prices the best filling, and all fillings
within TOLERANCE of it are used until a round has covered STEP of a length.
Rounds go on until every length is covered, so their number grows with the
lengths that occur.  The solution is rounded to whole sequences: the most used
filling first, its uses rounded up as far as pieces are left.  The pieces that
rounding leaves are packed best-fit decreasing.  The fillings number some
thousands at most, again whatever the input's size.

Pieces are numbered within their length in Spark, in parts so that a common
length is never one group, and a number is turned into a sequence and an
offset by looking up the fillings.

Defined results: a null text is an empty text, whose only token is the end
id; every row is packed, repeated rows too (pieces of equal rows are
interchangeable); extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.bpe import DEFAULT_VOCABULARY, encoder_for
from footfall.llm.common import id_text, stored, table, tasks_for

CAPACITY = 2048
STEP = 0.25                   # share of a length that one round covers at most
SHARPNESS = 4.0               # how fast a covered length loses its price
TOLERANCE = 0.01              # value that a filling may lack of the best one's
FULL = 0.98                   # share of a sequence that a rounded filling must use
PIECES_PER_TASK = 20_000


@dataclass(frozen=True)
class Filling:
    """One way to fill a sequence: lengths in descending order with their
    counts, used for ``times`` sequences; ``by`` is the part of the plan that
    it comes from (full, program, fit)."""
    items: tuple[tuple[int, int], ...]
    times: int
    by: str = "program"


def price(values: np.ndarray) -> np.ndarray:
    """Best value for each room 0 ... capacity that lengths 1 ... capacity of
    these values can give: unbounded knapsack by dynamic programming."""
    capacity = len(values)
    best, back = np.zeros(capacity + 1), values[::-1].copy()
    for room in range(1, capacity + 1):
        best[room] = (back[capacity - room:] + best[:room]).max()
    return best


def _fill_up(length: int, values: np.ndarray, best: np.ndarray, need: np.ndarray, least: float) -> dict[int, int] | None:
    """A filling with ``length``, worth ``least`` or more, of lengths that
    still have need, or None: piece by piece the one that leaves most value."""
    items, room, worth = {length: 1}, len(values) - length, values[length - 1]
    while room:
        gains = np.where(need[:room] > 0, values[:room] + best[room - 1::-1], 0.0)
        k = room - 1 - int(gains[::-1].argmax())                     # the longest of the best
        if gains[k] <= 0 or worth + gains[k] < least:
            break
        items[k + 1] = items.get(k + 1, 0) + 1
        worth += values[k]
        room -= k + 1
    return items if worth >= least else None


def solve(counts: np.ndarray, step: float = STEP, sharpness: float = SHARPNESS,
          tolerance: float = TOLERANCE) -> dict[tuple[tuple[int, int], ...], float]:
    """Fractional solution of the covering program: filling -> times.

    ``counts[l - 1]`` is the number of pieces of length l.  A length is worth
    its tokens times exp(-sharpness * covered share).  A round prices rooms,
    then gives every length, longest first, fillings of nearly the best value
    until ``step`` of the lengths in them is covered."""
    capacity = len(counts)
    lengths, demand = np.arange(1, capacity + 1), np.maximum(counts, 1).astype(float)
    covered, found = np.where(counts > 0, 0.0, 1.0), {}
    while (covered < 1).any():
        open_ = covered < 1
        values = np.where(open_, lengths * np.exp(-sharpness * (covered - covered[open_].min())), 0.0)
        best = price(values)
        need = np.where(open_, np.minimum(step, 1 - covered), 0.0) * demand
        least = (1 - tolerance) * best[capacity]
        for length in lengths[open_ & (values + best[capacity - lengths] >= least)][::-1]:
            while need[length - 1] > 0:
                items = _fill_up(int(length), values, best, need, least)
                if items is None:
                    break
                times = min(need[k - 1] / n for k, n in items.items())
                for k, n in items.items():
                    need[k - 1] -= n * times
                    covered[k - 1] += n * times / demand[k - 1]
                    if need[k - 1] <= 1e-9 * demand[k - 1]:
                        need[k - 1] = 0.0
                    if covered[k - 1] > 1 - 1e-9:
                        covered[k - 1] = 1.0
                key = tuple(sorted(items.items(), reverse=True))
                found[key] = found.get(key, 0.0) + times
    return found


def rounded(counts: np.ndarray, solution: dict[tuple[tuple[int, int], ...], float],
            full: float = FULL) -> tuple[list[Filling], np.ndarray]:
    """Whole sequences from a fractional solution and the pieces left over."""
    left, chosen = counts.astype(np.int64).copy(), []
    for items, x in sorted(solution.items(), key=lambda c: (-c[1], c[0])):
        if sum(k * n for k, n in items) < full * len(counts):
            continue
        times = min(int(np.ceil(x - 1e-9)), min(int(left[k - 1]) // n for k, n in items))
        if times > 0:
            for k, n in items:
                left[k - 1] -= n * times
            chosen.append(Filling(items, times))
    return chosen, left


def best_fit(left: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Best-fit decreasing over counts: the longest piece first, then always
    the longest that still fits; the filling is used as often as it goes."""
    out, left = [], left.copy()
    capacity = len(left)
    while left.any():
        filling, room = np.zeros(capacity, np.int64), capacity
        while room:
            fits = np.flatnonzero(left[:room] > filling[:room])
            if not len(fits):
                break
            length = int(fits[-1]) + 1
            take = min(room // length, int(left[length - 1] - filling[length - 1]))
            filling[length - 1] += take
            room -= take * length
        used = filling > 0
        times = int((left[used] // filling[used]).min())
        left -= times * filling
        out.append((filling, times))
    return out


def plan(counts: np.ndarray, step: float = STEP) -> list[Filling]:
    """Fillings that pack exactly the pieces counted."""
    left, out = counts.astype(np.int64).copy(), []
    if left[-1]:                                 # full pieces are sequences of their own
        out.append(Filling(((len(left), 1),), int(left[-1]), "full"))
        left[-1] = 0
    chosen, left = rounded(left, solve(left, step))
    for filling, times in best_fit(left):
        chosen.append(Filling(tuple((int(i) + 1, int(filling[i])) for i in np.flatnonzero(filling)[::-1]), times, "fit"))
    return out + chosen


def shares(fillings: list[Filling]) -> dict[str, tuple[int, int]]:
    """(sequences, pieces) of each part of a plan."""
    out = {}
    for f in fillings:
        a, b = out.get(f.by, (0, 0))
        out[f.by] = a + f.times, b + f.times * sum(n for _, n in f.items)
    return out


def slots(fillings: list[Filling]) -> dict[int, np.ndarray]:
    """For each length: rows (first number, first sequence, count in a
    sequence, offset there), in order of the first number."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for f in fillings:
        offset = 0
        for length, n in f.items:
            start = taken.get(length, 0)
            rows.setdefault(length, []).append((start, sequence, n, offset))
            taken[length] = start + n * f.times
            offset += n * length
        sequence += f.times
    return {k: np.array(v, np.int64) for k, v in rows.items()}


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, vocabulary: str = DEFAULT_VOCABULARY,
                 with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of each document's ids and end id; of a document longer than
    ``capacity`` all pieces but the first have that length."""
    src = id_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = np.array([end_id], "<u4").tobytes()
        with encoder_for(vocabulary) as encoder:
            for batch in batches:
                rows, piece, start, length, crc, ids = [], [], [], [], [], []
                for row, raw in enumerate(encoder.each_bytes(batch.column(1))):
                    raw += tail
                    n = len(raw) // 4
                    a, k = 0, 0
                    while a < n:
                        b = a + ((n - a) % capacity or capacity)
                        part = raw[4 * a:4 * b]
                        rows.append(row), piece.append(k), start.append(a), length.append(b - a)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                        a, k = b, k + 1
                columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
                               + (", ids array<int>" if with_ids else ""))


def pack(pieces: DataFrame, capacity: int = CAPACITY, step: float = STEP) -> DataFrame:
    """``pieces`` (from ``token_pieces``) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    pieces = stored(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    counts = np.zeros(capacity, np.int64)
    for length, n in histogram.items():
        counts[length - 1] = n
    places = spark.sparkContext.broadcast(slots(plan(counts, step)))     # a few thousand fillings at most

    parts = tasks_for(spark, int(counts.sum()), PIECES_PER_TASK)
    own = ["doc_id", "piece", "start", "ids_crc32"]
    dealt = pieces.withColumn("_part", F.pmod(F.xxhash64(*own), F.lit(parts)).cast("int"))
    sizes = dealt.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    before = sizes.select("length", "_part", (F.sum("_n").over(
        Window.partitionBy("length").orderBy("_part")) - F.col("_n")).alias("_before"))
    ranked = dealt.withColumn("_rank", F.row_number().over(
        Window.partitionBy("length", "_part").orderBy(*own)) - 1)
    numbered = ranked.join(before, ["length", "_part"]).withColumn("_number", F.col("_before") + F.col("_rank"))
    numbered = numbered.select(*pieces.columns, "_number")
    width = len(pieces.columns)
    names = pieces.columns
    k_length = names.index("length")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch.column(k_length).to_numpy(), batch.column(width).to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1))
            for rows in np.split(order, edges[1:]):
                if not len(rows):
                    continue
                size = int(length[rows[0]])
                table_ = places.value[size]
                hit = np.searchsorted(table_[:, 0], number[rows], "right") - 1
                first, seq, n, off = table_[hit].T
                r = number[rows] - first
                sequence[rows] = seq + r // n
                offset[rows] = off + (r % n) * size
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    return numbered.mapInArrow(place, fields + ", sequence_id bigint, offset bigint")


def query(spark, sf_dir):
    return pack(token_pieces(table(spark, sf_dir, "documents")))
