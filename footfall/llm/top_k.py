"""Exact top-k search by multi-resolution segment statistics.

Every component x becomes floor(64 * x).  A vector is split into segments at
several resolutions; each segment keeps its mean and its deviation (the norm
of what the mean leaves).  Two vectors are at least as far apart as the sum,
over segments, of length * (difference of means)^2 + (difference of
deviations)^2, and the inner product is (|q|^2 + |c|^2 - distance^2) / 2, so a
lower bound on the distance is an upper bound on the score.  A block of
queries meets a block of candidates: coarse bounds first, finer ones for the
pairs left, exact scores for the survivors, each against the query's k-th best
score so far.  Candidates of a block stand in order of their norm, so that
good scores come early.

Queries are a stated set (ids divisible by ``every``), held in blocks; each
block reads all candidates, cut in ranges that go to tasks of their own; the k
best per query and range are merged.  The work is queries x candidates in the worst
case, in memory of one block by one batch.

Defined results: vectors that are null, empty, or hold a null or non-finite
component take no part, nor do vectors whose inner product with themselves
exceeds a long (no product of the others can); only vectors of one length are
compared.  A query with
fewer than k other vectors gets them all.  Equal scores go to the smaller id.
A candidate is every row but the query's own, so rows that share an id are
candidates of each other and each has its own result; a null id takes no
part.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stored, table

LEVELS = (1, 4, 16)           # segments at each resolution
MOST_NORM = 2.0 ** 62         # of a vector's whole numbers, squared and summed
QUERY_BLOCK = 1024
SLICE_ROWS = 4_096            # candidates in a row of the join
RANGE_ROWS = 65_536           # candidates that a query block meets in one task
LEAST_RANGES = 64             # ranges of a smaller table, for parallel work
SLICE = 512                   # candidates that meet a query block at once


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, v): v holds the integer components."""
    v = F.col(vector_col)
    good = F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    size = F.aggregate(v, F.lit(0.0), lambda a, x: a + F.pow(F.lit(64.0) * F.abs(x.cast("double")) + 1, 2))
    return vectors.where(good).where(size < MOST_NORM).select(
        F.col(id_col).alias("id"), F.size(v).alias("dim"),
        F.transform(v, lambda x: F.floor(F.lit(64) * x.cast("double")).cast("double")).alias("v"))


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows of sqrt(length) * mean and deviation for each segment, so that the
    bound on the inner product is an inner product, too."""
    parts = np.array_split(np.arange(x.shape[1]), min(segments, x.shape[1]))
    out = []
    for p in parts:
        mean = x[:, p].mean(axis=1)
        rest = x[:, p] - mean[:, None]
        out += [mean * np.sqrt(len(p)), np.sqrt((rest * rest).sum(axis=1))]
    return np.column_stack(out)


class Scorer:
    """k best of a block of query rows over the candidate slices it is shown.
    ``uid`` tells rows apart, ``ids`` name them."""

    def __init__(self, uid: np.ndarray, x: np.ndarray, k: int):
        self.uid, self.x, self.k = uid, x, k
        self.levels = [statistics(x, s) for s in LEVELS]
        self.valid = np.zeros((len(uid), 0), bool)
        self.best_id = self.best_score = np.zeros((len(uid), 0), np.int64)
        self.exact = self.seen = 0

    def _keep(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Merge survivors, given as (query row, id, score)."""
        if not len(rows):
            return
        n = len(self.uid)
        r = np.concatenate([np.nonzero(self.valid)[0], rows])
        i = np.concatenate([self.best_id[self.valid], ids])
        s = np.concatenate([self.best_score[self.valid], scores])
        order = np.lexsort((i, -s, r))
        r, i, s = r[order], i[order], s[order]
        rank = np.arange(len(r)) - np.searchsorted(r, np.arange(n))[r]
        top = rank < self.k
        r, i, s, rank = r[top], i[top], s[top], rank[top]
        shape = n, int(rank.max()) + 1
        self.valid, self.best_id, self.best_score = (np.zeros(shape, t) for t in (bool, np.int64, np.int64))
        self.valid[r, rank], self.best_id[r, rank], self.best_score[r, rank] = True, i, s

    def _floor(self) -> np.ndarray:
        """The k-th best score so far, else minus infinity."""
        if self.valid.shape[1] < self.k:
            return np.full(len(self.uid), -np.inf)
        return np.where(self.valid[:, self.k - 1], self.best_score[:, self.k - 1], -np.inf)

    def meet(self, uid: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        floor = self._floor()
        bound = self.levels[0] @ statistics(x, LEVELS[0]).T
        slack = 1e-9 * (1 + np.abs(bound))
        qi, ci = np.nonzero(bound + slack >= floor[:, None])
        self.seen += bound.size
        for level, segments in enumerate(LEVELS[1:], 1):
            if len(qi) == 0:
                return
            stats = statistics(x, segments)
            if len(qi) * 4 > bound.size:        # most pairs left: one product for all
                fine = (self.levels[level] @ stats.T)[qi, ci]
            else:
                fine = np.einsum("ij,ij->i", self.levels[level][qi], stats[ci])
            left = fine + 1e-9 * (1 + np.abs(fine)) >= floor[qi]
            qi, ci = qi[left], ci[left]
        other = self.uid[qi] != uid[ci]
        qi, ci = qi[other], ci[other]
        self.exact += len(qi)
        if not len(qi):
            return
        most = float(np.abs(self.x).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1]
        if most < 2 ** 53:                      # whole numbers that a double holds exactly
            if len(qi) * 4 > bound.size:
                scores = (self.x @ x.T)[qi, ci].astype(np.int64)
            else:
                scores = np.einsum("ij,ij->i", self.x[qi], x[ci]).astype(np.int64)
        else:
            scores = np.array([sum(int(a) * int(b) for a, b in zip(self.x[q], x[c], strict=True))
                               for q, c in zip(qi, ci, strict=True)], np.int64)
        better = scores >= floor[qi]
        self._keep(qi[better], ids[ci[better]], scores[better])


def search(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best of every query."""
    rows = stored(usable(vectors, id_col, vector_col).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    is_query = F.col("id") % every == 0
    n, q = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    slices, blocks = max(1, -(-n // SLICE_ROWS)), max(1, -(-q // QUERY_BLOCK))
    ranges = max(-(-n // RANGE_ROWS), min(slices, LEAST_RANGES))

    # one row a query block, QUERY_BLOCK vectors or so; each goes to every range of candidates
    queries = (rows.where(is_query).groupBy("dim", F.pmod(F.xxhash64("uid"), F.lit(blocks)).alias("block"))
               .agg(F.collect_list(F.struct("uid", "id", "v")).alias("q"))
               .select("dim", "block", F.col("q.uid").alias("q_uid"), F.col("q.id").alias("q_id"),
                       F.flatten("q.v").alias("q_v"), F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("range")))
    # one row a slice, SLICE_ROWS vectors or so, the longest first; a range is some slices
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    candidates = (rows.groupBy("dim", F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(slices)).alias("slice"))
                  .agg(F.sort_array(F.collect_list(F.struct((-norm).alias("o"), "uid", "id", "v"))).alias("c"))
                  .select("dim", (F.col("slice") % ranges).cast("int").alias("range"), F.col("c.uid").alias("c_uid"),
                          F.col("c.id").alias("c_id"), F.flatten("c.v").alias("c_v")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, scorer, ids = None, None, None

        def best():
            at = np.nonzero(scorer.valid)
            return pa.RecordBatch.from_arrays(
                [pa.array(scorer.uid[at[0]]), pa.array(ids[at[0]]), pa.array(scorer.best_id[at]),
                 pa.array(scorer.best_score[at])], names=["uid", "query_id", "vec_id", "score"])

        for batch in batches:
            for r in range(batch.num_rows):
                own = tuple(batch.column(k)[r].as_py() for k in range(3))
                q_uid, q_id, q_v, c_uid, c_id, c_v = (batch.column(k)[r].values.to_numpy() for k in range(3, 9))
                if own != key:              # slices that meet one block in one range come in a row
                    if scorer is not None:
                        yield best()
                    key, ids, scorer = own, q_id, Scorer(q_uid, q_v.reshape(len(q_id), -1), k_best)
                c_x = c_v.reshape(len(c_id), -1)
                for a in range(0, len(c_id), SLICE):
                    scorer.meet(c_uid[a:a + SLICE], c_id[a:a + SLICE], c_x[a:a + SLICE])
        if scorer is not None:
            yield best()

    k_best = k
    found = queries.join(candidates, ["dim", "range"]).select(
        "dim", "range", "block", "q_uid", "q_id", "q_v", "c_uid", "c_id", "c_v").mapInArrow(
        run, "uid bigint, query_id bigint, vec_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"))


ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as x
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.vec_id as query_id, b.vec_id as vec_id, cast(list_dot_product(
           list_transform(a.x, lambda i: cast(i as double)), list_transform(b.x, lambda i: cast(i as double)))
         as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id and a.vec_id % 20 = 0 and len(a.x) = len(b.x)),
ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 20"""
