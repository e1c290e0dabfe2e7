"""Small helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.session import ensure_checkpoint_dir


def release_memory() -> None:
    """Hand memory that is free inside a Python worker back to the machine: a
    worker outlives its task, and what it keeps adds up over the stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)         # GNU's C library has it
    if trim is not None:
        trim(0)


def reuse_memory() -> None:
    """Let a Python worker use freed arrays of up to 32 MB again, instead of
    having the machine clear new pages for each, from the start as far as the C
    library goes by and by; release_memory hands them back."""
    set_option = getattr(ctypes.CDLL(None), "mallopt", None)       # GNU's C library has it
    if set_option is not None:
        set_option(-3, 32 << 20)           # M_MMAP_THRESHOLD
        set_option(-1, 64 << 20)           # M_TRIM_THRESHOLD


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage
    ends at the files, so a lost executor costs a re-read only."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with a null text as the empty text; other columns,
    whatever their names, are left out."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def tasks_for(spark: SparkSession, n_rows: int, rows_per_task: int) -> int:
    """Partition count that grows with the rows."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-n_rows // rows_per_task))


LEAST_BITS, MOST_BITS = 20, 26      # size of a filter: 128 kB to 8 MB


def keyed(texts: DataFrame) -> DataFrame:
    """``texts`` with th, a 128-bit hash that tells rows of one doc_id apart."""
    two = (F.xxhash64("text"), F.xxhash64(F.lit(1), "text"))
    return texts.withColumn("th", F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in two])))


def membership(keys: DataFrame) -> Callable[[Column], Column]:
    """A test whether a long may be among the distinct longs of ``keys``' first
    column: never false for one that is, seldom true for another.

    It is a bitmap of 16 bits a key, within fixed bounds; of more keys than
    MOST_BITS allows, it lets the more others through, so it only ever saves a
    join's shuffle, and the exact join follows."""
    spark = keys.sparkSession
    name = keys.columns[0]
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * keys.count()).bit_length()))
    bit = F.pmod(F.xxhash64(name), F.lit(1 << bits))
    words = (keys.select(bit.alias("bit")).groupBy(F.expr("cast(bit div 32 as int)").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1, cast(bit % 32 as int)))").alias("bits")).toArrow())
    bitmap = np.zeros(1 << (bits - 5), np.uint32)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint32)
    held = spark.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def maybe(bit: pa.Array) -> pa.Array:
        b = bit.to_numpy()
        return pa.array((held.value[b >> 5] >> (b & 31).astype(np.uint32)) & 1 == 1)

    return lambda key: maybe(F.pmod(F.xxhash64(key), F.lit(1 << bits)))


def row_hash() -> Column:
    """One long for a row's doc_id and th, for ``membership``."""
    return F.xxhash64("doc_id", "th")


def probable_owners(texts: DataFrame, owners: DataFrame) -> DataFrame:
    """The rows of ``texts`` for all documents in ``owners`` (doc_id, th) and,
    by chance, some others; a join on both then drops these."""
    return texts.where(membership(owners.select(row_hash().alias("key")).distinct())(row_hash()))


WEIGHT_MOST = 1024            # rows that one counted row stands for when rows are numbered
NUMBERED_PER_TASK = 100_000


def field_text(column: str) -> Column:
    """One field of a record as text that no other record shares: `-` for
    null, else the value's UTF-8 byte count, a colon and the value."""
    value = F.col(column).cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def ascii_lower(column: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` (with ``n``, the number of equal rows each one stands for, and
    ``group`` columns without nulls) with ``start``, the rows before it in its
    group by ``order``, and ``total``, the rows of the group.

    A row that stands for more than WEIGHT_MOST rows is cut into several, and
    the order is dealt by range, so neither a group nor a repeated row is ever
    one task.  Sums of the ranges give each range its first number."""
    spark = rows.sparkSession
    cut = F.explode(F.expr(f"sequence(0L, n - 1, {WEIGHT_MOST}L)"))
    rows = stored(rows.where("n > 0").withColumn("_from", cut)
                  .withColumn("n", F.least(F.lit(WEIGHT_MOST).cast("bigint"), F.col("n") - F.col("_from"))), name)
    parts = tasks_for(spark, rows.count(), NUMBERED_PER_TASK)
    order = [*order, "_from"]
    dealt = stored(rows.repartitionByRange(parts, *group, *order).withColumn("_part", F.spark_partition_id()), name)
    sums = dealt.groupBy(*group, "_part").agg(F.sum("n").alias("_n"))
    of_group = Window.partitionBy(*group)
    sums = sums.select(*group, "_part", F.sum("_n").over(of_group).alias("total"),
                       F.coalesce(F.sum("_n").over(of_group.orderBy("_part").rowsBetween(
                           Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return (placed.join(sums, [*group, "_part"]).withColumn("start", F.col("_before") + F.col("_inside"))
            .drop("_from", "_part", "_before", "_inside"))

