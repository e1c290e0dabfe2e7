"""Shards by weighted rendezvous hashing of stable record keys.

Every shard draws a number from the record's key and the shard's own number;
the record goes to the shard whose draw, scaled by its weight, is smallest.
A draw is -ln(u) / weight with u from the md5 of key and shard: the smallest
of such exponential draws falls on a shard in proportion to its weight.  The
draws of the shards that stay are untouched when one is added or removed, so
a new shard takes rows only into itself and a removed one gives its rows to
the others; everything is built from DataFrame expressions.

Equal draws go to the smaller shard.  The key alone decides: equal keys meet
in one shard, which stays whole however many rows share the key.

Defined results: a null key field is a key of its own, apart from the empty
text; a null text has size 1 and checksum 0; repeated rows get a slot each; extra
columns are ignored by ``place`` and kept by ``assign``, which refuses a table
that has its result columns; an empty table gives no rows; a text's length
does not matter, texts are never shuffled by ``place``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm import sql
from footfall.llm.common import field_text, numbered, scratch_path, table

SHARDS = (1.0,) * 16          # weights of the registered query
ROWS_PER_FILE = 200_000


def key_text(columns: Sequence[str]) -> Column:
    """The record's key as a text: the same for the same values, whatever
    engine, integer type or partition they come from."""
    return F.concat(*[field_text(c) for c in columns])


def draw(key: Column, shard: int, weight: float) -> Column:
    """The shard's draw for a key; the smallest one wins."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"/{shard}")).cast("binary")), 1, 13), 16, 10)
    u = (bits.cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / float(weight)


def _smallest(draws: list[Column]) -> Column:
    """(draw, shard) of the smallest draw; ties go to the smaller shard."""
    return F.array_min(F.array(*[F.struct(d.alias("draw"), F.lit(s).alias("shard")) for s, d in enumerate(draws)]))


def assign(docs: DataFrame, weights: Sequence[float] = SHARDS, key: Sequence[str] = ("doc_id",),
           grown_by: float | None = None) -> DataFrame:
    """``docs`` with ``shard`` and, when ``grown_by`` is the weight of one
    more shard, ``grown_shard``, the place among one shard more."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    clash = {"shard", "grown_shard", "_key", "_best"} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are results; rename them first")
    keyed = docs.withColumn("_key", key_text(key))
    best = keyed.withColumn("_best", _smallest([draw(F.col("_key"), s, w) for s, w in enumerate(weights)]))
    out = best.withColumn("shard", F.col("_best.shard"))
    if grown_by is not None:
        more = draw(F.col("_key"), len(weights), grown_by)
        out = out.withColumn("grown_shard", F.when(more < F.col("_best.draw"), F.lit(len(weights)))
                             .otherwise(F.col("_best.shard")))
    return out.drop("_key", "_best")


def moved(docs: DataFrame, old: Sequence[float], new: Sequence[float], key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Rows whose shard differs between two lists of weights, with both
    shards (``shard``, ``new_shard``): what a change of shards has to copy."""
    first = assign(docs, old, key)
    both = assign(first.withColumnRenamed("shard", "_old"), new, key)
    return (both.withColumnRenamed("shard", "new_shard").withColumnRenamed("_old", "shard")
            .where(F.col("shard") != F.col("new_shard")))


def place(docs: DataFrame, weights: Sequence[float] = SHARDS, grown_by: float | None = 1.0,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: size, checksum, shard and a slot without gaps in
    its shard, in order of the id.  Equal rows are counted before the shuffle."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    rows = assign(rows, weights, ["doc_id"], grown_by)
    if grown_by is None:
        rows = rows.withColumn("grown_shard", F.lit(None).cast("int"))
    slots = numbered(rows, ["shard"], ["doc_id", "size", "text_crc32"], "shards")
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                        F.explode(F.expr("sequence(start, start + n - 1)")).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, weights: Sequence[float] = SHARDS, key: Sequence[str] = ("doc_id",),
                 path: str | None = None) -> str:
    """Write ``docs`` as one folder a shard (``shard=s``) and return the path.
    A shard's rows are dealt over files by their content, so that neither a
    heavy shard nor a repeated key is one task."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "shards")
    rows = assign(docs, weights, key)
    files = max(1, -(-docs.count() // (ROWS_PER_FILE * len(weights))))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns], F.spark_partition_id()), F.lit(files))
    (rows.withColumn("_file", salt).repartition(files * len(weights), "shard", "_file").drop("_file")
     .write.partitionBy("shard").parquet(path))
    return path


ORACLE = f"""
WITH RECURSIVE {sql.CRC_TABLE},
docs AS (
    SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size,
           {sql.crc32("coalesce(text, '')")} AS text_crc32, {sql.field("doc_id")} AS key
    FROM documents, crc_table),
draws AS (
    SELECT doc_id, size, text_crc32, s,
           -ln((('0x' || substr(md5(key || '/' || s), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496) AS draw
    FROM docs, range(17) shards(s)),
best AS (
    SELECT doc_id, size, text_crc32, arg_min(s, (draw, s)) FILTER (s < 16) AS shard, arg_min(s, (draw, s)) AS grown_shard
    FROM draws GROUP BY ALL)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM best
"""


def query(spark, sf_dir):
    return place(table(spark, sf_dir, "documents"))
