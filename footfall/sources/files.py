"""File sources and sinks.

All readers take an explicit schema (no inference on large inputs) and return
lazy DataFrames; Parquet is the storage format for feature snapshots.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv_headered(spark: SparkSession, path: str, schema: StructType | str,
                      rename: dict[str, str] | None = None) -> DataFrame:
    """Headered CSV scan, optionally renaming columns to common names (S-01)."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumnsRenamed(rename) if rename else df


def read_csv_named(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Headerless CSV scan; column names come from the schema (S-02)."""
    return spark.read.schema(schema).option("header", False).csv(path)


def read_station_files(spark: SparkSession, directory: str, schema: StructType | str,
                       key_name: str = "station_id") -> DataFrame:
    """One scan over a folder of per-key CSV files; the key is the file name (S-03).

    Spark lists and splits the files itself, so thousands of stations are one
    job, not a loop of reads.
    """
    df = spark.read.schema(schema).option("header", True).csv(directory)
    name = F.col("_metadata.file_name")
    return df.withColumn(key_name, F.regexp_extract(name, r"^(.*)\.csv$", 1))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header and no index column (S-04)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_submission_csv(df: DataFrame, folder: str, float_cols: list[str],
                         when: datetime | None = None) -> str:
    """CSV sink with floats at 4 decimals into a timestamped folder (S-05)."""
    stamp = (when or datetime.now()).strftime("%Y%m%d_%H%M%S")
    path = f"{folder.rstrip('/')}/sub{stamp}"
    out = df.select(*[F.format_string("%.4f", F.col(c)).alias(c) if c in float_cols else F.col(c)
                      for c in df.columns])
    write_csv(out, path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_snapshots(df: DataFrame, path: str, mode: str = "overwrite", partition_cols=("end_date",)) -> None:
    """Persist feature snapshots as Parquet partitioned by anchor (S-06).

    Dynamic partition overwrite replaces only the anchors being written.
    """
    (df.write.mode(mode)
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).parquet(path))


def read_snapshots(spark: SparkSession, path: str, end_dates=None) -> DataFrame:
    """Reload snapshots; a filter on ``end_date`` prunes partitions."""
    df = spark.read.parquet(path)
    if end_dates is not None:
        df = df.where(F.col("end_date").isin([str(d) for d in end_dates]))
    return df
