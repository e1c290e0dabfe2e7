"""Deterministic splits (V-01, V-02, V-03, V-07).

Assignments are functions of a row key through md5, so every engine and every
re-run (including task retries after an executor loss) gives the same folds;
no ``rand`` and no engine-specific hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.operators.ranking import exact_row_number, md5_prefix


def md5_bucket(key: Column, k: int) -> Column:
    """First 8 hex digits of md5(key) as an integer, modulo k."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % k).cast("int")


def holdout(df: DataFrame, key: str, test_buckets: int = 5, out: str = "is_test") -> DataFrame:
    """1 of ``test_buckets`` md5 buckets is the test set (20 % for 5) (V-01)."""
    return df.withColumn(out, (md5_bucket(F.col(key), test_buckets) == 0).cast("int"))


def kfold(df: DataFrame, key: str, k: int = 3, out: str = "fold") -> DataFrame:
    """Shuffled k-fold: fold = md5 bucket of the key (V-02)."""
    return df.withColumn(out, md5_bucket(F.col(key), k))


def stratified_kfold(df: DataFrame, key: str, label: str, k: int = 3, out: str = "fold",
                     hex_chars: int = 4) -> DataFrame:
    """Exact stratification: within each label, rows ordered by (md5(key), key)
    are dealt round-robin into k folds (V-03).  The rank is computed with
    md5-prefix buckets, so a label holding most rows is still many tasks."""
    order = [F.md5(F.col(key).cast("string")), F.col(key)]
    ranked = exact_row_number(df, [label], order, md5_prefix(F.col(key), hex_chars), "__rn")
    return ranked.withColumn(out, (F.col("__rn") % k).cast("int")).drop("__rn")


def time_series_folds(df: DataFrame, date_col: str, key: str, n_splits: int = 5,
                      out: str = "test_fold") -> DataFrame:
    """Expanding-window split: rows ordered by (date, md5(key), key) are cut
    into ``n_splits + 1`` equal blocks; block i+1 is the test set of fold i,
    every earlier row trains it (V-07).  Rows before the first test block get
    NULL (always training)."""
    order = [F.col(date_col), F.md5(F.col(key).cast("string")), F.col(key)]
    bucket = F.struct(F.col(date_col), md5_prefix(F.col(key), 2))
    ranked = exact_row_number(df, [], order, bucket, "__rn")
    n = df.count()
    test_size = n // (n_splits + 1)
    start = n - n_splits * test_size
    if test_size == 0:
        return ranked.withColumn(out, F.lit(None).cast("int")).drop("__rn")
    fold = F.when(F.col("__rn") >= start, F.floor((F.col("__rn") - start) / test_size).cast("int"))
    return ranked.withColumn(out, fold).drop("__rn")


def time_series_date_folds(df: DataFrame, date_col: str, n_splits: int = 5, out: str = "test_fold") -> DataFrame:
    """Expanding-window split on whole dates: dates in order are dealt to
    ``n_splits + 1`` blocks of about equal rows, so rows of one date (the
    same store and day of overlapping anchors, too) never stand in training
    and validation at once.  The first block gets NULL (always training).
    One row a date is ranked, whatever the number of rows."""
    days = df.groupBy(date_col).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    share = F.coalesce(F.sum("__n").over(before), F.lit(0)) / F.sum("__n").over(Window.partitionBy())
    block = F.least(F.floor(share * (n_splits + 1)), F.lit(n_splits)).cast("int") - 1
    folds = days.select(date_col, F.when(block >= 0, block).alias(out))
    return df.join(F.broadcast(folds), date_col, "left")


def _md5_rank(df: DataFrame, key: str, out: str = "__rn", hex_chars: int = 4) -> DataFrame:
    order = [F.md5(F.col(key).cast("string")), F.col(key)]
    return exact_row_number(df, [], order, md5_prefix(F.col(key), hex_chars), out)


def holdout_exact(df: DataFrame, key: str, test_size: float = 0.2, out: str = "is_test") -> DataFrame:
    """Exactly ceil(test_size * n) test rows: the first rows in (md5(key), key)
    order (V-01, exact-size form)."""
    import math
    n = df.count()
    n_test = math.ceil(test_size * n)
    ranked = _md5_rank(df, key)
    return ranked.withColumn(out, (F.col("__rn") < n_test).cast("int")).drop("__rn")


def kfold_exact(df: DataFrame, key: str, k: int = 3, out: str = "fold") -> DataFrame:
    """Folds of n // k or n // k + 1 rows: rows in (md5(key), key) order dealt
    round-robin (V-02, exact-size form)."""
    ranked = _md5_rank(df, key)
    return ranked.withColumn(out, (F.col("__rn") % k).cast("int")).drop("__rn")
