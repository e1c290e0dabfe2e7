"""Output normalisation shared by all registered queries: integers as
BIGINT, doubles rounded to 6 decimals (-0.0 -> 0.0), so results compare
across engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = c
        cols.append(c.alias(f.name))
    return df.select(*cols)
