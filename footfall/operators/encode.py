"""Categorical encoders and scalers (T-01 ... T-05).

Level dictionaries are computed by Spark (distinct + rank) and joined back;
they are as large as a column's cardinality, never as large as the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.operators.ranking import exact_row_number

SAMPLED = 1024                # levels drawn as splitters; no more of them are held on the driver
_OUTER = 32                   # splitters are searched in two steps


def _drawn_levels(df: DataFrame, col: str, most: int = SAMPLED) -> tuple[DataFrame, list]:
    """The distinct levels, and ``most`` of them drawn by md5, in order: the
    same ones on every run, all of them if there are no more."""
    levels = df.select(col).where(F.col(col).isNotNull()).distinct()
    key = F.md5(F.col(col).cast("string").cast("binary"))
    drawn = [r[0] for r in levels.orderBy(key, col).limit(most).collect()]
    return levels, sorted(drawn, key=lambda v: (v != v, v))


def _range_of(value: Column, splitters: list, kind: T.DataType) -> Column:
    """Number of splitters up to the value, found in two steps."""
    def literal(values):
        return F.array(*[F.lit(v).cast(kind) for v in values])

    runs = [splitters[i:i + _OUTER] for i in range(0, len(splitters), _OUTER)]
    outer = F.greatest(F.size(F.filter(literal([r[0] for r in runs]), lambda s: s <= value)) - 1, F.lit(0))
    inner = F.element_at(F.array(*[literal(r) for r in runs]), outer + 1)
    return outer * _OUTER + F.size(F.filter(inner, lambda s: s <= value))


def level_codes(df: DataFrame, col: str, code_col: str = "code") -> DataFrame:
    """Dictionary ``(col, code)``: code = alphabetical rank from 0 (T-01).

    A sample of levels, drawn by md5, splits their order into ranges of about
    equal size, whatever prefixes the levels share; a level's code is its rank
    in its range plus the levels of the ranges before.  A column with no more
    levels than the sample has its codes at once."""
    levels, drawn = _drawn_levels(df, col)
    kind = df.schema[col].dataType
    if len(drawn) < SAMPLED:
        fields = T.StructType([T.StructField(col, kind), T.StructField(code_col, T.IntegerType())])
        return df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(drawn)], fields)
    ranked = exact_row_number(levels, [], [F.col(col)], _range_of(F.col(col), drawn, kind), "__rn")
    return ranked.select(col, F.col("__rn").cast("int").alias(code_col))


def label_encode(df: DataFrame, col: str, out_col: str | None = None, codes: DataFrame | None = None) -> DataFrame:
    """Replace (or add) a column with its alphabetical code (T-01)."""
    out_col = out_col or col
    codes = level_codes(df, col, "__code") if codes is None else codes.withColumnRenamed("code", "__code")
    res = df.join(codes, on=col, how="left")
    if out_col == col:
        return res.drop(col).withColumnRenamed("__code", col).select(*df.columns)
    return res.withColumnRenamed("__code", out_col)


def ordinal_encode(df: DataFrame, cols: list[str], suffix: str = "_code") -> DataFrame:
    """Alphabetical codes of ``df``'s own levels for several columns at once;
    ``OrdinalEncoder`` carries codes from training rows to other rows."""
    out = df
    for c in cols:
        out = label_encode(out, c, c + suffix)
    return out


class OrdinalEncoder:
    """Codes fitted on one frame and applied to others (T-02).  A level that
    was not seen in fitting is an error when the result is computed; NULL
    stays NULL."""

    def __init__(self, cols: list[str], suffix: str = "_code"):
        self.cols, self.suffix = list(cols), suffix
        self.codes: dict[str, DataFrame] = {}

    def fit(self, df: DataFrame) -> OrdinalEncoder:
        self.codes = {c: level_codes(df, c) for c in self.cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.cols:
            name = c + self.suffix
            out = label_encode(out, c, name, self.codes[c])
            unseen = F.raise_error(F.concat(F.lit(f"unseen level of {c}: "), F.col(c).cast("string"))).cast("int")
            out = out.withColumn(name, F.when(F.col(c).isNotNull() & F.col(name).isNull(), unseen)
                                 .otherwise(F.col(name)))
        return out


def one_hot_levels(df: DataFrame, col: str, most: int = SAMPLED - 1) -> list:
    """The levels of a column in order, for ``one_hot``; more than ``most``
    are an error, since each becomes a column."""
    levels = _drawn_levels(df, col, most + 1)[1]
    if len(levels) > most:
        raise ValueError(f"{col} has more than {most} levels")
    return levels


def one_hot(df: DataFrame, col: str, levels: list[str], prefix: str | None = None) -> DataFrame:
    """0/1 indicator column per level, all levels kept (T-03).

    ``levels`` is the fitted dictionary (a short list from ``one_hot_levels``).
    """
    prefix = "" if prefix is None else prefix
    return df.select("*", *[(F.col(col) == F.lit(lv)).cast("int").alias(f"{prefix}{lv}") for lv in levels])


def fit_standardizer(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column: one global aggregate (partial per
    task); the fitted parameters are one row of 2 x len(cols) numbers."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def standardize(df: DataFrame, cols: list[str], params: dict[str, tuple[float, float]] | None = None,
                suffix: str = "") -> DataFrame:
    """(x - mean) / population std for the given columns, the rest passed
    through (T-04, T-05).  ``params`` from ``fit_standardizer`` (fit on
    training rows, applied to any rows)."""
    params = params or fit_standardizer(df, cols)

    def scaled(c):
        m, s = params[c]
        if s is None or s == 0:
            return F.when(F.col(c).isNotNull(), F.lit(0.0))     # a constant column; NULL stays NULL
        return (F.col(c) - F.lit(float(m))) / F.lit(float(s))

    keep = [c for c in df.columns if not (suffix == "" and c in cols)]
    return df.select(*keep, *[scaled(c).alias(c + suffix) for c in cols])
