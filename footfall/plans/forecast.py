"""Train on feature snapshots, predict a horizon, write a submission
(M-05, M-14, M-15, P-11, S-05, S-06).

At scale the snapshots are written once as Parquet partitioned by anchor
(``sources.write_snapshots``) and the model reads them back; the fit is
Spark ML's distributed gradient-boosted trees.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# columns that are keys, targets or raw text, never predictors (P-11)
NOT_PREDICTORS = ["id", "store_id", "visit_date", "end_date", "horizon", "air_area_name", "visitors", "month"]


class SafeAssembler:
    """VectorAssembler over columns whose names may contain dots: columns are
    aliased by position first."""

    def __init__(self, features: list[str], out: str = "__x"):
        self.features, self.out = features, out
        self.va = VectorAssembler(inputCols=[f"__f{i}" for i in range(len(features))], outputCol=out,
                                  handleInvalid="keep")

    def transform(self, df: DataFrame) -> DataFrame:
        aliased = df.select("*", *[F.col(f"`{c}`").alias(f"__f{i}") for i, c in enumerate(self.features)])
        return self.va.transform(aliased).drop(*[f"__f{i}" for i in range(len(self.features))])


def predictors(columns: list[str]) -> list[str]:
    return [c for c in columns if c not in NOT_PREDICTORS]


def fit_forecaster(train: DataFrame, features: list[str], max_iter: int = 100, step: float = 0.1,
                   max_depth: int = 6, min_rows: int = 100, feature_share: str = "0.7", seed: int = 505):
    """GBT on log1p visitors.  (The original boosts 2,300 leaf-wise rounds at
    learning rate 0.02; Spark's depth-wise trees use fewer, larger steps.)"""
    va = SafeAssembler(features)
    gbt = GBTRegressor(featuresCol="__x", labelCol="visitors", maxIter=max_iter, stepSize=step,
                       maxDepth=max_depth, minInstancesPerNode=min_rows, featureSubsetStrategy=feature_share,
                       seed=seed)
    data = va.transform(train).select("__x", "visitors").cache()
    model = gbt.fit(data)
    data.unpersist()
    return va, model


def predict_visits(va, model, test: DataFrame, requested_ids: DataFrame | None = None) -> DataFrame:
    """id, visitors = expm1(prediction); requested ids without a prediction get 0 (M-15)."""
    pred = model.transform(va.transform(test)).select(
        F.concat(F.col("store_id"), F.lit("_"), F.date_format("visit_date", "yyyy-MM-dd")).alias("id"),
        F.expm1("prediction").alias("visitors"))
    if requested_ids is None:
        return pred
    return requested_ids.select("id").join(pred, "id", "left").na.fill(0.0, ["visitors"])


def importance_table(spark: SparkSession, model, features: list[str], k: int = 50) -> DataFrame:
    """Top-k features by importance (M-14).  Spark reports gain-based
    importances normalised to sum 1."""
    imp = model.featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    df = spark.createDataFrame(rows, "feature_name string, varimp double")
    return df.orderBy(F.desc("varimp"), "feature_name").limit(k)


def fit_forecaster_ts_cv(snaps: DataFrame, features: list[str], n_splits: int = 5, max_iter: int = 100,
                         step: float = 0.1, max_depth: int = 6, min_rows: int = 100, seed: int = 505):
    """Expanding-window CV (V-07): visit dates in order are dealt to
    ``n_splits + 1`` blocks of whole dates; fold i trains on everything before block i+1
    and early-stops on that block (``validationIndicatorCol``).

    Returns the fold models; predictions are averaged over folds and
    importances are the mean over folds, as the original's commented CV cell."""
    from footfall.operators.folds import time_series_date_folds
    va = SafeAssembler(features)
    folded = time_series_date_folds(snaps, "visit_date", n_splits, "__tf")
    data = va.transform(folded).select("__x", "visitors", "__tf").cache()
    models = []
    for i in range(n_splits):
        part = data.where(F.col("__tf").isNull() | (F.col("__tf") <= i)) \
                   .withColumn("__val", F.coalesce(F.col("__tf") == i, F.lit(False)))
        gbt = GBTRegressor(featuresCol="__x", labelCol="visitors", maxIter=max_iter, stepSize=step,
                           maxDepth=max_depth, minInstancesPerNode=min_rows, featureSubsetStrategy="0.7",
                           validationIndicatorCol="__val", validationTol=0.01, seed=seed)
        models.append(gbt.fit(part))
    data.unpersist()
    return va, models


def predict_averaged(va, models, test: DataFrame) -> DataFrame:
    """id, visitors = expm1(mean of the fold models' predictions)."""
    scored = va.transform(test)
    cols = []
    for i, m in enumerate(models):
        scored = m.setPredictionCol(f"__p{i}").transform(scored)
        cols.append(F.col(f"__p{i}"))
    mean = sum(cols[1:], cols[0]) / F.lit(float(len(cols)))
    return scored.select(F.concat(F.col("store_id"), F.lit("_"), F.date_format("visit_date", "yyyy-MM-dd")).alias("id"),
                         F.expm1(mean).alias("visitors"))


def mean_importance_table(spark: SparkSession, models, features: list[str], k: int = 50) -> DataFrame:
    """Feature importances averaged over fold models, top k."""
    import numpy as np
    imp = np.mean([m.featureImportances.toArray() for m in models], axis=0)
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature_name string, varimp double")
    return df.orderBy(F.desc("varimp"), "feature_name").limit(k)


def run_forecast(spark: SparkSession, inputs, train_anchors, test_anchor, snapshot_path: str,
                 submission_dir: str, requested_ids: DataFrame | None = None, max_iter: int = 100):
    """Snapshots for every anchor -> Parquet partitioned by anchor -> GBT on
    the training anchors -> expm1 predictions for the test anchor, requested
    ids filled with 0 -> CSV with 4-decimal floats in a timestamped folder.

    Returns (submission folder, top-50 importance table)."""
    from footfall.plans.snapshot import create_snapshots
    from footfall.sources.files import read_snapshots, write_snapshots, write_submission_csv
    write_snapshots(create_snapshots(inputs, list(train_anchors) + [test_anchor]), snapshot_path)
    snaps = read_snapshots(spark, snapshot_path)
    is_test = F.col("end_date") == F.lit(test_anchor.end_date)
    train, test = snaps.where(~is_test), snaps.where(is_test)
    feats = predictors([c for c in train.columns if c != "horizon"])
    va, model = fit_forecaster(train, feats, max_iter=max_iter)
    ids = requested_ids if requested_ids is not None else test.select("id")
    pred = predict_visits(va, model, test, ids)
    return write_submission_csv(pred, submission_dir, ["visitors"]), importance_table(spark, model, feats)
