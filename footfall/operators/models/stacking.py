"""Stacked ensembles (M-13) and probability calibration (M-11).

Out-of-fold predictions come from fitting every base learner on k-1 folds and
scoring the held-out fold; each base model writes its own prediction column,
so the meta features are built by chained ``transform`` calls and a union
over folds -- no joins.

Linear learners need no fits: one aggregate gives the moments of every fold,
those of all other folds give the model of a fold, and the sum of all the full
model (``models.linear``).  A stack of linear learners is three passes over the
rows, whatever the number of folds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.folds import kfold
from footfall.operators.models.linear import Linear, Moments, OLSRegressor, moments, vector_columns
from footfall.operators.models.platt import Platt, fit_platt


def _with_prediction_col(estimator, col: str):
    """Copy of an estimator (or pipeline) whose final stage predicts into ``col``."""
    est = estimator.copy()
    last = est.getStages()[-1] if isinstance(est, Pipeline) else est
    last.setPredictionCol(col)
    for extra in ("rawPredictionCol", "probabilityCol"):
        if last.hasParam(extra):
            last.set(last.getParam(extra), f"{col}_{extra}")
    return est


@dataclass
class StackingModel:
    base: dict
    meta: object
    names: list

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for name in self.names:
            keep = out.columns
            out = self.base[name].transform(out).select(*keep, f"pred_{name}")
        return self.meta.transform(out)


def fit_stacking(df: DataFrame, key: str, base: dict, meta_estimator, k: int = 5,
                 meta_features: str = "__meta") -> StackingModel:
    names = sorted(base)
    est = {n: _with_prediction_col(base[n], f"pred_{n}") for n in names}
    folded = kfold(df, key, k, "__stack_fold").cache()
    parts = []
    for f in range(k):
        train, hold = folded.where(F.col("__stack_fold") != f), folded.where(F.col("__stack_fold") == f)
        scored = hold
        for n in names:
            keep = scored.columns
            scored = est[n].fit(train).transform(scored).select(*keep, f"pred_{n}")
        parts.append(scored)
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    meta = Pipeline(stages=[VectorAssembler(inputCols=[f"pred_{n}" for n in names], outputCol=meta_features),
                            meta_estimator.setFeaturesCol(meta_features)]).fit(oof)
    full = {n: est[n].fit(folded) for n in names}
    folded.unpersist()
    return StackingModel(full, meta, names)


class StackingRegressor(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """A stack as an estimator, so that grid search and nested CV take it as a
    candidate: parameters of its learners can stand in the grid.

    ``base`` (name -> estimator on the features column) is fitted on all folds
    but one to predict that one, the meta learner on those predictions in order
    of the names; then the base learners are fitted on all rows.
    ``OLSRegressor``, as base or meta learner, is solved from moments."""

    numFolds = Param(Params._dummy(), "numFolds", "folds of the base learners", typeConverter=TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "unique row id, which gives the folds", typeConverter=TypeConverters.toString)

    def __init__(self, base: dict | None = None, meta=None, idCol: str = "id", featuresCol: str = "features",
                 labelCol: str = "label", predictionCol: str = "prediction", numFolds: int = 5):
        super().__init__()
        self.base, self.meta = dict(base or {}), meta
        self._set(idCol=idCol, featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol, numFolds=numFolds)

    def copy(self, extra=None):
        """Settings of the learners in ``extra`` reach them, as in a Pipeline."""
        that = super().copy(extra)
        that.base = {n: e.copy(extra) for n, e in self.base.items()}
        that.meta = self.meta.copy(extra)
        return that

    def _fit(self, dataset: DataFrame) -> "StackModel":
        k, label, features = self.getOrDefault(self.numFolds), self.getLabelCol(), self.getFeaturesCol()
        names = sorted(self.base)
        learners = {n: _with_prediction_col(self.base[n], f"__p_{n}") for n in names}
        rows = kfold(dataset, self.getOrDefault(self.idCol), k, "__fold").persist()
        try:
            columns = vector_columns(rows, features)
            linear = [n for n in names if isinstance(self.base[n], OLSRegressor)]
            parts = moments(rows, columns, F.col(label), by="__fold") if linear else {}
            oof, full = rows, {}
            for n in [n for n in names if n not in linear]:
                oof = _out_of_fold(rows, oof, learners[n], n, k)
                full[n] = learners[n].fit(rows)
            for n in linear:
                fold_models = {f: self.base[n].solved(Moments.merged(m for g, m in parts.items() if g != f)) for f in parts}
                oof = oof.withColumn(f"__p_{n}", _by_fold(fold_models, columns))
                full[n] = self.base[n].solved(Moments.merged(parts.values()))
            inputs = [f"__p_{n}" for n in names]
            if isinstance(self.meta, OLSRegressor):
                meta = self.meta.solved(moments(oof, [F.col(c) for c in inputs], F.col(label))[None])
            else:
                assembled = VectorAssembler(inputCols=inputs, outputCol="__meta").transform(oof)
                meta = self.meta.copy({self.meta.getParam("featuresCol"): "__meta",
                                       self.meta.getParam("predictionCol"): self.getPredictionCol()}).fit(assembled)
        finally:
            rows.unpersist()
        model = StackModel(full, meta, names, len(columns))
        return model._set(featuresCol=features, predictionCol=self.getPredictionCol())


def _out_of_fold(rows: DataFrame, oof: DataFrame, learner, name: str, k: int) -> DataFrame:
    """``oof`` with the predictions of models that did not see their fold."""
    out = None
    for f in range(k):
        model = learner.fit(rows.where(F.col("__fold") != f))
        part = model.transform(oof.where(F.col("__fold") == f)).select(*oof.columns, f"__p_{name}")
        out = part if out is None else out.unionByName(part)
    return out


def _by_fold(models: dict[int, Linear], columns: list):
    """Each row's prediction by the model of its fold."""
    out = None
    for f, m in sorted(models.items()):
        test = F.col("__fold") == f
        out = F.when(test, m.expression(columns)) if out is None else out.when(test, m.expression(columns))
    return out


class StackModel(Model, HasFeaturesCol, HasPredictionCol):
    def __init__(self, base: dict | None = None, meta=None, names=(), size: int = 0):
        super().__init__()
        self.base, self.meta, self.names, self.size = base or {}, meta, list(names), size

    def setPredictionCol(self, value):
        return self._set(predictionCol=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(F.col(self.getFeaturesCol()))
        columns = [F.get(x, i) for i in range(self.size)]
        out, inputs = dataset, [f"__p_{n}" for n in self.names]
        for n in self.names:
            model = self.base[n]
            if isinstance(model, Linear):
                out = out.withColumn(f"__p_{n}", model.expression(columns))
            else:
                out = model.transform(out).select(*out.columns, f"__p_{n}")
        if isinstance(self.meta, Linear):
            out = out.withColumn(self.getPredictionCol(), self.meta.expression([F.col(c) for c in inputs]))
        else:
            out = self.meta.transform(VectorAssembler(inputCols=inputs, outputCol="__meta").transform(out))
        return out.select(*dataset.columns, self.getPredictionCol())


def fit_stacking_classifier(df: DataFrame, key: str, base: dict, meta_estimator, k: int = 5,
                            meta_features: str = "__meta") -> StackingModel:
    """Stacked classifier: meta learner on out-of-fold class-1 probabilities
    (or predictions, for learners without probabilities)."""
    names = sorted(base)

    class _Prob:
        def __init__(self, est, name):
            self.est, self.name = est, name

        def fit(self, d):
            model = _with_prediction_col(self.est, f"__pp_{self.name}").fit(d)
            return _ProbModel(model, self.name)

    class _ProbModel:
        def __init__(self, model, name):
            self.model, self.name = model, name

        def transform(self, d):
            keep = d.columns
            out = self.model.transform(d)
            prob_col = f"__pp_{self.name}_probabilityCol"
            val = (F.get(vector_to_array(F.col(prob_col)), 1) if prob_col in out.columns
                   else F.col(f"__pp_{self.name}"))
            return out.select(*keep, val.alias(f"pred_{self.name}"))

    wrapped = {n: _Prob(base[n], n) for n in names}
    folded = kfold(df, key, k, "__stack_fold").cache()
    parts = []
    for f in range(k):
        train, hold = folded.where(F.col("__stack_fold") != f), folded.where(F.col("__stack_fold") == f)
        scored = hold
        for n in names:
            scored = wrapped[n].fit(train).transform(scored)
        parts.append(scored)
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    meta = Pipeline(stages=[VectorAssembler(inputCols=[f"pred_{n}" for n in names], outputCol=meta_features),
                            meta_estimator.setFeaturesCol(meta_features)]).fit(oof)
    full = {n: wrapped[n].fit(folded) for n in names}
    folded.unpersist()
    return _ClassifierStack(full, meta, names)


@dataclass
class _ClassifierStack:
    base: dict
    meta: object
    names: list

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for name in self.names:
            out = self.base[name].transform(out)
        return self.meta.transform(out)


@dataclass
class CalibratedSVC:
    svc: object
    calibrator: Platt

    def transform(self, df: DataFrame) -> DataFrame:
        s = self.svc.transform(df).withColumn("__margin", F.get(vector_to_array(F.col("__raw")), 1))
        p = self.calibrator.probability(F.col("__margin"))
        return s.withColumn("probability", array_to_vector(F.array(1 - p, p))).withColumn(
            "prediction", (p >= 0.5).cast("double"))


def fit_calibrated_svc(df: DataFrame, key: str, features: str, label: str, k: int = 5,
                       reg_param: float = 0.0) -> CalibratedSVC:
    """Linear SVM whose margins are mapped to probabilities by a Platt fit on
    out-of-fold margins (``models.platt``)."""
    svc = LinearSVC(featuresCol=features, labelCol=label, rawPredictionCol="__raw",
                    predictionCol="__svc_pred", regParam=reg_param, standardization=True, tol=1e-4)
    folded = kfold(df, key, k, "__cal_fold").cache()
    parts = []
    for f in range(k):
        m = svc.fit(folded.where(F.col("__cal_fold") != f))
        parts.append(m.transform(folded.where(F.col("__cal_fold") == f)))
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    calibrator = fit_platt(oof.withColumn("__margin", F.get(vector_to_array(F.col("__raw")), 1)), "__margin", label)
    full = svc.fit(folded)
    folded.unpersist()
    return CalibratedSVC(full, calibrator)
