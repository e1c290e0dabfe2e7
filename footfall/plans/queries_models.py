"""Registered model queries (M-*, V-04 ... V-06, T-06, T-07).

Two are SQL-checked (OLS and Gaussian naive Bayes, both closed-form); the
iterative fits are rows-only, as the driver's gate allows.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from footfall import constants as K
from footfall.operators import encode as EN
from footfall.operators import metrics as M
from footfall.operators.folds import holdout, stratified_kfold
from footfall.operators.models import estimators as ES
from footfall.operators.models import search as S
from footfall.operators.models.linear import fit_ols
from footfall.operators.models.knn import knn_classify, knn_neighbours, knn_regress
from footfall.operators.models.naive_bayes import fit_gaussian_nb
from footfall.operators.models.stacking import fit_calibrated_svc, fit_stacking, fit_stacking_classifier
from footfall.plans import forecast as FC
from footfall.plans import selection as SEL
from footfall.plans.inputs import fixture_inputs
from footfall.plans.normalize import normalize
from footfall.plans.oracle import FIXTURE_SQL, md5_mod_sql, normalize_sql, with_ctes
from footfall.plans.queries import register
from footfall.plans.snapshot import create_snapshots
from footfall.session import materialize
from footfall.sources import fixtures as FX
from footfall.sources.fixtures import fixture_anchors

PARALLELISM = 8


# ------------------------------------------------------------ features ----
def clf_frame(spark, sf):
    """fx_clf with numeric features: log length, language and source codes, toxic flag."""
    df = FX.classification_rows(spark, sf)
    df = EN.ordinal_encode(df, ["lang", "source"])
    return df.select("doc_id", F.col("y").cast("double").alias("label"), F.log1p("n_chars").alias("x_len"),
                     F.col("lang_code").cast("double").alias("x_lang"),
                     F.col("source_code").cast("double").alias("x_source"),
                     F.col("toxic").cast("double").alias("x_toxic"))


CLF_FEATURES = ["x_len", "x_lang", "x_source", "x_toxic"]


def cat_frame(spark, sf):
    """fx_cat, ordinal-encoded (T-02)."""
    df = EN.ordinal_encode(FX.categorical_rows(spark, sf), ["p_brand", "p_type"])
    return df.select("p_partkey", F.col("y").cast("double").alias("label"),
                     F.col("p_brand_code").cast("double").alias("x_brand"),
                     F.col("p_type_code").cast("double").alias("x_type"),
                     F.col("p_size").cast("double").alias("x_size"))


CAT_FEATURES = ["x_brand", "x_type", "x_size"]


def reg_frame(spark, sf):
    df = EN.label_encode(FX.regression_rows(spark, sf), "o_orderpriority", "prio")
    return df.select("o_orderkey", F.col("y").alias("label"), F.col("n_lines").cast("double").alias("x_lines"),
                     F.col("qty").alias("x_qty"), F.col("max_disc").alias("x_disc"),
                     F.col("prio").cast("double").alias("x_prio"))


REG_FEATURES = ["x_lines", "x_qty", "x_disc", "x_prio"]


# --------------------------------------------------------- SQL-checked ----
@register("q_m01_ols", with_ctes({"fx_reg": FIXTURE_SQL["fx_reg"]}, normalize_sql(
    "select regr_slope(y, qty) as slope, regr_intercept(y, qty) as intercept, count(*) as n from fx_reg",
    ["slope", "intercept", "n"], {"n"}, digits=4)))
def q_m01_ols(spark, sf):
    df = FX.regression_rows(spark, sf)
    m = fit_ols(df, ["qty"], "y")
    out = spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept), int(m.summary.numInstances))],
                                "slope double, intercept double, n long")
    return normalize(out, 4)


_NB_SQL = f"""
    with e as (select vec_id, label, embedding,
                      case when {md5_mod_sql('vec_id', K.HOLDOUT_TEST_BUCKETS)} = 0 then 1 else 0 end as is_test
               from embeddings),
    x as (select vec_id, label, is_test, unnest(range(len(embedding))) as dim,
                 cast(unnest(embedding) as double) as v from e),
    tr as (select * from x where is_test = 0),
    tot as (select count(distinct vec_id) as n from tr),
    cls as (select label, count(distinct vec_id) as n_c from tr group by label),
    eps as (select 1e-9 * max(vp) as eps from (select dim, var_pop(v) as vp from tr group by dim)),
    st as (select label, dim, avg(v) as mu, var_pop(v) + (select eps from eps) as var from tr group by label, dim),
    te as (select * from x where is_test = 1),
    ll as (select te.vec_id, st.label as cls,
                  sum(-0.5 * ln(2 * pi() * st.var) - 0.5 * (te.v - st.mu) * (te.v - st.mu) / st.var) as s
           from te join st on te.dim = st.dim group by te.vec_id, st.label),
    jl as (select ll.vec_id, ll.cls, ll.s + ln(cls.n_c / tot.n) as jll from ll join cls on ll.cls = cls.label, tot)
    select t.vec_id, t.label as y, p.pred from (select vec_id, arg_max(cls, jll) as pred from jl group by vec_id) p
    join (select distinct vec_id, label from te) t on p.vec_id = t.vec_id"""


@register("q_m08_gaussian_nb", normalize_sql(_NB_SQL, ["vec_id", "y", "pred"], {"vec_id", "y", "pred"}))
def q_m08_gaussian_nb(spark, sf):
    e = holdout(FX.table(spark, sf, "embeddings"), "vec_id", K.HOLDOUT_TEST_BUCKETS)
    model = fit_gaussian_nb(e.where(F.col("is_test") == 0), "embedding", "label", 1e-9)
    test = e.where(F.col("is_test") == 1)
    return normalize(model.predict(test, "embedding").select("vec_id", F.col("label").alias("y"), "pred"))


# ------------------------------------------------------------ rows-only ----
def _lr_grid(lr, n):
    # C in {100, 10, 1, 0.1, 0.01} -> regParam = 1 / (C n) over n rows; l2 and l1
    return (ParamGridBuilder().addGrid(lr.regParam, [1 / (c * n) for c in (100, 10, 1, 0.1, 0.01)])
            .addGrid(lr.elasticNetParam, [0.0, 1.0]).build())


@register("q_v04_grid_search", None)
def q_v04_grid_search(spark, sf):
    """Logistic regression grid, 3 stratified folds, AUC (V-04, T-06)."""
    df = materialize(stratified_kfold(clf_frame(spark, sf), "doc_id", "label", K.N_FOLDS))
    lr = LogisticRegression(featuresCol="features", labelCol="label", standardization=False)
    pipe = ES.pipeline(CLF_FEATURES, lr, scale=True)
    maps = _lr_grid(lr, df.count())
    cvm = S.grid_search(df, pipe, maps, S.AUCEvaluator("label"), "fold", K.N_FOLDS, PARALLELISM)
    return S.grid_table(spark, cvm, maps)


# the five families of the original's nested classifier search, every set of their grids
CLF_GRIDS = {family: SEL.CLASSIFIER_GRIDS[family]
             for family in ("DecisionTree", "GaussianNB", "KNeighbors", "LogisticRegression", "RBF")}
# the registered regression search is smaller than the original's, which is the default of the functions
REG_GRIDS = {"LinearRegression": SEL.REGRESSOR_GRIDS["LinearRegression"], "KNeighbors": SEL.REGRESSOR_GRIDS["KNeighbors"],
             "DecisionTree": {"maxDepth": range(3, 17, 2), "minInstancesPerNode": (3, 9)}}


def _nested_clf(spark, sf, refit: bool = False):
    df = materialize(cat_frame(spark, sf))
    sel = SEL.select_model(df, "p_partkey", SEL.default_classifiers(CAT_FEATURES, "p_partkey", df.count(), CLF_GRIDS),
                           S.F1MacroEvaluator("label"), K.N_FOLDS, True, 4, refit=refit)
    return df, sel


@register("q_v05_nested_cv_clf", None)
def q_v05_nested_cv_clf(spark, sf):
    """Nested CV over 5 classifiers with the original's grids, macro F1, best =
    highest rounded mean (V-05)."""
    return _nested_clf(spark, sf)[1].summary


@register("q_v05_nested_cv_reg", None)
def q_v05_nested_cv_reg(spark, sf):
    """Nested CV over feature elimination, tree and k-NN, negative MSE (V-05)."""
    sel = SEL.select_model(reg_frame(spark, sf), "o_orderkey", SEL.default_regressors(REG_FEATURES, "o_orderkey", REG_GRIDS),
                           S.neg_mse_evaluator("label"), K.N_FOLDS, False, PARALLELISM, refit=False)
    return sel.summary


@register("q_v06_refit_report", None)
def q_v06_refit_report(spark, sf):
    """Refit the winning algorithm's search on all training rows; report on
    train + test predictions (V-06, E-04)."""
    return _nested_clf(spark, sf, refit=True)[1].report


def _forecast_parts(spark, sf):
    snaps = materialize(create_snapshots(fixture_inputs(spark, sf), fixture_anchors()))
    last = max(a.end_date for a in fixture_anchors())
    feats = FC.predictors(snaps.columns)
    va, model = FC.fit_forecaster(snaps.where(F.col("end_date") < F.lit(last)), feats, max_iter=30)
    return snaps, last, feats, va, model


@register("q_m05_forecast", None)
def q_m05_forecast(spark, sf):
    """GBT on every earlier snapshot, predictions for the latest anchor,
    expm1 back-transform, requested ids filled with 0 (M-05, M-15)."""
    snaps, last, feats, va, model = _forecast_parts(spark, sf)
    test = snaps.where(F.col("end_date") == F.lit(last))
    ids = test.select("id")
    return FC.predict_visits(va, model, test, ids)


@register("q_m14_importance", None)
def q_m14_importance(spark, sf):
    snaps, last, feats, va, model = _forecast_parts(spark, sf)
    return FC.importance_table(spark, model, feats, 20)


@register("q_m13_stacking", None)
def q_m13_stacking(spark, sf):
    """Stacked regressor: linear + tree base learners, random-forest meta
    learner on out-of-fold predictions (M-13, M-04)."""
    df = reg_frame(spark, sf)
    split = holdout(df, "o_orderkey")
    train, test = split.where(F.col("is_test") == 0), split.where(F.col("is_test") == 1)
    base = {"lin": ES.pipeline(REG_FEATURES, ES.regressor("LinearRegression"), scale=False),
            "tree": ES.pipeline(REG_FEATURES, ES.regressor("DecisionTree"), scale=False)}
    model = fit_stacking(train, "o_orderkey", base, ES.regressor("RandomForest"), k=5)
    pred = model.transform(test)
    return M.mse(pred, "label", "prediction")


@register("q_m11_calibrated_svc", None)
def q_m11_calibrated_svc(spark, sf):
    """Linear SVM with Platt-scaled probabilities (M-09, M-11)."""
    df = VectorAssembler(inputCols=CLF_FEATURES, outputCol="features").transform(clf_frame(spark, sf))
    model = fit_calibrated_svc(df, "doc_id", "features", "label", k=3, reg_param=0.01)
    from pyspark.ml.functions import vector_to_array
    return model.transform(df).select("doc_id", F.get(vector_to_array("probability"), 1).alias("p_quality"))


@register("q_m10_rff_svm", None)
def q_m10_rff_svm(spark, sf):
    """Approximate RBF-kernel SVM: random Fourier features + LinearSVC (M-10)."""
    split = materialize(holdout(cat_frame(spark, sf), "p_partkey"))      # read by every pass of the fits
    est = ES.pipeline(CAT_FEATURES, ES.classifier("RFFSVM"), scale=True)
    model = est.fit(split.where(F.col("is_test") == 0))
    pred = model.transform(split.where(F.col("is_test") == 1))
    return M.binary_metrics(pred.select(F.col("label").cast("int").alias("y"),
                                        F.col("prediction").cast("int").alias("p")), "y", "p")


@register("q_m12_mlp", None)
def q_m12_mlp(spark, sf):
    """One-hidden-layer perceptron classifier (M-12)."""
    df = cat_frame(spark, sf)
    split = holdout(df, "p_partkey")
    est = ES.pipeline(CAT_FEATURES, ES.classifier("MLP", n_features=len(CAT_FEATURES)), scale=True)
    model = est.fit(split.where(F.col("is_test") == 0))
    pred = model.transform(split.where(F.col("is_test") == 1))
    return M.confusion(pred.select(F.col("label").cast("int").alias("y"), F.col("prediction").cast("int").alias("p")),
                       "y", "p")


@register("q_m06_gbt_weighted", None)
def q_m06_gbt_weighted(spark, sf):
    """Boosted classifier with class weights {0: 1, 1: 10} via weightCol (M-06)."""
    split = holdout(clf_frame(spark, sf), "doc_id")
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=20, maxDepth=3, seed=505)
    model = ES.pipeline(CLF_FEATURES, gbt, scale=False, class_weights={0: 1, 1: 10}) \
        .fit(split.where(F.col("is_test") == 0))
    from pyspark.ml.functions import vector_to_array
    pred = model.transform(split.where(F.col("is_test") == 1)) \
                .select(F.col("label").cast("int").alias("y"), F.get(vector_to_array("probability"), 1).alias("s"))
    return M.roc_auc(pred, "y", "s")


@register("q_p03_expr_filter", with_ctes({"fx_clf": FIXTURE_SQL["fx_clf"]},
          "select doc_id, lang, source, cast(n_chars as bigint) as n_chars from fx_clf where y = 1 and toxic = 0"))
def q_p03_expr_filter(spark, sf):
    """Filter by a predicate given as an expression string (P-03)."""
    df = FX.classification_rows(spark, sf).where("y == 1 and toxic == 0")
    return normalize(df.select("doc_id", "lang", "source", "n_chars"))


@register("q_v07_ts_cv_forecast", None)
def q_v07_ts_cv_forecast(spark, sf):
    """Time-series CV with early stopping; the test anchor's predictions are
    the mean over fold models (V-07, M-05)."""
    snaps = materialize(create_snapshots(fixture_inputs(spark, sf), fixture_anchors()))
    last = max(a.end_date for a in fixture_anchors())
    feats = FC.predictors(snaps.columns)
    va, models = FC.fit_forecaster_ts_cv(snaps.where(F.col("end_date") < F.lit(last)), feats,
                                         n_splits=3, max_iter=20)
    return FC.predict_averaged(va, models, snaps.where(F.col("end_date") == F.lit(last)))


@register("q_m13_stacking_clf", None)
def q_m13_stacking_clf(spark, sf):
    """Stacked classifier: tree, logistic and naive Bayes base learners,
    logistic meta learner on out-of-fold probabilities (M-13)."""
    df = cat_frame(spark, sf)
    split = holdout(df, "p_partkey")
    train, test = split.where(F.col("is_test") == 0), split.where(F.col("is_test") == 1)
    base = {"tree": ES.pipeline(CAT_FEATURES, ES.classifier("DecisionTree")),
            "logit": ES.pipeline(CAT_FEATURES, ES.classifier("LogisticRegression")),
            "nb": ES.pipeline(CAT_FEATURES, ES.classifier("GaussianNB"))}
    model = fit_stacking_classifier(train, "p_partkey", base, LogisticRegression(labelCol="label"), k=3)
    pred = model.transform(test).select(F.col("label").cast("int").alias("y"),
                                        F.col("prediction").cast("int").alias("p"))
    return M.binary_metrics(pred, "y", "p")


_KNN_SQL = f"""
    with e as (select vec_id, label, cast(embedding as double[]) as x,
                      case when {md5_mod_sql('vec_id', K.HOLDOUT_TEST_BUCKETS)} = 0 then 1 else 0 end as is_test
               from embeddings),
    tr as (select * from e where is_test = 0),
    te as (select * from e where is_test = 1),
    d as (select te.vec_id as qid, te.label as qy, tr.vec_id as nid, tr.label as y,
                 list_distance(te.x, tr.x) as dist from te, tr),
    r as (select *, row_number() over (partition by qid order by dist, nid) as rk from d),
    v as (select qid, qy, y, count(*) as w from r where rk <= 5 group by qid, qy, y)
    select qid as vec_id, qy as y, first(y order by w desc, y) as pred from v group by qid, qy"""


@register("q_m07_knn", normalize_sql(_KNN_SQL, ["vec_id", "y", "pred"], {"vec_id", "y", "pred"}))
def q_m07_knn(spark, sf):
    """Exact 5-nearest-neighbour vote (Euclidean) for the held-out vectors (M-07)."""
    e = holdout(FX.table(spark, sf, "embeddings"), "vec_id", K.HOLDOUT_TEST_BUCKETS)
    train, test = e.where(F.col("is_test") == 0), e.where(F.col("is_test") == 1)
    neigh = knn_neighbours(train, test, k=5, p=2.0, train_id="vec_id", test_id="vec_id",
                           features="embedding", label="label", block_size=128)
    pred = knn_classify(neigh)
    out = test.select(F.col("vec_id").alias("qid"), F.col("label").alias("y")).join(pred, "qid")
    return normalize(out.select(F.col("qid").alias("vec_id"), "y", "pred"))


_KNN_REG_SQL = f"""
    with r as (select o_orderkey, cast(n_lines as double) as a, qty as b, y,
                      case when {md5_mod_sql('o_orderkey', K.HOLDOUT_TEST_BUCKETS)} = 0 then 1 else 0 end as is_test
               from fx_reg),
    tr as (select * from r where is_test = 0),
    te as (select * from r where is_test = 1),
    d as (select te.o_orderkey as qid, tr.o_orderkey as nid, tr.y, abs(te.a - tr.a) + abs(te.b - tr.b) as dist
          from te, tr),
    k as (select *, row_number() over (partition by qid order by dist, nid) as rk from d)
    select qid as o_orderkey, avg(y) as pred from k where rk <= 5 group by qid"""


@register("q_m07_knn_regress", with_ctes({"fx_reg": FIXTURE_SQL["fx_reg"]},
                                         normalize_sql(_KNN_REG_SQL, ["o_orderkey", "pred"], {"o_orderkey"})))
def q_m07_knn_regress(spark, sf):
    """Exact 5-nearest-neighbour regression (Manhattan distance on line
    count and quantity) for the held-out orders (M-07)."""
    df = holdout(FX.regression_rows(spark, sf), "o_orderkey", K.HOLDOUT_TEST_BUCKETS)
    df = df.withColumn("x", F.array(F.col("n_lines").cast("double"), F.col("qty").cast("double")))
    train, test = df.where(F.col("is_test") == 0), df.where(F.col("is_test") == 1)
    neigh = knn_neighbours(train, test, k=5, p=1.0, train_id="o_orderkey", test_id="o_orderkey",
                           features="x", label="y")
    pred = knn_regress(neigh)
    return normalize(pred.select(F.col("qid").alias("o_orderkey"), "pred"))


@register("q_m10_rff_regression", None)
def q_m10_rff_regression(spark, sf):
    """Approximate RBF-kernel regression: random Fourier features + ridge,
    held-out MSE (M-10, regression)."""
    split = materialize(holdout(reg_frame(spark, sf), "o_orderkey"))     # read by every pass of the fits
    est = ES.pipeline(REG_FEATURES, ES.regressor("RFFRidge"), scale=True)
    model = est.fit(split.where(F.col("is_test") == 0))
    return M.mse(model.transform(split.where(F.col("is_test") == 1)), "label", "prediction")
