"""Registered queries: splits (V-*), metrics (E-*, W-02, A-25), encoders (T-*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall import constants as K
from footfall.operators import encode as EN
from footfall.operators import folds as FO
from footfall.operators import metrics as M
from footfall.plans.normalize import normalize
from footfall.plans.oracle import FIXTURE_SQL, md5_mod_sql, normalize_sql, with_ctes
from footfall.plans.queries import register
from footfall.sources import fixtures as FX


def _fx(*names: str) -> dict[str, str]:
    return {n: FIXTURE_SQL[n] for n in names}


def _sql(fx: tuple, body: str, columns: list[str], ints=(), texts=(), dates=(), digits: int = 6) -> str:
    return with_ctes(_fx(*fx), normalize_sql(body, columns, set(ints), texts, dates, digits=digits))


# squared-price metrics are ~1e10: compare them at 2 decimals (13+ significant digits)
PRICE2_DIGITS = 2


# ---------------------------------------------------------------- splits ----
@register("q_v01_holdout", _sql(("fx_reg",), f"select o_orderkey, case when {md5_mod_sql('o_orderkey', K.HOLDOUT_TEST_BUCKETS)} = 0 "
                                 f"then 1 else 0 end as is_test from fx_reg", ["o_orderkey", "is_test"],
                                 ints=("o_orderkey", "is_test")))
def q_v01_holdout(spark, sf):
    df = FO.holdout(FX.regression_rows(spark, sf), "o_orderkey", K.HOLDOUT_TEST_BUCKETS)
    return normalize(df.select("o_orderkey", "is_test"))


@register("q_v02_kfold", _sql(("fx_reg",), f"select o_orderkey, {md5_mod_sql('o_orderkey', K.N_FOLDS)} as fold from fx_reg",
                               ["o_orderkey", "fold"], ints=("o_orderkey", "fold")))
def q_v02_kfold(spark, sf):
    return normalize(FO.kfold(FX.regression_rows(spark, sf), "o_orderkey", K.N_FOLDS).select("o_orderkey", "fold"))


@register("q_v01_holdout_exact", _sql(("fx_reg",), """select o_orderkey, case when row_number() over
    (order by md5(cast(o_orderkey as varchar)), o_orderkey) - 1 < ceil(0.2 * count(*) over ()) then 1 else 0 end
    as is_test from fx_reg""", ["o_orderkey", "is_test"], ints=("o_orderkey", "is_test")))
def q_v01_holdout_exact(spark, sf):
    df = FO.holdout_exact(FX.regression_rows(spark, sf), "o_orderkey", 0.2)
    return normalize(df.select("o_orderkey", "is_test"))


@register("q_v02_kfold_exact", _sql(("fx_reg",), f"""select o_orderkey, (row_number() over
    (order by md5(cast(o_orderkey as varchar)), o_orderkey) - 1) % {K.N_FOLDS} as fold from fx_reg""",
    ["o_orderkey", "fold"], ints=("o_orderkey", "fold")))
def q_v02_kfold_exact(spark, sf):
    return normalize(FO.kfold_exact(FX.regression_rows(spark, sf), "o_orderkey", K.N_FOLDS)
                     .select("o_orderkey", "fold"))


@register("q_v03_stratified", _sql(("fx_clf",), f"select doc_id, y, (row_number() over (partition by y order by "
                                   f"md5(cast(doc_id as varchar)), doc_id) - 1) % {K.N_FOLDS} as fold from fx_clf",
                                   ["doc_id", "y", "fold"], ints=("doc_id", "y", "fold")))
def q_v03_stratified(spark, sf):
    df = FO.stratified_kfold(FX.classification_rows(spark, sf), "doc_id", "y", K.N_FOLDS)
    return normalize(df.select("doc_id", "y", "fold"))


@register("q_v07_time_series_folds", _sql(("fx_visits",), """
    select store_id, visit_date, case when rn >= n - 5 * (n // 6) and n // 6 > 0
           then cast(floor((rn - (n - 5 * (n // 6))) / (n // 6)) as bigint) end as test_fold
    from (select store_id, visit_date, row_number() over (order by visit_date, md5(store_id), store_id) - 1 as rn,
                 count(*) over () as n from fx_visits)""", ["store_id", "visit_date", "test_fold"], ints=("test_fold",)))
def q_v07_time_series_folds(spark, sf):
    df = FO.time_series_folds(FX.visits(spark, sf), "visit_date", "store_id", 5)
    return normalize(df.select("store_id", "visit_date", "test_fold"))


# ------------------------------------------------------------ regression ----
def _fold_mse(spark, sf):
    """k-fold MSE of the mean regressor: each fold predicted by the mean of y
    over the other folds."""
    rows = FO.kfold(FX.regression_rows(spark, sf), "o_orderkey", K.N_FOLDS)
    per = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n_f"), F.sum("y").alias("sy"))
    everything = Window.partitionBy()                    # k rows
    means = per.select("fold", ((F.sum("sy").over(everything) - F.col("sy"))
                                / (F.sum("n_f").over(everything) - F.col("n_f"))).alias("pred"))
    scored = rows.join(F.broadcast(means), "fold")        # k rows: proven bound
    return M.mse(scored, "y", "pred", by=["fold"])


_FOLD_MSE_SQL = f"""
    with r as (select o_orderkey, y, {md5_mod_sql('o_orderkey', K.N_FOLDS)} as fold from fx_reg),
    s as (select fold, count(*) as n_f, sum(y) as sy from r group by fold),
    m as (select fold, (sum(sy) over () - sy) / (sum(n_f) over () - n_f) as pred from s)
    select r.fold, avg(pow(y - pred, 2)) as mse, sqrt(avg(pow(y - pred, 2))) as rmse, count(*) as n
    from r join m on r.fold = m.fold group by r.fold"""


@register("q_e01_fold_mse", _sql(("fx_reg",), _FOLD_MSE_SQL, ["fold", "mse", "rmse", "n"], ints=("fold", "n"),
                                 digits=PRICE2_DIGITS))
def q_e01_fold_mse(spark, sf):
    return normalize(_fold_mse(spark, sf), PRICE2_DIGITS)


@register("q_a25_fold_summary", _sql(("fx_reg",), f"""select avg(mse) as mean_score, stddev_pop(mse) as std_score,
    count(mse) as n_folds from ({_FOLD_MSE_SQL})""", ["mean_score", "std_score", "n_folds"], ints=("n_folds",),
    digits=PRICE2_DIGITS))
def q_a25_fold_summary(spark, sf):
    return normalize(M.score_summary(_fold_mse(spark, sf), "mse"), PRICE2_DIGITS)


# -------------------------------------------------------- classification ----
def _scores(spark, sf):
    return FX.binary_scores(spark, sf).withColumn("pred", M.threshold(F.col("score"), 0.5, inclusive=True))


@register("q_e02_confusion", _sql(("fx_clf", "fx_scores"), "select y as actual, case when score >= 0.5 then 1 else 0 end "
                                  "as predicted, count(*) as n from fx_scores group by 1, 2",
                                  ["actual", "predicted", "n"], ints=("actual", "predicted", "n")))
def q_e02_confusion(spark, sf):
    return normalize(M.confusion(_scores(spark, sf), "y", "pred"))


@register("q_e03_binary_metrics", _sql(("fx_clf", "fx_scores"), """
    with p as (select y, case when score >= 0.5 then 1 else 0 end as pred from fx_scores),
    c as (select count(*) filter (where y = 1 and pred = 1) as tp, count(*) filter (where y = 0 and pred = 1) as fp,
                 count(*) filter (where y = 1 and pred = 0) as fn, count(*) filter (where y = 0 and pred = 0) as tn from p),
    r as (select *, case when tp + fp > 0 then tp / (tp + fp) end as precision,
                 case when tp + fn > 0 then tp / (tp + fn) end as recall from c)
    select tp, fp, fn, tn, (tp + tn) / (tp + tn + fp + fn) as accuracy, precision, recall,
           case when precision + recall > 0 then 2 * precision * recall / (precision + recall) end as f1 from r""",
    ["tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1"], ints=("tp", "fp", "fn", "tn")))
def q_e03_binary_metrics(spark, sf):
    return normalize(M.binary_metrics(_scores(spark, sf), "y", "pred"))


_PER_CLASS_SQL = """
    pc as (select cls, sum(t) as support, sum(p) as predicted, sum(tp) as tp from (
             select y as cls, 1 as t, 0 as p, case when y = pred then 1 else 0 end as tp from {src}
             union all select pred, 0, 1, 0 from {src}) group by cls),
    m as (select cls, support, tp, case when predicted > 0 then tp / predicted else 0 end as precision,
                 case when support > 0 then tp / support else 0 end as recall from pc),
    f as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end
                 as f1 from m)"""


@register("q_e04_report", _sql(("fx_multi",), "with " + _PER_CLASS_SQL.format(src="fx_multi") + """
    select cast(cls as varchar) as label, precision, recall, f1, support from f
    union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from f
    union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                     sum(f1 * support) / sum(support), sum(support) from f
    union all select 'accuracy', null, null, sum(tp) / sum(support), sum(support) from f""",
    ["label", "precision", "recall", "f1", "support"], ints=("support",), texts=("label",)))
def q_e04_report(spark, sf):
    return normalize(M.classification_report(FX.multiclass_predictions(spark, sf), "y", "pred"))


@register("q_e05_f1_variants", _sql(("fx_clf", "fx_scores"), "with p as (select y, case when score >= 0.5 then 1 else 0 end "
                                    "as pred from fx_scores), " + _PER_CLASS_SQL.format(src="p") + """
    select max(f1) filter (where cls = 1) as f1, sum(tp) / sum(support) as f1_micro, avg(f1) as f1_macro,
           sum(f1 * support) / sum(support) as f1_weighted from f""",
    ["f1", "f1_micro", "f1_macro", "f1_weighted"]))
def q_e05_f1_variants(spark, sf):
    return normalize(M.f1_scores(_scores(spark, sf), "y", "pred"))


_CUM_SQL = """
    g as (select score as threshold, sum(case when y = 1 then 1 else 0 end) as pos,
                 sum(case when y = 1 then 0 else 1 end) as neg, count(*) as rows from fx_scores group by score),
    c as (select *, sum(pos) over w as cum_pos, sum(neg) over w as cum_neg, sum(rows) over w as cum_rows,
                 sum(pos) over () as tot_pos, sum(neg) over () as tot_neg, sum(rows) over () as tot_rows
          from g window w as (order by threshold desc rows between unbounded preceding and current row))"""


@register("q_e06_roc", _sql(("fx_clf", "fx_scores"), "with " + _CUM_SQL + """
    select threshold, cum_neg / tot_neg as fpr, cum_pos / tot_pos as tpr, cum_pos as tps, cum_neg as fps from c""",
    ["threshold", "fpr", "tpr", "tps", "fps"], ints=("tps", "fps")))
def q_e06_roc(spark, sf):
    return normalize(M.roc_points(FX.binary_scores(spark, sf), "y", "score"))


@register("q_e07_auc", _sql(("fx_clf", "fx_scores"), "with " + _CUM_SQL + """
    select sum(neg * (cum_pos - pos / 2.0)) / (max(tot_pos) * max(tot_neg)) as auc from c""", ["auc"]))
def q_e07_auc(spark, sf):
    return normalize(M.roc_auc(FX.binary_scores(spark, sf), "y", "score"))


@register("q_e08_lift", _sql(("fx_clf", "fx_scores"), "with " + _CUM_SQL + """
    select threshold, cum_rows / tot_rows as population_share, cum_pos / tot_pos as gain,
           (cum_pos / tot_pos) / (cum_rows / tot_rows) as lift
    from c""", ["threshold", "population_share", "gain", "lift"]))
def q_e08_lift(spark, sf):
    return normalize(M.lift_table(FX.binary_scores(spark, sf), "y", "score"))


_THRESHOLDS = ", ".join(f"({t!r})" for t in M.thresholds_grid())
_SWEEP_SQL = f"""
    select t.threshold, count(*) filter (where y = 0 and score > t.threshold) as fp,
           count(*) filter (where y = 1 and score <= t.threshold) as fn
    from (select * from (values {_THRESHOLDS}) v(threshold)) t, fx_scores group by t.threshold"""


@register("q_e09_cost_sweep", _sql(("fx_clf", "fx_scores"), f"""select threshold, fp, fn,
    fp * {K.COST_FP} + fn * {K.COST_FN} as cost from ({_SWEEP_SQL})""", ["threshold", "fp", "fn", "cost"],
    ints=("fp", "fn")))
def q_e09_cost_sweep(spark, sf):
    return normalize(M.cost_sweep(FX.binary_scores(spark, sf), "y", "score"))


@register("q_e09_best_threshold", _sql(("fx_clf", "fx_scores"), f"""select threshold, cost from (
    select threshold, fp * {K.COST_FP} + fn * {K.COST_FN} as cost from ({_SWEEP_SQL}))
    order by cost, threshold limit 1""", ["threshold", "cost"]))
def q_e09_best_threshold(spark, sf):
    return normalize(M.best_threshold(M.cost_sweep(FX.binary_scores(spark, sf), "y", "score")))


# -------------------------------------------------------------- encoders ----
@register("q_t01_label_codes", _sql(("fx_cat",), "select p_partkey, p_brand, dense_rank() over (order by p_brand) - 1 "
                                    "as brand_code from fx_cat", ["p_partkey", "p_brand", "brand_code"],
                                    ints=("p_partkey", "brand_code"), texts=("p_brand",)))
def q_t01_label_codes(spark, sf):
    df = EN.label_encode(FX.categorical_rows(spark, sf), "p_brand", "brand_code")
    return normalize(df.select("p_partkey", "p_brand", "brand_code"))


@register("q_t02_ordinal", _sql(("fx_cat",), "select p_partkey, dense_rank() over (order by p_brand) - 1 as p_brand_code, "
                                "dense_rank() over (order by p_type) - 1 as p_type_code from fx_cat",
                                ["p_partkey", "p_brand_code", "p_type_code"], ints=("p_partkey", "p_brand_code", "p_type_code")))
def q_t02_ordinal(spark, sf):
    df = EN.ordinal_encode(FX.categorical_rows(spark, sf), ["p_brand", "p_type"])
    return normalize(df.select("p_partkey", "p_brand_code", "p_type_code"))


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@register("q_t03_one_hot", "select o_orderkey, " + ", ".join(
    f"cast(o_orderpriority = '{p}' as bigint) as \"{p}\"" for p in _PRIORITIES) + " from orders")
def q_t03_one_hot(spark, sf):
    o = FX.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    levels = EN.one_hot_levels(o, "o_orderpriority")       # one column a level: their number is checked
    return normalize(EN.one_hot(o, "o_orderpriority", levels).drop("o_orderpriority"))


_SCALE = ["n_lines", "qty", "max_disc", "y"]


@register("q_t04_standardize", _sql(("fx_reg",), "select o_orderkey, " + ", ".join(
    f"({c} - avg({c}) over ()) / stddev_pop({c}) over () as {c}" for c in _SCALE) + " from fx_reg",
    ["o_orderkey"] + _SCALE, ints=("o_orderkey",)))
def q_t04_standardize(spark, sf):
    df = FX.regression_rows(spark, sf).select("o_orderkey", *_SCALE)
    return normalize(EN.standardize(df, _SCALE))


@register("q_t05_scale_subset", _sql(("fx_reg",), "select o_orderkey, n_lines, o_orderpriority, y, " + ", ".join(
    f"({c} - avg({c}) over ()) / stddev_pop({c}) over () as {c}" for c in ("qty", "max_disc")) + " from fx_reg",
    ["o_orderkey", "n_lines", "o_orderpriority", "y", "qty", "max_disc"], ints=("o_orderkey", "n_lines"),
    texts=("o_orderpriority",)))
def q_t05_scale_subset(spark, sf):
    df = FX.regression_rows(spark, sf)
    return normalize(EN.standardize(df, ["qty", "max_disc"]))
