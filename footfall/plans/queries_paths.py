"""Registered searches along parameter paths (V-04, V-05): scores of every
set and fold, checked by SQL that works each set out by itself."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from footfall import constants as K
from footfall.operators.folds import kfold
from footfall.operators.models import estimators as ES
from footfall.operators.models import paths as PA
from footfall.operators.models import search as S
from footfall.plans import selection as SEL
from footfall.plans.normalize import normalize
from footfall.plans.oracle import FIXTURE_SQL, md5_mod_sql, normalize_sql, with_ctes
from footfall.plans.queries import register
from footfall.sources import fixtures as FX

PARALLELISM = 8


def _score_rows(spark, scores, maps, names):
    """(fold, one column per parameter, score) of a search."""
    rows = [(fold, *[float(m[p]) for p in sorted(m, key=lambda p: p.name)], float(scores[fold, i]))
            for i, m in enumerate(maps) for fold in range(len(scores))]
    return spark.createDataFrame(rows, ", ".join(["fold int", *[f"{n} double" for n in names], "score double"]))


def _vectors(spark, sf):
    """embeddings with folds, as (vec_id, features, label)."""
    e = kfold(FX.table(spark, sf, "embeddings"), "vec_id", K.N_FOLDS)
    return e.select("vec_id", F.col("label").cast("double").alias("label"), "fold",
                    array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("features"))


# macro F1 of (fold, {set}, y, pred) rows: classes are labels or predictions of the set
_F1_SQL = """
    side as (select fold, {set}, y as cls, 1 as asked, 0 as given, cast(y = pred as integer) as tp from preds
             union all select fold, {set}, pred, 0, 1, 0 from preds),
    per as (select fold, {set}, cls, sum(asked) as asked, sum(given) as given, sum(tp) as tp from side group by all)
    select fold, {set}, avg(case when tp = 0 then 0 else 2.0 * tp / (asked + given) end) as score from per group by all"""

_NB_PATH_SQL = f"""
    with e as (select vec_id, label, embedding, {md5_mod_sql('vec_id', K.N_FOLDS)} as own from embeddings),
    f as (select unnest(range({K.N_FOLDS})) as fold),
    x as (select vec_id, label, own, unnest(range(len(embedding))) as dim, cast(unnest(embedding) as double) as v from e),
    st as (select fold, label, dim, avg(v) as mu, var_pop(v) as var from x, f where own <> fold group by all),
    largest as (select fold, max(vp) as largest from (select fold, dim, var_pop(v) as vp from x, f where own <> fold group by all) group by fold),
    prior as (select fold, label, ln(count(*) / sum(count(*)) over (partition by fold)) as lp from e, f where own <> fold group by fold, label),
    vals as (select pow(10.0::double, -9.0 * i / 99) as smoothing from range(100) t(i)),
    smooth as (select st.fold, st.label, st.dim, st.mu, st.var + v.smoothing * l.largest as var, v.smoothing
               from st join largest l on l.fold = st.fold, vals v),
    jll as (select x.vec_id, x.own as fold, s.smoothing, s.label as cls,
                   sum(-0.5 * ln(2 * pi() * s.var) - 0.5 * (x.v - s.mu) * (x.v - s.mu) / s.var) as s
            from x join smooth s on s.fold = x.own and s.dim = x.dim group by all),
    best as (select j.vec_id, j.fold, smoothing, arg_max(j.cls, j.s + p.lp) as pred
             from jll j join prior p on p.fold = j.fold and p.label = j.cls group by all),
    preds as (select b.fold, round(smoothing, 12) as smoothing, e.label as y, b.pred from best b join e using (vec_id)),
    {_F1_SQL.format(set='smoothing').strip()}"""


@register("q_v04_nb_path", normalize_sql(_NB_PATH_SQL, ["fold", "smoothing", "score"], {"fold"}))
def q_v04_nb_path(spark, sf):
    """Macro F1 per fold of Gaussian naive Bayes for the 100 smoothing values
    of the original's grid, moments taken once a fold (V-04, M-08)."""
    nb = ES.classifier("GaussianNB")
    maps = SEL.param_maps(nb, SEL.CLASSIFIER_GRIDS["GaussianNB"])
    scores = PA.fold_scores(_vectors(spark, sf), nb, maps, S.F1MacroEvaluator("label"), "fold", K.N_FOLDS, PARALLELISM)
    out = _score_rows(spark, scores, maps, ["smoothing"])
    return normalize(out.withColumn("smoothing", F.round("smoothing", 12)))


def _knn_path_sql():
    votes = []
    for weights, w in (("uniform", "1.0"), ("distance", "case when zero then cast(dist = 0 as integer) else 1.0 / dist end")):
        votes.append(f"""select fold, p, k, '{weights}' as weights, qid, y, nid_y, {w} as w
            from (select r.*, ks.k, bool_or(dist = 0) over (partition by fold, p, ks.k, qid) as zero
                  from r join ks on r.rk <= ks.k)""")
    dist = {1: "list_sum(list_transform(list_zip(a.x, b.x), lambda z: abs(z[1] - z[2])))",
            2: "list_distance(a.x, b.x)",
            3: "pow(list_sum(list_transform(list_zip(a.x, b.x), lambda z: pow(abs(z[1] - z[2]), 3))), 1.0 / 3)"}
    pairs = " union all ".join(f"""select a.own as fold, {p} as p, a.vec_id as qid, a.label as y, b.vec_id as nid, b.label as nid_y,
        {d} as dist from e a join e b on a.own <> b.own""" for p, d in dist.items())
    return f"""
    with e as (select vec_id, label, cast(embedding as double[]) as x, {md5_mod_sql('vec_id', K.N_FOLDS)} as own from embeddings),
    d as ({pairs}),
    r as (select * from (select *, row_number() over (partition by p, qid order by dist, nid) as rk from d) where rk <= 10),
    ks as (select unnest(range(1, 11)) as k),
    v as ({" union all ".join(votes)}),
    w as (select fold, p, k, weights, qid, y, nid_y, sum(w) as w from v group by all),
    preds as (select fold, p, k, weights, qid, any_value(y) as y, first(nid_y order by w desc, nid_y) as pred
              from w group by fold, p, k, weights, qid),
    {_F1_SQL.format(set='p, k, weights').strip()}"""


@register("q_v05_knn_path", normalize_sql(_knn_path_sql(), ["fold", "p", "k", "weights", "score"], {"fold", "p", "k"}, {"weights"}))
def q_v05_knn_path(spark, sf):
    """Macro F1 per fold of k-NN for k = 1 ... 10, p = 1, 2, 3 and both
    weightings: one neighbour search per fold and p (V-05, M-07)."""
    knn = ES.classifier("KNN", id_col="vec_id")
    maps = SEL.param_maps(knn, {**SEL.CLASSIFIER_GRIDS["KNeighbors"], "weights": ("uniform", "distance")})
    scores = PA.fold_scores(_vectors(spark, sf), knn, maps, S.F1MacroEvaluator("label"), "fold", K.N_FOLDS, PARALLELISM)
    rows = [(fold, float(m[knn.p]), int(m[knn.k]), m[knn.weights], float(scores[fold, i]))
            for i, m in enumerate(maps) for fold in range(K.N_FOLDS)]
    return normalize(spark.createDataFrame(rows, "fold int, p double, k int, weights string, score double")
                     .withColumn("p", F.col("p").cast("int")))


# sums by value of n_lines, then the best cut of a node, of each half, again; a
# cut lies halfway between two values that occur in training, other values follow it
_CUT = """{out} as (
      select {keys}, arg_max((v + after) / 2.0, sl * sl / nl + (s - sl) * (s - sl) / (n - nl)) as cut
      from (select {keys}, v, lead(v) over w as after, sum(n) over w as nl, sum(s) over w as sl,
                   sum(n) over (partition by {keys}) as n, sum(s) over (partition by {keys}) as s
            from {rows} where n > 0 window w as (partition by {keys} order by v))
      where nl < n group by {keys})"""

_TREE_PATH_SQL = with_ctes({"fx_reg": FIXTURE_SQL["fx_reg"]}, normalize_sql(f"""
    with r as (select n_lines as v, y / 1000 as y, {md5_mod_sql('o_orderkey', K.N_FOLDS)} as own from fx_reg),
    f as (select unnest(range({K.N_FOLDS})) as fold),
    s0 as (select fold, v, count(*) filter (own <> fold) as n, coalesce(sum(y) filter (own <> fold), 0) as s from r, f group by all),
    {_CUT.format(out='c1', keys='fold', rows='s0')},
    s1 as (select s0.*, v > cut as a from s0 join c1 using (fold)),
    {_CUT.format(out='c2', keys='fold, a', rows='s1')},
    s2 as (select s1.*, coalesce(v > cut, false) as b from s1 left join c2 using (fold, a)),
    node as (select fold, v, sum(s) over (partition by fold) / sum(n) over (partition by fold) as p0,
                    sum(s) over (partition by fold, a) / sum(n) over (partition by fold, a) as p1,
                    sum(s) over (partition by fold, a, b) / sum(n) over (partition by fold, a, b) as p2 from s2),
    err as (select fold, 0 as depth, (y - p0) ** 2 as e from r join node on own = fold and r.v = node.v
            union all select fold, 1, (y - p1) ** 2 from r join node on own = fold and r.v = node.v
            union all select fold, 2, (y - p2) ** 2 from r join node on own = fold and r.v = node.v)
    select fold, depth, avg(e) as score from err group by all""", ["fold", "depth", "score"], {"fold", "depth"}, digits=4))


@register("q_v04_tree_path", _TREE_PATH_SQL)
def q_v04_tree_path(spark, sf):
    """Held-out MSE per fold of one tree of depth 2, cut at each depth (V-04, M-03)."""
    df = FX.regression_rows(spark, sf).select("o_orderkey", F.col("n_lines").cast("double").alias("x"),
                                              (F.col("y") / 1000).alias("label"))
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(kfold(df, "o_orderkey", K.N_FOLDS))
    tree = DecisionTreeRegressor(featuresCol="features", labelCol="label", seed=505)
    maps = SEL.param_maps(tree, {"maxDepth": (0, 1, 2)})
    scores = PA.fold_scores(df, tree, maps, S.neg_mse_evaluator("label"), "fold", K.N_FOLDS, PARALLELISM)
    return normalize(_score_rows(spark, scores, maps, ["depth"]).withColumn("depth", F.col("depth").cast("int")), 4)
