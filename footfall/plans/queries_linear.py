"""Registered queries of the models solved from moments and of calibration
(T-07, M-11, M-13), and the dense grid (R-02), each with SQL that works the
result out another way: subsets by Cramer's rule, stacks by ``regr_slope``,
Platt's parameters by a recursive Newton step."""

from __future__ import annotations

from itertools import combinations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from footfall import constants as K
from footfall.operators import profile as PR
from footfall.operators.encode import label_encode
from footfall.operators.folds import holdout
from footfall.operators.models.linear import OLSRegressor, eliminate, moments
from footfall.operators.models.platt import fit_platt
from footfall.operators.models.stacking import StackingRegressor
from footfall.plans.normalize import normalize
from footfall.plans.oracle import FIXTURE_SQL, md5_mod_sql, normalize_sql, with_ctes
from footfall.plans.queries import register
from footfall.sources import fixtures as FX

_REG = {"fx_reg": FIXTURE_SQL["fx_reg"]}
_FEATURES = ("n_lines", "qty", "max_disc", "prio")
STACK_FOLDS = 5


# ------------------------------------------------------------------ T-07 ----
def _det(rows: tuple, cols: tuple) -> str:
    """The determinant of a minor of the covariances, written out; column y is
    the label's."""
    if not rows:
        return "1.0"
    i, *rest = rows
    terms = [f"{'+' if k % 2 == 0 else '-'} c{i}{j} * ({_det(tuple(rest), cols[:k] + cols[k + 1:])})" for k, j in enumerate(cols)]
    return " ".join(terms).lstrip("+ ")


def _rfe_sql() -> str:
    n = len(_FEATURES)
    covs = ", ".join(f"covar_pop({a}, {b}) as c{i}{j}" for i, a in enumerate(_FEATURES)
                     for j, b in [*enumerate(_FEATURES), ("y", "y")])
    coefs = " union all ".join(
        f"select {sum(1 << s for s in subset)} as used, {i} as i, "
        f"({_det(subset, tuple('y' if s == i else s for s in subset))}) / ({_det(subset, subset)}) as b from m"
        for size in range(1, n + 1) for subset in combinations(range(n), size) for i in subset)
    steps = [f"s{n} as (select {n} as k, {(1 << n) - 1} as used, (select arg_min(i, (abs(b), i)) from coefs where used = {(1 << n) - 1}) as gone)"]
    for k in range(n - 1, 0, -1):
        steps.append(f"u{k} as (select used - (1 << gone) as used from s{k + 1}), s{k} as (select {k} as k, used, "
                     f"(select arg_min(i, (abs(b), i)) from coefs where coefs.used = u{k}.used) as gone from u{k})")
    every = " union all ".join(f"select * from s{k}" for k in range(n, 0, -1))
    names = " ".join(f"when {i} then 'x_{f}'" for i, f in enumerate(_FEATURES))
    return f"""
    with r as (select n_lines, qty, max_disc, dense_rank() over (order by o_orderpriority) - 1 as prio, y / 1000 as y from fx_reg),
    m as (select {covs} from r), coefs as ({coefs}), {', '.join(steps)}, path as ({every})
    select k as n_features, case i {names} end as feature, b as coefficient, cast(i = gone as integer) as leaves
    from path join coefs using (used)"""


@register("q_t07_rfe", with_ctes(_REG, normalize_sql(_rfe_sql(), ["n_features", "feature", "coefficient", "leaves"],
                                                     {"n_features", "leaves"}, {"feature"}, digits=4)))
def q_t07_rfe(spark, sf):
    """Feature elimination down to one: coefficients of every step and the
    feature that leaves, from one aggregate (T-07)."""
    df = label_encode(FX.regression_rows(spark, sf), "o_orderpriority", "prio").withColumn("y", F.col("y") / 1000)
    fits = eliminate(moments(df, [F.col(f) for f in _FEATURES], F.col("y"))[None])
    rows = [(len(fits) - step, f"x_{_FEATURES[i]}", float(fit.coefficients[i]), int(i == gone))
            for step, (fit, gone) in enumerate(fits) for i in fit.used]
    return normalize(spark.createDataFrame(rows, "n_features int, feature string, coefficient double, leaves int"), 4)


# ------------------------------------------------------------------ M-13 ----
_STACK_SQL = with_ctes(_REG, normalize_sql(f"""
    with r as (select o_orderkey, n_lines as u, qty as v, y / 1000 as y, {md5_mod_sql('o_orderkey', K.HOLDOUT_TEST_BUCKETS)} = 0 as test,
                      {md5_mod_sql('o_orderkey', STACK_FOLDS)} as own from fx_reg),
    tr as (select * from r where not test),
    f as (select unnest(range({STACK_FOLDS})) as fold),
    m as (select fold, regr_slope(y, u) as bu, regr_intercept(y, u) as au, regr_slope(y, v) as bv, regr_intercept(y, v) as av
          from tr, f where own <> fold group by fold),
    oof as (select y, au + bu * u as p, av + bv * v as q from tr join m on own = fold),
    c as (select covar_pop(p, p) as pp, covar_pop(q, q) as qq, covar_pop(p, q) as pq, covar_pop(p, y) as py, covar_pop(q, y) as qy,
                 avg(p) as mp, avg(q) as mq, avg(y) as my from oof),
    g as (select (py * qq - qy * pq) / (pp * qq - pq * pq) as gp, (qy * pp - py * pq) / (pp * qq - pq * pq) as gq, mp, mq, my from c),
    w as (select regr_slope(y, u) as bu, regr_intercept(y, u) as au, regr_slope(y, v) as bv, regr_intercept(y, v) as av from tr)
    select o_orderkey, my + gp * (au + bu * u - mp) + gq * (av + bv * v - mq) as pred from r, g, w where test""",
    ["o_orderkey", "pred"], {"o_orderkey"}))


@register("q_m13_stack_linear", _STACK_SQL)
def q_m13_stack_linear(spark, sf):
    """Held-out predictions of a linear stack of two linear learners, folds
    and all (M-13)."""
    df = holdout(FX.regression_rows(spark, sf), "o_orderkey", K.HOLDOUT_TEST_BUCKETS).select(
        "o_orderkey", "is_test", F.col("n_lines").cast("double").alias("u"), F.col("qty").cast("double").alias("v"),
        (F.col("y") / 1000).alias("label"))
    df = VectorAssembler(inputCols=["u", "v"], outputCol="features").transform(df)
    stack = StackingRegressor({"lines": OLSRegressor(use=[0]), "quantity": OLSRegressor(use=[1])}, OLSRegressor(),
                              idCol="o_orderkey", numFolds=STACK_FOLDS)
    model = stack.fit(df.where("is_test = 0"))
    return normalize(model.transform(df.where("is_test = 1")).select("o_orderkey", F.col("prediction").alias("pred")))


# ------------------------------------------------------------------ M-11 ----
_PLATT_SQL = with_ctes({"fx_clf": FIXTURE_SQL["fx_clf"], "fx_scores": FIXTURE_SQL["fx_scores"]}, "select * from (" + normalize_sql("""
    with recursive n as (select count(*) filter (where y = 1) as n1, count(*) filter (where y = 0) as n0 from fx_scores),
    r as (select doc_id, 4 * score - 2 as f, case when y = 1 then (n1 + 1) / (n1 + 2) else 1 / (n0 + 2) end as t from fx_scores, n),
    it(k, a, b) as (
      select 0, 0.0::double, ln((n0 + 1) / (n1 + 1))::double from n
      union all
      select k + 1, a - (bb * ga - ab * gb) / (aa * bb - ab * ab), b - (aa * gb - ab * ga) / (aa * bb - ab * ab)
      from (select k, a, b, sum((t - p) * f) as ga, sum(t - p) as gb, sum(p * (1 - p) * f * f) as aa, sum(p * (1 - p) * f) as ab,
                   sum(p * (1 - p)) as bb
            from (select k, a, b, f, t, 1 / (1 + exp(a * f + b)) as p from it, r where k < 25) group by k, a, b))
    select doc_id, 1 / (1 + exp(a * f + b)) as p from r, it where k = 25""", ["doc_id", "p"], {"doc_id"}) + ")")


@register("q_m11_platt", _PLATT_SQL)
def q_m11_platt(spark, sf):
    """Calibrated probability of every labelled document from a given margin (M-11)."""
    df = FX.binary_scores(spark, sf).withColumn("f", 4 * F.col("score") - 2)
    return normalize(df.select("doc_id", fit_platt(df, "f", "y").probability(F.col("f")).alias("p")))


# ------------------------------------------------------------------ R-02 ----
@register("q_r02_densify", with_ctes({"fx_visits": FIXTURE_SQL["fx_visits"]}, """
    select s.store_id, d.visit_date, cast(coalesce(v.visitors, 0) as double) as visitors
    from (select distinct store_id from fx_visits) s cross join (select distinct visit_date from fx_visits) d
    left join fx_visits v on v.store_id = s.store_id and v.visit_date = d.visit_date"""))
def q_r02_densify(spark, sf):
    """Visits of every store on every date any store has, 0 where it has none (R-02)."""
    return normalize(PR.densify(FX.visits(spark, sf), "store_id", "visit_date", "visitors"))
