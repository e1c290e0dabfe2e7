"""Evaluation tables as DataFrame queries (E-01 ... E-09, W-02, A-25).

Inputs are tables of (label, score) or (label, prediction); every metric is
an aggregate (partial per task) or a running total computed with bucketed
windows (``ranking.running_totals_desc``), never a single-task sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall import constants as K
from footfall.operators.ranking import running_totals_desc


def _div(a: Column, b: Column) -> Column:
    """a / b, NULL when b is 0 (safe under ANSI mode)."""
    return F.when(b != 0, a.cast("double") / b.cast("double"))


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (the 'zero_division=0' convention)."""
    return F.coalesce(_div(a, b), F.lit(0.0))


# ----------------------------------------------------------- regression ----
def mse(df: DataFrame, y: str, pred: str, by: list[str] | None = None) -> DataFrame:
    """Mean squared error (and RMSE), optionally per group (E-01)."""
    se = F.pow(F.col(y) - F.col(pred), 2)
    aggs = [F.avg(se).alias("mse"), F.sqrt(F.avg(se)).alias("rmse"), F.count(F.lit(1)).alias("n")]
    return df.groupBy(*(by or [])).agg(*aggs)


def score_summary(scores: DataFrame, col: str) -> DataFrame:
    """Mean and population std of fold scores (A-25)."""
    return scores.agg(F.avg(col).alias("mean_score"), F.stddev_pop(col).alias("std_score"),
                      F.count(col).alias("n_folds"))


# -------------------------------------------------------- classification ----
def threshold(score: Column, t: float = 0.5, inclusive: bool = True) -> Column:
    """Class from a probability: ``>= t`` (reports) or ``> t`` (cost sweep) (F-14)."""
    return (score >= t if inclusive else score > t).cast("int")


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Long confusion matrix (actual, predicted, n) (E-02)."""
    return df.groupBy(F.col(y).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def binary_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """tp, fp, fn, tn, accuracy, precision, recall, f1 in one pass (E-03)."""
    yy, pp = F.col(y), F.col(pred)
    c = df.agg(F.count_if((yy == 1) & (pp == 1)).alias("tp"), F.count_if((yy == 0) & (pp == 1)).alias("fp"),
               F.count_if((yy == 1) & (pp == 0)).alias("fn"), F.count_if((yy == 0) & (pp == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    prec, rec = _div(tp, tp + fp), _div(tp, tp + fn)
    return c.select("tp", "fp", "fn", "tn", _div(tp + tn, tp + tn + fp + fn).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    _div(2 * prec * rec, prec + rec).alias("f1"))


def per_class_counts(df: DataFrame, y: str, pred: str) -> DataFrame:
    """(class, support, predicted, tp): one aggregate over each row emitted
    once as its true class and once as its predicted class."""
    rows = F.array(F.struct(F.col(y).alias("cls"), F.lit(1).alias("t"), F.lit(0).alias("p"),
                            (F.col(y) == F.col(pred)).cast("int").alias("tp")),
                   F.struct(F.col(pred).alias("cls"), F.lit(0).alias("t"), F.lit(1).alias("p"),
                            F.lit(0).alias("tp")))
    e = df.select(F.explode(rows).alias("r")).select("r.*")
    return e.groupBy("cls").agg(F.sum("t").alias("support"), F.sum("p").alias("predicted"),
                                F.sum("tp").alias("tp"))


def classification_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Per-class precision/recall/F1/support, macro and weighted averages and
    accuracy, as rows (E-04).  Zero denominators give 0, as the report does."""
    pc = per_class_counts(df, y, pred)
    prec = _div0(F.col("tp"), F.col("predicted"))
    rec = _div0(F.col("tp"), F.col("support"))
    per = pc.select(F.col("cls").cast("string").alias("label"), prec.alias("precision"), rec.alias("recall"),
                    _div0(2 * prec * rec, prec + rec).alias("f1"), F.col("support"), F.col("tp"))
    avg = per.agg(
        F.avg("precision").alias("m_p"), F.avg("recall").alias("m_r"), F.avg("f1").alias("m_f"),
        _div(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("w_p"),
        _div(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("w_r"),
        _div(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("w_f"),
        F.sum("support").alias("n"), F.sum("tp").alias("tp"))
    summary = avg.select(F.explode(F.array(
        F.struct(F.lit("macro avg").alias("label"), F.col("m_p").alias("precision"), F.col("m_r").alias("recall"),
                 F.col("m_f").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), F.col("w_p").alias("precision"),
                 F.col("w_r").alias("recall"), F.col("w_f").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), _div(F.col("tp"), F.col("n")).alias("f1"),
                 F.col("n").alias("support")))).alias("r")).select("r.*")
    return per.drop("tp").unionByName(summary)


def f1_scores(df: DataFrame, y: str, pred: str, positive=1) -> DataFrame:
    """f1 (binary, positive class), f1_micro, f1_macro, f1_weighted (E-05)."""
    pc = per_class_counts(df, y, pred)
    prec = _div0(F.col("tp"), F.col("predicted"))
    rec = _div0(F.col("tp"), F.col("support"))
    f1 = _div0(2 * prec * rec, prec + rec)
    return pc.agg(
        F.max(F.when(F.col("cls") == positive, f1)).alias("f1"),
        _div(F.sum("tp"), F.sum("support")).alias("f1_micro"),
        F.avg(f1).alias("f1_macro"),
        _div(F.sum(f1 * F.col("support")), F.sum("support")).alias("f1_weighted"))


def f1_macro_by_set(df: DataFrame, set_col: str, y: str, pred: str) -> DataFrame:
    """(set, f1_macro): macro F1 of many predictions of the same rows at once;
    a class counts in a set where it is a label or a prediction."""
    counts = df.groupBy(set_col, F.col(y).cast("int").alias("y"), F.col(pred).cast("int").alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("y").alias("cls"), F.col("n").alias("support"), none.alias("predicted"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(none).alias("tp")),
        F.struct(F.col("p").alias("cls"), none.alias("support"), F.col("n").alias("predicted"), none.alias("tp")))
    per = (counts.select(set_col, F.explode(sides).alias("s")).select(set_col, "s.*").groupBy(set_col, "cls")
           .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")]))
    prec, rec = _div0(F.col("tp"), F.col("predicted")), _div0(F.col("tp"), F.col("support"))
    return per.groupBy(set_col).agg(F.avg(_div0(2 * prec * rec, prec + rec)).alias("f1_macro"))


def roc_points(df: DataFrame, y: str, score: str, positive=1, n_buckets: int = 256) -> DataFrame:
    """(threshold, fpr, tpr, tps, fps) at every distinct score (E-06).

    Thresholds are the distinct scores, highest first; the (0, 0) start point
    is implied.  Intermediate collinear points are kept."""
    base = df.select(F.col(score).cast("double").alias("threshold"),
                     (F.col(y) == positive).cast("long").alias("pos"),
                     (F.col(y) != positive).cast("long").alias("neg"))
    cum = running_totals_desc(base, "threshold", ["pos", "neg"], n_buckets)
    totals = base.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    P, N = int(totals["P"] or 0), int(totals["N"] or 0)
    return cum.select("threshold", _div(F.col("cum_neg"), F.lit(N)).alias("fpr"),
                      _div(F.col("cum_pos"), F.lit(P)).alias("tpr"),
                      F.col("cum_pos").alias("tps"), F.col("cum_neg").alias("fps"))


def roc_auc(df: DataFrame, y: str, score: str, positive=1, n_buckets: int = 256) -> DataFrame:
    """Area under the ROC curve by trapezoids over the distinct thresholds (E-07):
    sum_i fp_i * (cum_tp_i - tp_i / 2) / (P N) -- ties count one half."""
    base = df.select(F.col(score).cast("double").alias("threshold"),
                     (F.col(y) == positive).cast("long").alias("pos"),
                     (F.col(y) != positive).cast("long").alias("neg"))
    cum = running_totals_desc(base, "threshold", ["pos", "neg"], n_buckets)
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2.0))
    return cum.agg(_div(area, F.sum("pos") * F.sum("neg")).alias("auc"))


def lift_table(df: DataFrame, y: str, score: str, positive=1, n_buckets: int = 256) -> DataFrame:
    """Cumulative gain and lift at every distinct score, highest first (E-08, W-02):
    share of population reached, share of positives captured, and their ratio."""
    base = df.select(F.col(score).cast("double").alias("threshold"), F.lit(1).cast("long").alias("rows"),
                     (F.col(y) == positive).cast("long").alias("pos"))
    cum = running_totals_desc(base, "threshold", ["rows", "pos"], n_buckets)
    totals = base.agg(F.sum("rows").alias("n"), F.sum("pos").alias("P")).first()
    n, P = int(totals["n"] or 0), int(totals["P"] or 0)
    pct = _div(F.col("cum_rows"), F.lit(n))
    gain = _div(F.col("cum_pos"), F.lit(P))
    return cum.select("threshold", pct.alias("population_share"), gain.alias("gain"),
                      _div(gain, pct).alias("lift"))


def thresholds_grid(n: int = K.N_THRESHOLDS) -> list[float]:
    """Evenly spaced thresholds on [0, 1], computed as start + i * step."""
    step = 1.0 / (n - 1)
    return [0.0 + i * step if i < n - 1 else 1.0 for i in range(n)]


def cost_sweep(df: DataFrame, y: str, score: str, thresholds: list[float] | None = None,
               cost_fp: float = K.COST_FP, cost_fn: float = K.COST_FN) -> DataFrame:
    """(threshold, fp, fn, cost) for ``score > t`` at each threshold (E-09).

    One pass: two conditional counts per threshold, then a small unpivot."""
    ts = thresholds or thresholds_grid()
    s, yy = F.col(score), F.col(y)
    aggs = []
    for i, t in enumerate(ts):
        aggs += [F.count_if((yy == 0) & (s > t)).alias(f"fp{i}"), F.count_if((yy == 1) & (s <= t)).alias(f"fn{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(float(t)).alias("threshold"), F.col(f"fp{i}").alias("fp"), F.col(f"fn{i}").alias("fn"))
            for i, t in enumerate(ts)]
    long = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return long.withColumn("cost", F.col("fp") * F.lit(cost_fp) + F.col("fn") * F.lit(cost_fn))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Lowest cost; on ties the lowest threshold, i.e. the first (O-03)."""
    key = F.struct(F.col("cost"), F.col("threshold"))
    return sweep.agg(F.min_by("threshold", key).alias("threshold"), F.min("cost").alias("cost"))
