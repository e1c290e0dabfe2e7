"""Probabilities from margins (M-11): Platt scaling by Newton's method.

p = 1 / (1 + exp(a * margin + b)) with the a, b of least cross entropy against
smoothed targets, (n1 + 1) / (n1 + 2) and 1 / (n0 + 2), so that separable data
have a finite fit.  Objective, gradient and Hessian of a step are one
aggregate of built-in functions; a step that does not lower the objective is
halved.  Rows are read once a step, a handful of steps.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_STEPS = 100
SMALLEST_STEP = 1e-10
RIDGE = 1e-12                 # added to the Hessian's diagonal
GRADIENT = 1e-9               # per row


@dataclass(frozen=True)
class Platt:
    a: float
    b: float

    def probability(self, margin: Column) -> Column:
        """Probability of class 1, without overflow for any margin."""
        z = F.lit(self.a) * margin + F.lit(self.b)
        e = F.exp(-F.abs(z))
        return F.when(z >= 0, e / (1 + e)).otherwise(1 / (1 + e))


def fit_platt(df: DataFrame, margin: str, label: str) -> Platt:
    """Fit on rows with a margin and a 0/1 label; null margins are left out."""
    rows = df.select(F.col(margin).cast("double").alias("f"), (F.col(label) > 0).alias("one")).where(
        "f is not null and one is not null").persist()
    try:
        n = rows.agg(F.count_if("one").alias("one"), F.count_if(~F.col("one")).alias("zero")).first()
        high, low = (n["one"] + 1) / (n["one"] + 2), 1 / (n["zero"] + 2)
        t = F.when(F.col("one"), F.lit(high)).otherwise(F.lit(low))

        def at(a: float, b: float):
            z = F.lit(a) * F.col("f") + F.lit(b)
            e = F.exp(-F.abs(z))
            p = F.when(z >= 0, e / (1 + e)).otherwise(1 / (1 + e))
            loss = F.when(z >= 0, t * z + F.log1p(e)).otherwise((t - 1) * z + F.log1p(e))
            d, w, f = t - p, p * (1 - p), F.col("f")
            return rows.agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in (loss, d * f, d, w * f * f, w * f, w)]).first()

        a, b = 0.0, math.log((n["zero"] + 1) / (n["one"] + 1))
        loss, ga, gb, aa, ab, bb = at(a, b)
        for _ in range(MOST_STEPS):
            if max(abs(ga), abs(gb)) <= GRADIENT * max(1, n["one"] + n["zero"]):
                break
            aa, bb = aa + RIDGE, bb + RIDGE
            det = aa * bb - ab * ab
            da, db = -(bb * ga - ab * gb) / det, -(aa * gb - ab * ga) / det
            slope, step = ga * da + gb * db, 1.0
            while step >= SMALLEST_STEP:
                new = at(a + step * da, b + step * db)
                if new[0] <= loss + 1e-4 * step * slope + 1e-12 * abs(loss):
                    break
                step /= 2
            else:
                break                                    # no lower point along the step
            a, b = a + step * da, b + step * db
            loss, ga, gb, aa, ab, bb = new
        return Platt(a, b)
    finally:
        rows.unpersist()
