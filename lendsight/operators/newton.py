"""Class-weighted logistic regression by Newton steps over plain sums.

A step needs the gradient and the second derivatives of the weighted log loss
at the present coefficients: sums of products of the terms, one aggregate over
the rows with a few dozen numbers as its buffer, whatever the number of rows.
Only these sums reach the driver, which solves a system as wide as the terms.
The optimum is the one of the pipeline in :mod:`lendsight.operators.model`,
without penalty on features scaled to unit deviation; some ten reads of the
rows find it to machine precision, and SQL can restate each of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lendsight.operators.model import LABEL, MODEL_FEATURES

#: A fit ends when no coefficient moves by more than this, measured on scaled features.
TOLERANCE = 1e-10
MOST_STEPS = 50


@dataclass(frozen=True)
class Fit:
    """Coefficients of the scaled features, the intercept, the deviations by which features were divided, and the steps taken."""

    coefficients: list[float]
    intercept: float
    deviations: list[float]
    steps: int

    def margin(self) -> Column:
        """Raw score of the positive class; a feature that did not vary in the fit has no part in it."""
        total = F.lit(self.intercept)
        for name, weight, deviation in zip(MODEL_FEATURES, self.coefficients, self.deviations):
            if deviation > 0:
                total = total + F.lit(weight) * (F.col(name).cast("double") / F.lit(deviation))
        return total


def _scaled(train: DataFrame, deviations: list[float], label: str) -> DataFrame:
    """Terms x0, x1, ... (the intercept's last), y and w of every row."""
    varying = [f"CAST({n} AS DOUBLE) / {d!r}D" for n, d in zip(MODEL_FEATURES, deviations) if d > 0]
    terms = [f"{t} AS x{i}" for i, t in enumerate([*varying, "1.0D"])]
    return train.selectExpr(*terms, f"CAST({label} AS DOUBLE) AS y", "CAST(weight AS DOUBLE) AS w")


def _sums(rows: DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and second derivatives of the mean weighted log loss, from one aggregate."""
    n = len(beta)
    # As a subquery and not as literals, so that the code generated for a step serves all others.
    given = rows.sparkSession.range(1).selectExpr("struct(" + ", ".join(f"{b!r}D AS b{i}" for i, b in enumerate(beta.tolist())) + ") AS beta")
    known = rows.withColumn("beta", given.scalar())
    known = known.selectExpr("*", " + ".join(f"beta.b{i} * x{i}" for i in range(n)) + " AS m").selectExpr("*", "1 / (1 + exp(-m)) AS p")
    known = known.selectExpr("*", "w * (p - y) AS error", "w * p * (1 - p) AS curve")
    wanted = ["sum(w)", "sum(w * (greatest(m, 0D) + log1p(exp(-abs(m))) - y * m))", *[f"sum(error * x{i})" for i in range(n)]]
    wanted += [f"sum(curve * x{i} * x{j})" for i in range(n) for j in range(i, n)]
    total, cost, *values = known.selectExpr(*[f"{c} AS s{i}" for i, c in enumerate(wanted)]).first()
    curves = np.zeros((n, n))
    curves[np.triu_indices(n)] = values[n:]
    curves = curves + np.triu(curves, 1).T
    return cost / total, np.array(values[:n]) / total, curves / total


def fit(train: DataFrame, label: str = LABEL) -> Fit:
    """Fit on rows with the model's features, a 0/1 label and a ``weight``; reads them once a step and should get a stored table.

    A step that would raise the loss is halved. Rows of one class alone, or
    classes that a plane separates, have no optimum: the steps then end at
    ``MOST_STEPS`` or when the second derivatives vanish. No rows are an error.
    """
    spread = train.agg(F.count(F.lit(1)).alias("n"), *[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in MODEL_FEATURES]).first()
    if not spread["n"]:
        raise ValueError("no rows to fit on")
    deviations = [spread[c] or 0.0 for c in MODEL_FEATURES]
    rows = _scaled(train, deviations, label)
    beta = np.zeros(sum(d > 0 for d in deviations) + 1)
    loss, gradient, curves = _sums(rows, beta)
    for steps in range(1, MOST_STEPS + 1):
        step = np.linalg.lstsq(curves, gradient, rcond=None)[0]
        while True:
            moved = beta - step
            moved_loss, moved_gradient, moved_curves = _sums(rows, moved)
            if moved_loss <= loss + 1e-12 or np.abs(step).max() <= TOLERANCE:
                break
            step = step / 2
        beta, loss, gradient, curves = moved, moved_loss, moved_gradient, moved_curves
        if np.abs(step).max() <= TOLERANCE or not np.abs(curves).max() > 0:
            break
    scaled = iter(beta[:-1].tolist())
    return Fit([next(scaled) if d > 0 else 0.0 for d in deviations], float(beta[-1]), deviations, steps)


def predict(dataset: DataFrame, fitted: Fit) -> DataFrame:
    """``dataset`` with margin, probability_positive and prediction (1.0 from a probability over one half)."""
    scored = dataset.withColumn("margin", fitted.margin())
    probability = 1 / (1 + F.exp(-F.col("margin")))
    return scored.withColumns({
        "probability_positive": probability, "prediction": (probability > 0.5).cast("double"),
    })
