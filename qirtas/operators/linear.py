"""Linear models by their coefficients: margins as a join, and certificates that a fit is an optimum.

Values are long rows (key, slot, value), see ``hashed.feature_values``; keys are unique.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qirtas.storage import materialize

INTERCEPT = -1  # its slot in reports
# Fixed bound of the coefficient table, which is broadcast.
MAX_SLOTS = 1 << 20


def coefficients(model: Model, like: DataFrame) -> DataFrame:
    """slot, weight: one row for each slot of a binary linear model."""
    if model.coefficients.size > MAX_SLOTS:
        raise ValueError(f"{model.coefficients.size} coefficients; {MAX_SLOTS} are the most")
    rows = [(i, float(w)) for i, w in enumerate(model.coefficients.toArray())]
    return like.sparkSession.createDataFrame(rows, "slot int, weight double")


def margins(values: DataFrame, keys: DataFrame, key: str, model: Model) -> DataFrame:
    """The rows of ``keys`` with ``margin``: a sparse dot product, also for rows without any value."""
    met = values.join(F.broadcast(coefficients(model, values)), "slot")
    products = met.groupBy(key).agg(F.sum(F.col("value") * F.col("weight")).alias("_product"))
    margin = F.coalesce("_product", F.lit(0.0)) + F.lit(float(model.intercept))
    return keys.join(products, key, "left").withColumn("margin", margin).drop("_product")


def _slot_sums(values: DataFrame, residuals: DataFrame, key: str, n: int, sums: dict[str, Column]) -> DataFrame:
    """Per slot the standard deviation over ``n`` rows and ``sums``; zeros are no rows of ``values``."""
    value = F.col("value")
    total, squares = F.sum(value), F.sum(value * value)
    deviation = F.sqrt(F.greatest(squares - total * total / n, F.lit(0.0)) / max(n - 1, 1))
    met = values.join(residuals, key)
    return met.groupBy("slot").agg(deviation.alias("deviation"), *[c.alias(name) for name, c in sums.items()])


def _with_all_slots(rows: DataFrame, model: Model) -> DataFrame:
    return coefficients(model, rows).join(F.broadcast(rows), "slot", "left")


def logistic_gradient(values: DataFrame, train: DataFrame, key: str, model: Model, penalty: float) -> DataFrame:
    """slot, gradient of mean log loss + penalty / 2 * |weights|^2 in units of the slots' deviations.

    ``train`` has key and ``label_idx``.  At the optimum every gradient is zero.  A slot
    that is the same in all rows has no deviation and no say.
    """
    scored = margins(values, train, key, model)
    residual = 1 / (1 + F.exp(-F.col("margin"))) - F.col("label_idx")
    residuals = materialize(scored.select(key, residual.alias("residual")), "residuals")
    n, at_intercept = residuals.agg(F.count("*"), F.avg("residual")).first()
    moved = {"moved": F.sum(F.col("value") * F.col("residual")) / n}
    slots = _with_all_slots(_slot_sums(values, residuals, key, n, moved), model)
    deviation = F.col("deviation")
    gradient = F.when(deviation > 1e-12, F.col("moved") / deviation + penalty * F.col("weight") * deviation).otherwise(0.0)
    ends = values.sparkSession.createDataFrame([(INTERCEPT, at_intercept)], "slot int, gradient double")
    return slots.select("slot", gradient.alias("gradient")).unionByName(ends)


def hinge_slopes(values: DataFrame, train: DataFrame, key: str, model: Model, edge: float = 1e-6) -> DataFrame:
    """slot, up, down: the slopes of the mean hinge loss when a slot's weight grows or shrinks.

    The loss has edges, where a row's margin is 1 (give or take ``edge``): such a row
    counts with the side that is steeper.  At a minimum no slope is below zero.  In
    units of the slots' deviations, as ``logistic_gradient``.
    """
    sign = 2 * F.col("label_idx") - 1
    scored = margins(values, train, key, model).withColumn("sign", sign)
    side = F.col("sign") * F.col("margin") - 1
    sides = materialize(scored.select(key, "sign", side.alias("side")), "sides")
    n = sides.count()
    push = -F.col("sign") * F.col("value")

    def slope(turn: int, push: Column = push) -> Column:
        inside = F.when(F.col("side") < -edge, turn * push)
        return F.sum(inside.when(F.abs("side") <= edge, F.greatest(turn * push, F.lit(0.0))).otherwise(0.0)) / n

    slots = _with_all_slots(_slot_sums(values, sides, key, n, {"up": slope(1), "down": slope(-1)}), model)
    unit = F.when(F.col("deviation") > 1e-12, F.col("deviation"))
    scaled = [F.coalesce(F.col(c) / unit, F.lit(0.0)).alias(c) for c in ("up", "down")]
    one = F.lit(1.0).alias("value")
    ends = sides.select("sign", "side", one).agg(slope(1).alias("up"), slope(-1).alias("down"))
    return slots.select("slot", *scaled).unionByName(ends.select(F.lit(INTERCEPT).alias("slot"), "up", "down"))
