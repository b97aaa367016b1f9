"""L2 logistic regression by Newton steps over sums that Spark takes.

Features are a few numeric columns and, optionally, one category column of any number of levels, each
level a feature of its own.  A row has one level, so the second derivatives between levels form a
diagonal, and a step needs only sums per level: levels are eliminated from the equations as an
aggregate over them, the few numeric weights are solved for on the driver, and each level's step
follows from those.  Weights of levels stay a table; neither the plan nor the driver grows with them.

Each evaluation is one aggregate of the rows per level and one of the levels.
"""

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin

#: The fit ends when no derivative of the summed loss is larger.
TOLERANCE = 1e-9
#: Or when a step promises less than this part of the loss, below what sums of doubles resolve.
LEAST_GAIN = 1e-15
MAX_STEPS = 100


def level_table(rows: DataFrame, column: str, train: Column) -> DataFrame:
    """``level, unit`` of all levels but the alphabetically first.

    ``unit`` is what the level's 0/1 column becomes on its own rows when divided by its deviation
    over the ``train`` rows; 1 where it is constant there.
    """
    named = rows.where(F.col(column).isNotNull())
    first = named.select(F.min(column)).scalar()
    share = F.col("n") / rows.where(train).select(F.count(F.lit(1)).cast("double")).scalar()
    dev = F.sqrt(share * (1 - share))
    return (
        named.groupBy(F.col(column).alias("level"))
        .agg(F.count_if(train).alias("n"))
        .where(F.col("level") > first)
        .select("level", F.when(dev > 0, 1 / dev).otherwise(1.0).alias("unit"))
    )


def level_entries(rows: DataFrame, key: str, column: str, prefix: str = "channel") -> DataFrame:
    """``key, feature``: the ones of the 0/1 columns, a row each, whatever the number of levels."""
    named = rows.where(F.col(column).isNotNull())
    first = named.select(F.min(column)).scalar()
    return named.where(F.col(column) > first).select(
        key, F.concat(F.lit(f"{prefix}_"), column).alias("feature")
    )


def _numbers(spark: SparkSession, **vectors: Sequence[float]) -> Column:
    """Arrays of numbers as one scalar: generated code does not change with them, so it is compiled once."""
    row = tuple([float(x) for x in v] for v in vectors.values())
    schema = ", ".join(f"{name} array<double>" for name in vectors)
    return spark.createDataFrame([row], schema).select(F.struct("*")).scalar()


def _margin(columns: Sequence[str], weights: Column) -> Column:
    out = weights[0]
    for i, c in enumerate(columns, 1):
        out = out + F.col(c) * weights[i]
    return out


def _with_levels(rows: DataFrame, column: str | None, weights: DataFrame | None) -> DataFrame:
    """Rows with ``level, unit, weight`` of their level; null, 0, 0 where it has none.

    A plain join: Spark broadcasts the levels if they are small, else splits a level that many rows share.
    """
    if weights is None:
        none = F.lit(None).cast("string").alias("level")
        return rows.select("*", none, F.lit(0.0).alias("unit"), F.lit(0.0).alias("weight"))
    return rows.join(weights, F.col(column) == F.col("level"), "left").na.fill(0.0, ["unit", "weight"])


class LogisticFit:
    """``intercept``, ``coefficients`` of the numeric columns, and ``levels`` (level, unit, weight)."""

    def __init__(self, columns, weights, column, levels, gradient, steps):
        self.columns, self.column, self.levels = list(columns), column, levels
        self.intercept, self.coefficients = float(weights[0]), [float(w) for w in weights[1:]]
        self.largest_derivative, self.steps = float(gradient), steps

    def probability(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with the probability of label 1; a level that was not fitted counts as none."""
        weights = _numbers(rows.sparkSession, weights=[self.intercept, *self.coefficients])
        margin = _margin(self.columns, weights["weights"])
        scored = _with_levels(rows, self.column, self.levels)
        margin = margin + F.col("weight") * F.col("unit")
        return scored.select(*rows.columns, (1 / (1 + F.exp(-margin))).alias(name))


def _pairs(d: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(d) for j in range(i, d)]


def _sums_per_level(rows: DataFrame, columns: Sequence[str], weights: Column, label: str) -> DataFrame:
    """Per level: its unit and weight, and the sums of loss, residual and curvature.

    ``r<i>`` sums residual times x_i, ``w<i>_<j>`` curvature times x_i x_j, with x_0 = 1.
    """
    x = ["1D", *[f"`{c}`" for c in columns]]
    margin = _margin(columns, F.col("now")) + F.col("weight") * F.col("unit")
    at = (
        rows.withColumn("now", weights)
        .withColumn("margin", margin)
        .withColumn("p", F.expr("1 / (1 + exp(-margin))"))
    )
    loss = f"log1p(exp(-abs(margin))) + greatest(margin, 0D) - `{label}` * margin"
    return at.groupBy("level").agg(
        F.max("unit").alias("unit"),
        F.max("weight").alias("weight"),
        F.expr(f"sum({loss}) as loss"),
        *[F.expr(f"sum((p - `{label}`) * {x[i]}) as r{i}") for i in range(len(x))],
        *[F.expr(f"sum(p * (1 - p) * {x[i]} * {x[j]}) as w{i}_{j}") for i, j in _pairs(len(x))],
    )


def _cross(i: int) -> str:
    """Second derivative between a level and x_i."""
    return f"unit * w0_{i}"


def _totals(per_level: DataFrame, d: int, penalty: float):
    """One row: loss, gradient and the equations of the numeric weights with the levels eliminated."""
    slope = f"(unit * r0 + {penalty!r}D * weight)"
    bend = f"(unit * unit * w0_0 + {penalty!r}D)"

    def of_levels(value: str) -> str:
        return f"if(level is null, 0D, {value})"

    row = per_level.agg(
        F.expr(f"sum(loss + {penalty / 2!r}D * weight * weight) as loss"),
        F.expr(f"max({of_levels(f'abs({slope})')}) as steepest"),
        F.expr(f"sum({of_levels(f'{slope} * {slope} / {bend}')}) as gain"),
        *[F.expr(f"sum(r{i}) as g{i}") for i in range(d)],
        *[F.expr(f"sum({of_levels(f'{_cross(i)} * {slope} / {bend}')}) as s{i}") for i in range(d)],
        *[
            F.expr(f"sum(w{i}_{j} - {of_levels(f'{_cross(i)} * {_cross(j)} / {bend}')}) as h{i}_{j}")
            for i, j in _pairs(d)
        ],
    ).first()
    gradient = np.array([row[f"g{i}"] for i in range(d)])
    from_levels = np.array([row[f"s{i}"] for i in range(d)])
    hessian = np.zeros((d, d))
    for i, j in _pairs(d):
        hessian[i, j] = hessian[j, i] = row[f"h{i}_{j}"]
    return row, gradient, from_levels, hessian


def _stepped(per_level: DataFrame, move: Column, d: int, penalty: float) -> DataFrame:
    """``level, unit, weight, step`` that go with a move of the numeric weights."""
    moved = " + ".join(f"{_cross(i)} * move[{i}]" for i in range(d))
    slope = f"(unit * r0 + {penalty!r}D * weight + {moved})"
    step = F.expr(f"-{slope} / (unit * unit * w0_0 + {penalty!r}D) as step")
    own = per_level.where("level is not null").withColumn("move", move)
    return own.select("level", "unit", "weight", step)


def fit_logistic(
    train: DataFrame,
    columns: Sequence[str],
    label: str,
    column: str | None = None,
    levels: DataFrame | None = None,
    c: float = 1.0,
) -> LogisticFit:
    """Minimise summed log loss + half the squared weights / ``c``; the intercept is free.

    ``columns`` are centred and scaled doubles, ``levels`` a :func:`level_table` of ``column``.  Pass a
    table or a pinned frame: it is read once per evaluation.  A level without train rows has weight 0.
    """
    penalty, d = 1.0 / c, len(columns) + 1
    ridge = np.diag([0.0] + [penalty] * (d - 1))
    weights, move, size = np.zeros(d), np.zeros(d), 1.0
    state = None
    if levels is not None:
        state = levels.select("level", "unit", F.lit(0.0).alias("weight"), F.lit(0.0).alias("step"))
    spark = train.sparkSession
    rows = train.select(*columns, label, *([column] if column else []))
    reached = np.inf
    for step in range(MAX_STEPS):
        tried = weights + size * move
        now = _numbers(spark, weights=tried, size=[size])
        current = None
        if state is not None:
            current = state.select(
                "level", "unit", (F.col("weight") + now["size"][0] * F.col("step")).alias("weight")
            )
        per_level = pin(
            _sums_per_level(_with_levels(rows, column, current), columns, now["weights"], label), "newton"
        )
        row, gradient, from_levels, hessian = _totals(per_level, d, penalty)
        if row["loss"] is None:
            raise ValueError("no row to fit on")
        loss = row["loss"] + tried @ ridge @ tried / 2
        if loss > reached + abs(reached) * 1e-12 and size > 1e-6:
            size /= 2  # too far: back along the same step
            continue
        weights, reached, size = tried, loss, 1.0
        gradient = gradient + ridge @ weights
        steepest = max(np.abs(gradient).max(), row["steepest"])
        reduced = gradient - from_levels
        move = -np.linalg.lstsq(hessian + ridge, reduced, rcond=None)[0]
        gain = row["gain"] - reduced @ move
        if state is not None:
            state = _stepped(per_level, _numbers(spark, move=move)["move"], d, penalty)
        if steepest <= TOLERANCE or gain <= LEAST_GAIN * (1 + abs(loss)):
            break
    else:
        raise RuntimeError(f"no convergence after {MAX_STEPS} evaluations")
    found = None
    if levels is not None:
        own = F.coalesce(F.col("weight"), F.lit(0.0)).alias("weight")
        found = pin(levels.join(state.select("level", "weight"), "level", "left").select("level", "unit", own))
    return LogisticFit(columns, weights, column, found, steepest, step + 1)
