"""Scalar scoring expressions."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper edges of the first four of five equal percentile bins.
QUINTILE_EDGES = (0.2, 0.4, 0.6, 0.8)


def quintile(pct: Column) -> Column:
    """Percentile rank in [0, 1] to a score 1.0 .. 5.0; right-closed bins."""
    score = F.when(pct.isNull(), F.lit(None).cast("double"))
    for i, edge in enumerate(QUINTILE_EDGES):
        score = score.when(pct <= edge, float(i + 1))
    return score.otherwise(5.0)


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` with a zero denominator read as one."""
    return num / F.when(den == 0, F.lit(1)).otherwise(den)


def band(value: Column, bounds: Sequence[tuple[float, str]], default: str) -> Column:
    """First label whose lower bound ``value`` reaches, else ``default``."""
    out = None
    for low, label in bounds:
        out = (F if out is None else out).when(value >= low, label)
    return out.otherwise(default)

