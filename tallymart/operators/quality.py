"""Data quality: named checks, column tests and their report.

All checks on one table are computed by one aggregate, so a table is read once
however many checks it has.  Checks on a staged view become conditional counts on
its raw table and join that table's aggregate.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ORDER_STATUSES, PRODUCT_CATEGORIES
from .staging import View

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
ERROR = "error"


Field = Callable[[str], Column]


@dataclass(frozen=True)
class Figure:
    """How many rows meet a condition, or how many distinct values there are.

    ``value`` makes the condition or the value from the columns that a ``Field`` names.
    """

    value: Callable[[Field], Column]
    distinct: bool = False

    def over(self, field: Field, keep: Column | None = None) -> Column:
        """The aggregate over a table, or over the rows of it that ``keep`` selects."""
        value = self.value(field)
        if keep is not None:
            value = F.when(keep, value)
        return F.count_distinct(value) if self.distinct else F.count_if(value)


@dataclass(frozen=True)
class Check:
    """A figure of one table and the condition it must meet."""

    name: str
    table: str
    figure: Figure
    expect: Callable[[Column], Column]


def _zero(figure: Column) -> Column:
    return figure == 0


def standard_checks(
    min_orders: int = 9000,
    min_customers: int = 1900,
    min_days: int = 400,
    categories: int = 5,
) -> list[Check]:
    """The fourteen checks, in report order."""
    rows = Figure(lambda c: F.lit(True))
    return [
        Check(f"raw.orders row count > {min_orders}", "raw_orders", rows, lambda n: n > min_orders),
        Check(
            f"raw.customers row count > {min_customers}",
            "raw_customers",
            rows,
            lambda n: n > min_customers,
        ),
        Check(
            "raw.orders has no null order_ids",
            "raw_orders",
            Figure(lambda c: c("order_id").isNull()),
            _zero,
        ),
        Check(
            "raw.orders unit_price always positive",
            "raw_orders",
            Figure(lambda c: c("unit_price") <= 0),
            _zero,
        ),
        Check(
            "raw.orders quantity always positive",
            "raw_orders",
            Figure(lambda c: c("quantity") <= 0),
            _zero,
        ),
        Check(
            "raw.orders status values are valid",
            "raw_orders",
            Figure(lambda c: ~c("status").isin(*ORDER_STATUSES)),
            _zero,
        ),
        Check(
            "stg_orders line_revenue always positive",
            "stg_orders",
            Figure(lambda c: c("line_revenue") <= 0),
            _zero,
        ),
        Check(
            "stg_customers emails are lowercase",
            "stg_customers",
            Figure(lambda c: c("email") != F.lower(c("email"))),
            _zero,
        ),
        Check(
            "stg_products margin_pct between 0 and 100",
            "stg_products",
            Figure(lambda c: (c("margin_pct") < 0) | (c("margin_pct") > 100)),
            _zero,
        ),
        Check(
            "mart_daily_revenue has no negative revenue days",
            "mart_daily_revenue",
            Figure(lambda c: c("total_revenue") < 0),
            _zero,
        ),
        Check(
            f"mart_daily_revenue covers > {min_days} days",
            "mart_daily_revenue",
            Figure(lambda c: c("order_date"), distinct=True),
            lambda n: n > min_days,
        ),
        Check(
            "mart_customer_lifetime total_revenue always positive",
            "mart_customer_lifetime",
            Figure(lambda c: c("total_revenue") < 0),
            _zero,
        ),
        Check(
            "mart_customer_lifetime no customer has 0 orders",
            "mart_customer_lifetime",
            Figure(lambda c: c("total_orders") == 0),
            _zero,
        ),
        Check(
            f"mart_product_performance covers all {categories} categories",
            "mart_product_performance",
            Figure(lambda c: c("category"), distinct=True),
            lambda n: n == categories,
        ),
    ]


def run_checks(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], views: Mapping[str, View] | None = None
) -> DataFrame:
    """``(position, check, result, status)``, one row per check.

    A check on one of ``views`` whose source is among the tables is counted on the source.
    """
    views = {n: v for n, v in (views or {}).items() if v.source in tables}
    read = {c: views[c.table].source if c.table in views else c.table for c in checks}
    parts = []
    for table in dict.fromkeys(read.values()):
        own = [(i, c) for i, c in enumerate(checks, start=1) if read[c] == table]
        figures = tables[table].agg(*[_figure(c, views).alias(f"c{i}") for i, c in own])
        rows = F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(c.name).alias("check"),
                    F.col(f"c{i}").alias("result"),
                    F.when(c.expect(F.col(f"c{i}")), PASS).otherwise(FAIL).alias("status"),
                )
                for i, c in own
            ]
        )
        parts.append(figures.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


def _figure(check: Check, views: Mapping[str, View]) -> Column:
    view = views.get(check.table)
    if view is None:
        return check.figure.over(F.col)
    return check.figure.over(view.columns.__getitem__, view.keep)


def stamp(results: DataFrame) -> DataFrame:
    """Append the time of the run."""
    return results.withColumn("checked_at", F.current_timestamp())


def report_totals(results: DataFrame) -> DataFrame:
    """Passed, failed and total checks as one row."""
    return results.agg(
        F.count_if(F.col("status") == PASS).alias("passed"),
        F.count_if(F.col("status") == FAIL).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def quality_report(results: DataFrame) -> DataFrame:
    """The report as one nested row: totals, and the checks in order."""
    when = F.date_format(F.col("checked_at"), "yyyy-MM-dd HH:mm:ss")
    entry = F.struct(
        "position",
        "check",
        F.col("result").cast("string").alias("result"),
        "status",
        when.alias("checked_at"),
    )
    report = stamp(results).agg(
        F.max(when).alias("run_time"),
        F.count_if(F.col("status") == PASS).alias("passed"),
        F.count_if(F.col("status") == FAIL).alias("failed"),
        F.count(F.lit(1)).alias("total"),
        F.sort_array(F.collect_list(entry)).alias("checks"),
    )
    return report.withColumn("checks", F.transform("checks", lambda c: c.dropFields("position")))


# -- column tests -----------------------------------------------------------


@dataclass(frozen=True)
class ColumnTest:
    """A declared rule on one column; severity "warn" does not fail a run."""

    table: str
    column: str
    rule: str
    accepted: tuple[str, ...] = ()
    severity: str = ERROR


def standard_column_tests(categories: Sequence[str] = PRODUCT_CATEGORIES) -> list[ColumnTest]:
    return [
        ColumnTest("stg_orders", "order_id", "unique"),
        ColumnTest("stg_orders", "order_id", "not_null"),
        ColumnTest("stg_orders", "customer_id", "not_null"),
        ColumnTest("stg_orders", "status", "accepted_values", ORDER_STATUSES),
        ColumnTest("stg_orders", "quantity", "not_null"),
        ColumnTest("stg_customers", "customer_id", "unique"),
        ColumnTest("stg_customers", "customer_id", "not_null"),
        ColumnTest("stg_customers", "email", "not_null"),
        ColumnTest("stg_customers", "email", "unique", severity="warn"),
        ColumnTest("stg_products", "product_id", "unique"),
        ColumnTest("stg_products", "product_id", "not_null"),
        ColumnTest("stg_products", "category", "accepted_values", tuple(categories)),
    ]


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Non-null values outside the accepted list, with their count."""
    return (
        df.where(~F.col(column).isin(*accepted))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, failures)``: NULLs per column, in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column", "failures")


def _repeated_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many values of each column occur more than once, in one pass."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .agg(*[F.count_if(F.col("column") == c).alias(c) for c in columns])
    )


def _as_failures(figures: DataFrame, tests: Sequence[ColumnTest]) -> DataFrame:
    """The one-row ``figures``, columns in the order of ``tests``, as one row per test."""
    rows = F.array(
        *[
            F.struct(
                F.lit(t.table).alias("table"),
                F.lit(t.column).alias("column"),
                F.lit(t.rule).alias("test"),
                F.col(f"`{name}`").alias("failures"),
                F.lit(t.severity).alias("severity"),
            )
            for t, name in zip(tests, figures.columns)
        ]
    )
    return figures.select(F.inline(rows))


def run_column_tests(tables: Mapping[str, DataFrame], tests: Sequence[ColumnTest]) -> DataFrame:
    """``(table, column, test, failures, severity, status)``, one row per test.

    ``failures`` counts offending values (unique, accepted_values) or rows
    (not_null).  A table is read once for its uniqueness tests and once for all
    others.
    """
    parts = []
    for table in dict.fromkeys(t.table for t in tests):
        df, own = tables[table], [t for t in tests if t.table == table]
        unique = [t for t in own if t.rule == "unique"]
        others = [t for t in own if t.rule != "unique"]
        if unique:
            parts.append(
                _as_failures(_repeated_counts(df, [t.column for t in unique]), unique)
            )
        if others:
            figures = []
            for i, t in enumerate(others):
                value = F.col(t.column)
                if t.rule == "not_null":
                    bad = F.count_if(value.isNull())
                else:
                    bad = F.count_distinct(F.when(~value.isin(*t.accepted), value))
                figures.append(bad.alias(f"f{i}"))
            parts.append(_as_failures(df.agg(*figures), others))
    status = (
        F.when(F.col("failures") == 0, PASS)
        .when(F.col("severity") == ERROR, FAIL)
        .otherwise(WARN)
    )
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)
