"""Churn features, model and predictions."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (
    CHURN_AFTER_DAYS,
    DAYS_PER_MONTH,
    LABEL_THRESHOLD,
    LOWEST_RISK,
    RISK_BANDS,
    SEED,
    TEST_SHARE,
)
from ..functions.scoring import band, safe_ratio
from ..session import pin
from .logistic import LogisticFit, fit_logistic, level_table
from .marts import active_customers
from .segments import snapshot_of
from .splits import with_split

NUMERIC_FEATURES = (
    "completed_orders",
    "total_revenue",
    "avg_order_value",
    "days_since_signup",
    "days_since_last_order",
    "order_rate",
    "return_rate",
)
CHANNEL = "acquisition_channel"
PREDICTION_COLUMNS = (
    "customer_id",
    "customer_name",
    "city",
    "acquisition_channel",
    "completed_orders",
    "total_revenue",
    "days_since_last_order",
    "churn_probability",
    "churn_label",
    "churn_risk",
)


def lifetime_of_customers(lifetime: DataFrame, customers: DataFrame) -> DataFrame:
    """Active customers that the customer table knows; name, city and channel from there."""
    attributes = customers.select("customer_id", "customer_name", CHANNEL, "city")
    active = active_customers(lifetime).drop("customer_name", CHANNEL, "city")
    return active.join(attributes, "customer_id").select(
        "customer_id",
        "customer_name",
        CHANNEL,
        "city",
        "total_orders",
        "completed_orders",
        "total_revenue",
        "avg_order_value",
        "first_order_date",
        "last_order_date",
        "signup_date",
    )


def churn_features(
    lifetime: DataFrame,
    customers: DataFrame,
    snapshot: Column | None = None,
    churn_after_days: int = CHURN_AFTER_DAYS,
) -> DataFrame:
    """Recency, tenure, order rate, return rate and the churn label.

    Pending orders count as returned in ``return_rate``, and the label is a
    function of ``days_since_last_order``; both are the model's definition.  The
    order rate of a customer who signed up on the snapshot day is 0.
    """
    snapshot = snapshot_of(lifetime) if snapshot is None else snapshot
    days = F.col("days_since_signup") / F.lit(float(DAYS_PER_MONTH))
    rate = F.try_divide(F.col("completed_orders").cast("double"), days)
    lost = F.col("total_orders") - F.col("completed_orders")
    return (
        lifetime_of_customers(lifetime, customers)
        .withColumn("days_since_last_order", F.datediff(snapshot, "last_order_date"))
        .withColumn("days_since_signup", F.datediff(snapshot, "signup_date"))
        .withColumn(
            "churned", (F.col("days_since_last_order") > churn_after_days).cast("int")
        )
        .withColumn("order_rate", F.coalesce(rate, F.lit(0.0)))
        .withColumn("return_rate", safe_ratio(lost, F.col("total_orders")))
        .na.fill(0.0, ["avg_order_value"])
    )


def churn_totals(features: DataFrame) -> DataFrame:
    """Churned and active customers with their shares, as one row."""
    y = F.col("churned")
    n = F.count("churned").cast("double")
    return features.agg(
        F.sum(y).alias("churned_customers"),
        F.try_divide(F.sum(y).cast("double"), n).alias("churned_share"),
        F.count_if(y == 0).alias("active_customers"),
        F.try_divide(F.count_if(y == 0).cast("double"), n).alias("active_share"),
    )


def category_levels(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values of a category column, for the form with a column each."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(r[0] for r in rows)


def one_hot(
    df: DataFrame, column: str, levels: Sequence[str] | None = None, prefix: str = "channel"
) -> DataFrame:
    """0/1 columns ``<prefix>_<level>`` for all levels but the alphabetically first.

    A table as wide as its levels, to be shown or exported; the model takes ``logistic.level_table``.
    """
    levels = category_levels(df, column) if levels is None else sorted(levels)
    return df.select(
        "*",
        *[
            F.when(F.col(column) == level, 1).otherwise(0).alias(f"{prefix}_{level}")
            for level in levels[1:]
        ],
    )


def feature_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    dummies = [c for c in df.columns if c.startswith("channel_")]
    return [c for c in (*NUMERIC_FEATURES, *dummies) if c not in exclude]


def assemble(df: DataFrame, columns: Sequence[str], prefix: str = "") -> DataFrame:
    """Feature columns as DOUBLE with NULL read as 0, in place or beside the originals."""
    return df.withColumns(
        {prefix + c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    )


def moments(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: mean and population deviation of each column."""
    return train.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_dev") for c in columns],
    )


def standardize(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns of ``df`` centred and scaled by the train rows; a constant column becomes 0."""
    out = df.withColumn("moments", moments(train, columns).select(F.struct("*")).scalar())
    scaled = {}
    for c in columns:
        dev = F.col(f"moments.{c}_dev")
        scaled[c] = (F.col(c) - F.col(f"moments.{c}_mean")) / F.when(dev > 0, dev).otherwise(1.0)
    return out.withColumns(scaled).drop("moments")


def fit_churn(
    train: DataFrame,
    columns: Sequence[str],
    c: float = 1.0,
    channel: str | None = None,
    levels: DataFrame | None = None,
) -> LogisticFit:
    """L2 logistic regression on standardised columns and the levels of a channel.

    ``c`` weighs the summed loss against the penalty.
    """
    return fit_logistic(train, columns, "churned", channel, levels, c)


def score_churn(model: LogisticFit, df: DataFrame) -> DataFrame:
    """Append ``churn_probability``."""
    return model.probability(df, "churn_probability")


def label_churn(scored: DataFrame) -> DataFrame:
    """Append the predicted label and risk band, both from the unrounded probability."""
    p = F.col("churn_probability")
    return scored.withColumn("churn_label", (p > LABEL_THRESHOLD).cast("int")).withColumn(
        "churn_risk", band(p, RISK_BANDS, LOWEST_RISK)
    )


def prediction_mart(labelled: DataFrame) -> DataFrame:
    """The prediction mart's columns; probability to four places."""
    return labelled.withColumn(
        "churn_probability", F.round("churn_probability", 4)
    ).select(*PREDICTION_COLUMNS)


def coefficients(model: LogisticFit, names: Sequence[str], spark) -> DataFrame:
    """Feature weights in ascending order with their direction."""
    table = spark.createDataFrame(
        list(zip(names, model.coefficients)), "feature string, coefficient double"
    )
    if model.levels is not None:
        table = table.unionAll(
            model.levels.select(F.concat(F.lit("channel_"), "level"), F.col("weight"))
        )
    return table.orderBy("coefficient", "feature").withColumn(
        "raises_risk", F.col("coefficient") > 0
    )


class ChurnRun:
    """One training run: the pinned feature table, the fitted model and its outputs.

    ``exclude`` names numeric features, or the channel, that the model must not see.
    """

    def __init__(
        self,
        lifetime: DataFrame,
        customers: DataFrame,
        snapshot: Column | None = None,
        exclude: Sequence[str] = (),
        share: float = TEST_SHARE,
        seed: int = SEED,
    ):
        self.spark = lifetime.sparkSession
        features = with_split(pin(churn_features(lifetime, customers, snapshot)), share=share, seed=seed)
        self.columns = [c for c in NUMERIC_FEATURES if c not in exclude]
        self.inputs = [f"x_{c}" for c in self.columns]
        matrix = features.withColumns(
            {f"x_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.columns}
        )
        train = ~F.col("is_test")
        # Scaled once for training, testing and scoring alike; the plain columns
        # stay beside the scaled ones, so nothing is joined back afterwards.
        self.matrix = pin(standardize(matrix, matrix.where(train), self.inputs))
        channel = None if CHANNEL in exclude else CHANNEL
        levels = pin(level_table(self.matrix, CHANNEL, train)) if channel else None
        self.model = fit_churn(self.matrix.where(train), self.inputs, channel=channel, levels=levels)
        self.scored = label_churn(score_churn(self.model, self.matrix))

    def test_predictions(self) -> DataFrame:
        """Label, prediction and probability of the test rows."""
        return self.scored.where("is_test").select(
            "customer_id", "churned", "churn_label", "churn_probability"
        )

    def coefficients(self) -> DataFrame:
        return coefficients(self.model, self.columns, self.spark)

    def predictions(self) -> DataFrame:
        """The prediction mart over all customers."""
        return prediction_mart(self.scored)

    def derivatives(self, c: float = 1.0) -> DataFrame:
        """``feature, derivative`` of the penalised loss over the train rows; all 0 at its least value.

        Taken from the scored rows and the coefficients, by the form with a 0/1 column per level,
        centred and scaled like the numbers: not by the sums that the fit uses.
        """
        wide = one_hot(self.scored, CHANNEL) if self.model.levels is not None else self.scored
        names = [c for c in wide.columns if c.startswith("channel_")]
        train = wide.where(~F.col("is_test"))
        columns = dict(zip(self.columns, self.inputs)) | {n: n for n in names}
        scaled = standardize(train, train, names) if names else train
        residual = F.col("churn_probability") - F.col("churned")
        sums = scaled.agg(
            F.sum(residual).alias("intercept"),
            *[F.sum(residual * F.col(x)).alias(n) for n, x in columns.items()],
        ).unpivot([], ["intercept", *columns], "feature", "slope")
        weights = self.coefficients().select("feature", "coefficient")
        pull = F.coalesce(F.col("coefficient"), F.lit(0.0)) / c
        return sums.join(weights, "feature", "left").select(
            "feature", (F.col("slope") + pull).alias("derivative")
        )
