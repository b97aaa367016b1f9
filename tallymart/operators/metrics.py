"""Exact classification metrics as aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import running_totals


def confusion(pred: DataFrame, label: str = "churned", guess: str = "churn_label") -> DataFrame:
    """``(actual, predicted, n)``, zero cells included."""
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    counted = pred.agg(
        *[
            F.count_if((F.col(label) == a) & (F.col(guess) == p)).alias(f"n{a}{p}")
            for a, p in cells
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"n{a}{p}").alias("n")
            )
            for a, p in cells
        ]
    )
    return counted.select(F.inline(rows))


def classification_report(
    pred: DataFrame, label: str = "churned", guess: str = "churn_label"
) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means.

    A ratio with a zero denominator is 0.
    """
    y, g = F.col(label), F.col(guess)
    counted = pred.agg(
        F.count_if((y == 0) & (g == 0)).alias("tn"),
        F.count_if((y == 0) & (g == 1)).alias("fp"),
        F.count_if((y == 1) & (g == 0)).alias("fn"),
        F.count_if((y == 1) & (g == 1)).alias("tp"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def ratio(num, den):
        return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))

    classes = counted.select(
        (tn + fp + fn + tp).alias("all_n"),
        (tn + fp).alias("s0"),
        (fn + tp).alias("s1"),
        ratio(tn, tn + fn).alias("p0"),
        ratio(tp, tp + fp).alias("p1"),
        ratio(tn, tn + fp).alias("r0"),
        ratio(tp, tp + fn).alias("r1"),
        ratio(tn * 2, tn * 2 + fp + fn).alias("f0"),
        ratio(tp * 2, tp * 2 + fp + fn).alias("f1"),
        ratio(tn + tp, tn + fp + fn + tp).alias("acc"),
    )

    def row(name, values, support):
        return F.struct(
            F.lit(name).alias("class"),
            *[v.alias(n) for n, v in zip(("precision", "recall", "f1_score"), values)],
            support.alias("support"),
        )

    parts = ("p", "r", "f")
    null = F.lit(None).cast("double")
    macro = [(F.col(f"{c}0") + F.col(f"{c}1")) / 2.0 for c in parts]
    weighted = [
        ratio(F.col(f"{c}0") * F.col("s0") + F.col(f"{c}1") * F.col("s1"), F.col("all_n"))
        for c in parts
    ]
    return classes.select(
        F.inline(
            F.array(
                row("0", [F.col(f"{c}0") for c in parts], F.col("s0")),
                row("1", [F.col(f"{c}1") for c in parts], F.col("s1")),
                row("accuracy", [null, null, F.col("acc")], F.col("all_n")),
                row("macro avg", macro, F.col("all_n")),
                row("weighted avg", weighted, F.col("all_n")),
            )
        )
    )


def roc_auc(
    pred: DataFrame,
    label: str = "churned",
    score: str = "churn_probability",
    ranges: int | None = None,
) -> DataFrame:
    """Exact area under the ROC curve as one row; NULL if a class is missing.

    The share of (positive, negative) pairs ranked rightly, a tie counting half,
    from running totals over the distinct scores.  No pair is ever formed.
    """
    scored = pred.where(F.col(score).isNotNull())
    counts = scored.groupBy(
        F.lit("score").alias("measure"), F.col(score).cast("double").alias("x")
    ).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"),
    )
    totals = running_totals(counts, ("pos", "neg"), ranges)
    # doubled so that half a tie stays an integer; decimal, as pairs outgrow a long
    pairs = F.col("pos").cast("decimal(19,0)") * (F.col("neg_before") * 2 + F.col("neg"))
    return totals.agg(
        F.sum(pairs).cast("double").alias("right2"),
        F.max("pos_total").alias("p"),
        F.max("neg_total").alias("n"),
    ).select(
        F.try_divide(
            F.col("right2"), 2.0 * F.col("p").cast("double") * F.col("n").cast("double")
        ).alias("auc")
    )
