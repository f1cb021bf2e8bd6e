"""Model evaluation as frames: everything is one pass over (label, prediction) or over distinct scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.operators.ranks import running_totals

CLASSES = [0, 1]


def regression_metrics(df: DataFrame, label: str = "stars", prediction: str = "prediction") -> DataFrame:
    """Rows, root mean squared error and R squared."""
    y, yhat = F.col(label).cast("double"), F.col(prediction).cast("double")
    sums = df.filter(y.isNotNull() & yhat.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((y - yhat) * (y - yhat)).alias("sse"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("sst"),
    )
    return sums.select(
        "n",
        F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
        (1.0 - F.try_divide("sse", "sst")).alias("r2"),
    )


def auc(df: DataFrame, label: str, score: str = "score") -> DataFrame:
    """Exact area under the ROC curve by rank sum; equal scores count half.

    Rows are first reduced to positives and negatives per distinct score; the running count over scores is
    range-partitioned (see ``ranks``), so neither one score nor one task has to hold the data.
    """
    y, s = F.col(label).cast("double"), F.col(score).cast("double")
    freq = (
        df.filter(y.isNotNull() & s.isNotNull() & ~F.isnan(s))
        .groupBy((s + F.lit(0.0)).alias("v"))
        .agg(F.count_if(y == 1.0).alias("pos"), F.count_if(y != 1.0).alias("neg"))
    )
    ranked = running_totals(freq, ["pos", "neg"])
    wins = F.col("pos").cast("double") * (F.col("before_neg") + F.col("neg") / 2.0)
    return ranked.agg(
        F.max("all_pos").alias("positives"), F.max("all_neg").alias("negatives"), F.sum(wins).alias("wins")
    ).select(
        "positives",
        "negatives",
        F.try_divide(F.col("wins"), F.col("positives").cast("double") * F.col("negatives")).alias("auc"),
    )


def _pairs(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Counts of the four (actual, predicted) pairs ``c00 .. c11``, rows with a missing side left out."""
    y, p = F.col(label), F.col(prediction)
    return df.agg(
        *[F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a in CLASSES for b in CLASSES]
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2.0 * precision * recall, precision + recall)


def confusion_matrix(df: DataFrame, label: str = "success", prediction: str = "prediction") -> DataFrame:
    """The full 2x2 grid with counts and row percentages."""
    cells = [
        F.struct(
            F.lit(a).alias("actual"),
            F.lit(b).alias("predicted"),
            F.col(f"c{a}{b}").alias("n"),
            (_ratio(F.col(f"c{a}{b}"), F.col(f"c{a}0") + F.col(f"c{a}1")) * 100.0).alias("row_pct"),
        )
        for a in CLASSES
        for b in CLASSES
    ]
    return _pairs(df, label, prediction).select(F.inline(F.array(*cells)))


def classification_metrics(df: DataFrame, label: str = "success", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("c00", "c01", "c10", "c11"))
    counted = _pairs(df, label, prediction).select(
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
    )
    return counted.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def class_report(df: DataFrame, label: str = "success", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then their plain and support-weighted means."""

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.cast("long").alias("support"),
        )

    parts = {}
    for c in CLASSES:
        hit = F.col(f"c{c}{c}")
        precision = _ratio(hit, F.col(f"c0{c}") + F.col(f"c1{c}"))
        support = F.col(f"c{c}0") + F.col(f"c{c}1")
        recall = _ratio(hit, support)
        parts[c] = (precision, recall, _f1(precision, recall), support)
    total = parts[0][3] + parts[1][3]
    plain = [(parts[0][i] + parts[1][i]) / 2.0 for i in range(3)]
    weighted = [_ratio(parts[0][i] * parts[0][3] + parts[1][i] * parts[1][3], total) for i in range(3)]
    rows = [row(str(c), *parts[c]) for c in CLASSES]
    rows += [row("macro avg", *plain, total), row("weighted avg", *weighted, total)]
    return _pairs(df, label, prediction).select(F.inline(F.array(*rows)))


def value_counts_of(df: DataFrame, *columns: str) -> DataFrame:
    """How often each value of each column occurs, nulls left out."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
