"""Classification quality from one confusion table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import safe_divide


def confusion(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)``: the only pass over the predictions."""
    return predictions.groupBy(
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("n"))


def accuracy(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row ``(accuracy)``."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return predictions.agg(F.avg(hit).alias("accuracy"))


def class_metrics(confusion_table: DataFrame) -> DataFrame:
    """``(label, support, recall, precision, f1)`` per class.

    A class is anything that occurs as a label or as a prediction; an undefined
    ratio is 0.
    """
    n, zero = F.col("n"), F.lit(0).cast("bigint")

    def share(cls: str, support: Column, predicted: Column, hit: Column) -> Column:
        return F.struct(
            F.col(cls).alias("label"),
            support.alias("support"),
            predicted.alias("predicted"),
            hit.alias("hit"),
        )

    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    sides = F.array(share("label", n, zero, hit), share("prediction", zero, n, zero))
    per_class = (
        confusion_table.select(F.inline(sides))
        .groupBy("label")
        .agg(
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
            F.sum("hit").alias("hit"),
        )
    )
    recall = safe_divide(F.col("hit"), F.col("support"))
    precision = safe_divide(F.col("hit"), F.col("predicted"))
    f1 = safe_divide(2.0 * F.col("hit"), F.col("support") + F.col("predicted"))
    return per_class.select(
        "label", "support", recall.alias("recall"), precision.alias("precision"), f1.alias("f1")
    )


def summary_metrics(confusion_table: DataFrame) -> DataFrame:
    """One row: accuracy, recall of classes 0 and 1, weighted and macro F1."""
    support = F.col("support")
    total = F.sum(support)

    def recall_of(cls: float) -> Column:
        return F.coalesce(F.max(F.when(F.col("label") == cls, F.col("recall"))), F.lit(0.0))

    return class_metrics(confusion_table).agg(
        (F.sum(F.col("recall") * support) / total).alias("accuracy"),
        recall_of(0.0).alias("recall_0"),
        recall_of(1.0).alias("recall_1"),
        (F.sum(F.col("f1") * support) / total).alias("f1_weighted"),
        F.avg("f1").alias("f1_macro"),
    )
