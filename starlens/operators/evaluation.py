"""Scores, confusion tables and the majority baseline.

Predictions are folded to one row per (label, prediction) first; everything
else works on that small table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlens.functions.measures import ratio

RATING_LABELS = (1, 2, 3, 4, 5)
TOP_FEATURES = 15


def _pairs(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def class_scores(predictions: DataFrame) -> DataFrame:
    """Support, hits, precision, recall and F1 of each label or predicted value."""
    none, n = F.lit(0).cast("bigint"), F.col("n")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)
    sides = F.array(
        F.struct(F.col("label").alias("class"), n.alias("support"), none.alias("predicted"),
                 hit.alias("hits")),
        F.struct(F.col("prediction").alias("class"), none.alias("support"), n.alias("predicted"),
                 none.alias("hits")),
    )

    def rate(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    precision, recall = F.col("precision"), F.col("recall")
    return (
        _pairs(predictions)
        .select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
        .withColumn("precision", rate(F.col("hits"), F.col("predicted")))
        .withColumn("recall", rate(F.col("hits"), F.col("support")))
        .withColumn("f1", rate(2 * precision * recall, precision + recall))
    )


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row: weighted F1, accuracy, weighted precision and weighted recall."""
    support = F.sum("support")

    def weighted(score: str) -> Column:
        return F.sum(F.col(score) * F.col("support")) / support

    return class_scores(predictions).agg(
        weighted("f1").alias("f1"),
        (F.sum("hits") / support).alias("accuracy"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
    )


def evaluation_row(predictions: DataFrame, model: str, model_type: str) -> DataFrame:
    return evaluate(predictions).select(
        F.lit(model).alias("model"), F.lit(model_type).alias("model_type"), "*"
    )


def confusion(predictions: DataFrame, labels: Sequence[float] = RATING_LABELS) -> DataFrame:
    """Counts for every pair of ``labels``, zero where a pair does not occur, and for
    every other pair that occurs, so the counts add up to the rows."""
    # The grid is built from the given labels, which are a handful of classes.
    values = F.array(*map(F.lit, labels))
    grid = (
        predictions.sparkSession.range(1)
        .select(F.explode(values).alias("actual"))
        .select("actual", F.explode(values).alias("predicted"))
    )
    pairs = _pairs(predictions)
    return (
        grid.join(
            pairs,
            (F.col("actual") == F.col("label")) & (F.col("predicted") == F.col("prediction")),
            "full",
        )
        .select(
            F.coalesce("actual", "label").alias("actual"),
            F.coalesce("predicted", "prediction").alias("predicted"),
            F.coalesce("n", F.lit(0)).alias("count"),
        )
        .orderBy("actual", "predicted")
    )


def confusion_pairs(table: DataFrame) -> DataFrame:
    """The pairs of a confusion table that occur."""
    return table.filter(F.col("count") > 0)


def confusion_normalized(table: DataFrame) -> DataFrame:
    """Each count as a share of its actual label; a label without rows gives zeros."""
    row = F.sum("count").over(Window.partitionBy("actual"))
    return table.withColumn("share", ratio(F.col("count"), row))


def majority_label(train: DataFrame) -> DataFrame:
    """One row: the most frequent label, the smallest one on a tie, and its count."""
    return (
        train.filter(F.col("label").isNotNull())
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "label")
        .limit(1)
    )


def predict_majority(train: DataFrame, test: DataFrame) -> DataFrame:
    """(label, prediction) rows of the test labels under the majority rule."""
    rule = majority_label(train).select("label").scalar()
    return test.filter(F.col("label").isNotNull()).select("label", rule.alias("prediction"))


def baseline_metrics(predictions: DataFrame) -> DataFrame:
    """Overall and per-class scores of a baseline as (label, metric, value) rows.

    Macro F1 averages over every label that occurs or is predicted.
    """
    scores = class_scores(predictions)

    def entry(label: Column, metric: str, value: Column) -> Column:
        return F.struct(
            label.cast("string").alias("label"),
            F.lit(metric).alias("metric"),
            F.round(value.cast("double"), 6).alias("value"),
        )

    metrics = ("precision", "recall", "f1", "support")
    per_class = scores.select(
        F.inline(F.array(*[entry(F.col("class"), m, F.col(m)) for m in metrics]))
    )
    everything = F.lit("all")
    overall = scores.agg(
        F.sum("support").alias("rows"), F.sum("hits").alias("hits"), F.avg("f1").alias("f1")
    ).select(
        F.inline(
            F.array(
                entry(everything, "total_test_rows", F.col("rows")),
                entry(everything, "correct_predictions", F.col("hits")),
                entry(everything, "accuracy", F.try_divide("hits", "rows")),
                entry(everything, "macro_f1", F.col("f1")),
            )
        )
    )
    return overall.unionByName(per_class)


def train_labels(df: DataFrame) -> DataFrame:
    return df.select("label").distinct().orderBy("label")


def top_importance(importance: DataFrame, top: int = TOP_FEATURES) -> DataFrame:
    return importance.filter(F.col("rank") <= top).orderBy("rank")


def prior_probs(priors: DataFrame) -> DataFrame:
    """Class probabilities from log priors; one row per class."""
    every_class = Window.partitionBy()
    weight = F.exp(F.col("log_prior") - F.max("log_prior").over(every_class))
    return priors.select("label_value", weight.alias("w")).select(
        "label_value", (F.col("w") / F.sum("w").over(every_class)).alias("prior")
    )


def theta_pivot(theta: DataFrame, labels: Sequence[float] = RATING_LABELS) -> DataFrame:
    """Features by label, holding the log probability of the first slot of each name."""
    values = [float(label) for label in labels]
    return (
        theta.groupBy("feature_name")
        .pivot("label_value", values)
        .agg(F.min_by("log_conditional_probability", "feature_index"))
        .select("feature_name", *[F.col(f"`{v}`").alias(f"label_{v:g}") for v in values])
        .orderBy("feature_name")
    )
