"""Metrics over whole prediction tables, per task where asked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, without_nan

# Loss and metric that a task type is judged by.
TASK_DEFAULTS = {
    "regression": ("mse", "mae"),
    "binary_classification": ("binary_crossentropy", "accuracy"),
    "classification": ("sparse_categorical_crossentropy", "accuracy"),
}
METRIC_COLUMNS = {
    "mse": "mse", "mae": "mae", "accuracy": "accuracy", "binary_crossentropy": "log_loss",
    "sparse_categorical_crossentropy": "log_loss",
}
SMALLEST_PROBABILITY = 1e-7


def _grouped(df: DataFrame, by: list[str]):
    return df.groupBy(*(col(c) for c in by))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def regression_metrics(df: DataFrame, y_true: str, y_pred: str, by: list[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE and value ranges over rows that have both values."""
    truth, guess = without_nan(df, y_true), without_nan(df, y_pred)
    gap = F.when(truth.isNotNull() & guess.isNotNull(), guess - truth)
    mse = F.avg(gap * gap)
    return _grouped(df, list(by)).agg(
        F.count(gap).alias("n"),
        F.avg(F.abs(gap)).alias("mae"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.min(guess).alias("pred_min"),
        F.max(guess).alias("pred_max"),
        F.min(truth).alias("true_min"),
        F.max(truth).alias("true_max"),
    )


def predicted_binary(probability: Column) -> Column:
    return (probability > 0.5).cast("int")


def predicted_class(probabilities: Column) -> Column:
    """Place of the largest probability, the first one on a tie; NaN is no probability."""
    probabilities = F.transform(probabilities, lambda p: F.nanvl(p, F.lit(None).cast("double")))
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def binary_metrics(df: DataFrame, y_true: str, probability: str, by: list[str] = ()) -> DataFrame:
    """Accuracy, the four counts, precision, recall, F1 and cross-entropy from one aggregate.

    Rows without a truth or a probability (NaN is none) are not judged; ``n`` counts the others.
    """
    truth, given = without_nan(df, y_true).cast("int"), without_nan(df, probability)
    guess = predicted_binary(given)
    judged = truth.isNotNull() & given.isNotNull()
    p = F.when(
        judged, F.greatest(F.lit(SMALLEST_PROBABILITY), F.least(F.lit(1 - SMALLEST_PROBABILITY), given))
    )
    counts = _grouped(df, list(by)).agg(
        F.count_if(judged).alias("n"),
        F.count_if((truth == 1) & (guess == 1)).alias("tp"),
        F.count_if((truth == 0) & (guess == 1)).alias("fp"),
        F.count_if((truth == 0) & (guess == 0)).alias("tn"),
        F.count_if((truth == 1) & (guess == 0)).alias("fn"),
        F.avg(-F.when(truth == 1, F.log(p)).otherwise(F.log(1 - p))).alias("log_loss"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.withColumns(
        {
            "accuracy": _ratio(tp + tn, F.col("n")),
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def multiclass_metrics(df: DataFrame, y_true: str, probabilities: str, by: list[str] = ()) -> DataFrame:
    """Accuracy of the most probable class and the cross-entropy of the true one, over rows that have a
    truth and a probability."""
    truth, guess = without_nan(df, y_true).cast("int"), predicted_class(col(probabilities))
    judged = truth.isNotNull() & guess.isNotNull()
    own = F.nanvl(F.get(col(probabilities), truth).cast("double"), F.lit(0.0))
    p = F.when(judged, F.greatest(F.lit(SMALLEST_PROBABILITY), own))
    right = F.when(judged, (guess == truth).cast("int"))
    return _grouped(df, list(by)).agg(
        F.count_if(judged).alias("n"),
        F.sum(right).cast("long").alias("correct"),
        F.avg(right).alias("accuracy"),
        F.avg(-F.log(p)).alias("log_loss"),
    )


def confusion_matrix(df: DataFrame, y_true: str, y_pred: str, by: list[str] = ()) -> DataFrame:
    """Counts per (true, predicted) pair."""
    keys = [*(col(c) for c in by), col(y_true).alias("y_true"), col(y_pred).alias("y_pred")]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    Everything after the confusion matrix works on classes² rows.
    """
    truth, guess, n, none = F.col("y_true"), F.col("y_pred"), F.col("n"), F.lit(0).cast("long")
    hits = F.when(truth == guess, n).otherwise(none)
    sides = F.array(
        F.struct(truth.cast("string").alias("label"), n.alias("s"), none.alias("g"), hits.alias("h")),
        F.struct(guess.cast("string").alias("label"), none.alias("s"), n.alias("g"), none.alias("h")),
    )
    classes = (
        confusion_matrix(df, y_true, y_pred)
        .select(F.inline(sides))
        .groupBy("label")
        .agg(F.sum("s").alias("support"), F.sum("g").alias("guessed"), F.sum("h").alias("hits"))
        .select(
            "label",
            _ratio(F.col("hits"), F.col("guessed")).alias("precision"),
            _ratio(F.col("hits"), F.col("support")).alias("recall"),
            _ratio(2 * F.col("hits"), F.col("guessed") + F.col("support")).alias("f1"),
            "support",
            "hits",
        )
    )
    weight = F.col("support")
    scores = ["precision", "recall", "f1"]
    averages = classes.agg(
        F.sum("support").alias("support"),
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        *(F.avg(c).alias(f"macro_{c}") for c in scores),
        *(_ratio(F.sum(F.col(c) * weight), F.sum(weight)).alias(f"weighted_{c}") for c in scores),
    )
    rows = [
        F.struct(F.lit("accuracy").alias("label"), *(F.col("accuracy").alias(c) for c in scores), weight),
        F.struct(F.lit("macro avg").alias("label"), *(F.col(f"macro_{c}").alias(c) for c in scores), weight),
        F.struct(
            F.lit("weighted avg").alias("label"), *(F.col(f"weighted_{c}").alias(c) for c in scores), weight
        ),
    ]
    return classes.drop("hits").unionByName(averages.select(F.inline(F.array(*rows))))


def task_summary(
    regression: DataFrame | None = None,
    binary: DataFrame | None = None,
    multiclass: DataFrame | None = None,
) -> DataFrame:
    """One row per task ``(task, type, loss, metric)`` over the whole prediction tables.

    Regression tables have ``(task, y_true, y_pred)``, the others ``(task, y_true, probs)``; the loss
    is the mean squared error or the cross-entropy, the metric MAE or accuracy.
    """
    tables = {
        "regression": (regression, regression_metrics, "y_pred"),
        "binary_classification": (binary, binary_metrics, "probs"),
        "classification": (multiclass, multiclass_metrics, "probs"),
    }
    parts = [
        (metrics(given, "y_true", guess, ["task"]), kind, *(METRIC_COLUMNS[m] for m in TASK_DEFAULTS[kind]))
        for kind, (given, metrics, guess) in tables.items()
        if given is not None
    ]
    if not parts:
        raise ValueError("give at least one table of predictions")
    rows = [
        found.select(
            "task",
            F.lit(kind).alias("type"),
            F.coalesce(F.col(loss), F.lit(0.0)).alias("loss"),
            F.coalesce(F.col(metric), F.lit(0.0)).alias("metric"),
        )
        for found, kind, loss, metric in parts
    ]
    result = rows[0]
    for part in rows[1:]:
        result = result.unionByName(part)
    return result
