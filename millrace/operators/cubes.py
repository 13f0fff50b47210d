"""Metrics for every combination of grouping columns, all subtotals included, from one pass over the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, without_nan
from millrace.operators.evaluation import SMALLEST_PROBABILITY, _ratio, predicted_binary

GROUPING = "grouping"


def _subtotals(finest: DataFrame, by: list[str], sums: list[str], lows: list[str], highs: list[str], sets: list[list[str]] | None) -> DataFrame:
    """The additive columns of ``finest`` (one row per combination) over all wanted grouping sets.

    Rows are expanded after they have been summed to combinations, not before. ``grouping`` has a bit per column of
    ``by``, the first one highest, which is set where the row is a total over that column; so a missing value
    of a column and a total over it stay apart.
    """
    made = [F.sum(col(c)).alias(c) for c in sums] + [F.min(col(c)).alias(c) for c in lows] + [F.max(col(c)).alias(c) for c in highs]
    if sets is None:
        grouped = finest.cube(*(col(c) for c in by)) if by else finest.groupBy()
    else:
        unknown = sorted({c for s in sets for c in s} - set(by))
        if unknown:
            raise ValueError(f"grouping sets name other columns: {unknown}")
        grouped = finest.groupingSets([[col(c) for c in s] for s in sets], *(col(c) for c in by))
    grouping = (F.grouping_id() if by else F.lit(0)).cast("int").alias(GROUPING)
    return grouped.agg(grouping, *made).select(*(col(c) for c in by), GROUPING, *(col(c) for c in [*sums, *lows, *highs]))


def _checked(df: DataFrame, by: list[str]) -> None:
    missing = [c for c in by if c not in df.columns]
    if missing or len(set(by)) != len(by):
        raise ValueError(f"grouping columns must be distinct columns of the table; missing: {missing}")


def regression_cube(df: DataFrame, y_true: str, y_pred: str, by: list[str], sets: list[list[str]] | None = None) -> DataFrame:
    """``by``, ``grouping``, and what :func:`millrace.operators.evaluation.regression_metrics` gives, for every
    subset of ``by``, or those listed in ``sets``."""
    _checked(df, by)
    truth, guess = without_nan(df, y_true).cast("double"), without_nan(df, y_pred).cast("double")
    gap = F.when(truth.isNotNull() & guess.isNotNull(), guess - truth)
    finest = df.groupBy(*(col(c) for c in by)).agg(
        F.count(gap).alias("n"), F.sum(F.abs(gap)).alias("__abs"), F.sum(gap * gap).alias("__square"),
        F.min(guess).alias("pred_min"), F.min(truth).alias("true_min"), F.max(guess).alias("pred_max"), F.max(truth).alias("true_max"))
    whole = _subtotals(finest, by, ["n", "__abs", "__square"], ["pred_min", "true_min"], ["pred_max", "true_max"], sets)
    mse = F.try_divide("__square", "n")
    return whole.select(
        *(col(c) for c in by), GROUPING, "n", F.try_divide("__abs", "n").alias("mae"), mse.alias("mse"), F.sqrt(mse).alias("rmse"),
        "pred_min", "pred_max", "true_min", "true_max")


def binary_cube(df: DataFrame, y_true: str, probability: str, by: list[str], sets: list[list[str]] | None = None) -> DataFrame:
    """``by``, ``grouping``, the four confusion counts, and accuracy, precision, recall, F1 and cross-entropy of them."""
    _checked(df, by)
    truth, p = without_nan(df, y_true).cast("int"), without_nan(df, probability).cast("double")
    judged = truth.isNotNull() & p.isNotNull()
    guess, own = predicted_binary(p), F.greatest(F.lit(SMALLEST_PROBABILITY), F.when(truth == 1, p).otherwise(1 - p))
    cells = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    finest = df.groupBy(*(col(c) for c in by)).agg(
        F.count_if(judged).alias("n"), F.sum(F.when(judged, -F.log(own))).alias("__loss"),
        *(F.count_if(judged & (truth == t) & (guess == g)).alias(name) for name, (t, g) in cells.items()))
    whole = _subtotals(finest, by, ["n", "__loss", *cells], [], [], sets)
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "n"))
    return whole.select(
        *(col(c) for c in by), GROUPING, "n", *cells, F.try_divide(tp + tn, n).alias("accuracy"), _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), F.try_divide("__loss", "n").alias("log_loss"))


def confusion_cube(df: DataFrame, y_true: str, y_pred: str, by: list[str], sets: list[list[str]] | None = None) -> DataFrame:
    """Counts per (true, predicted) pair within every grouping; with the totals over either of the two as well, where
    ``y_true`` or ``y_pred`` has its own bit of ``grouping`` set (they come last)."""
    _checked(df, by)
    named = df.select(*(col(c) for c in by), col(y_true).alias("y_true"), col(y_pred).alias("y_pred"))
    finest = named.groupBy(*named.columns).agg(F.count(F.lit(1)).alias("n"))
    pairs = None if sets is None else [[*s, *pair] for s in sets for pair in (["y_true", "y_pred"], ["y_true"], ["y_pred"], [])]
    return _subtotals(finest, named.columns, ["n"], [], [], pairs)


def metrics_cube(df: DataFrame, y_true: str, y_pred: str, by: list[str], kind: str = "regression", sets: list[list[str]] | None = None) -> DataFrame:
    """The cube of one kind of task: ``regression``, ``binary`` (``y_pred`` a probability) or ``confusion``."""
    kinds = {"regression": regression_cube, "binary": binary_cube, "confusion": confusion_cube}
    if kind not in kinds:
        raise ValueError(f"unknown kind {kind!r}; use one of {list(kinds)}")
    return kinds[kind](df, y_true, y_pred, by, sets)


def total_only(by: list[str], totals: list[str]) -> int:
    """The value of ``grouping`` of rows that are totals over exactly these columns."""
    return reduce(lambda bits, c: 2 * bits + (c in totals), by, 0)
