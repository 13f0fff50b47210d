"""Column profiles, column kinds, and dropping of columns that carry nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, epoch_micros, kind_of, number, numeric_columns, without_nan
from millrace.operators.base import Fitted, Step
from millrace.plans.quantiles import quantiles
from millrace.plans.statistics import correlation, statistics


def describe_table(
    df: DataFrame, columns: list[str] | None = None, estimate_distinct: bool = False
) -> DataFrame:
    """Per numeric column: rows, missing, distinct, mean, sample std, min, quartiles, max.

    Moments are one aggregate and quartiles are exact. Distinct values are counted after a hash
    shuffle of each column's values; ``estimate_distinct`` replaces that by a mergeable sketch, for
    tables where moving every measured value once is too much. The result has one row per column.
    """
    names = numeric_columns(df) if columns is None else columns
    values = {c: number(df, c) for c in names}
    stats = statistics(df, values, ["n", "mean", "std_sample", "min", "max"])
    quarters = quantiles(df, {c: (v, [0.25, 0.5, 0.75]) for c, v in values.items()}, stats)
    distinct = F.approx_count_distinct if estimate_distinct else F.count_distinct
    row = df.agg(*(distinct(v).alias(f"d{i}") for i, v in enumerate(values.values()))).first()
    rows = [
        (
            c, s["n"], s["rows"] - s["n"], row[f"d{i}"], s["mean"], s["std_sample"], s["min"],
            *quarters[c], s["max"],
        )
        for i, (c, s) in enumerate(stats.items())
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "column string, n long, missing long, distinct_values long, mean double, std double, "
        "min double, q25 double, median double, q75 double, max double",
    )


def describe_columns(df: DataFrame, estimate_distinct: bool = False) -> DataFrame:
    """Every column of any kind: rows, missing, distinct values, range and mean.

    ``low``, ``high`` and ``mean`` are numbers: of the values themselves, of their length for text, of
    seconds since 1970 for times, of 0 and 1 for booleans. ``first`` and ``last`` are the smallest and
    largest value as text. NaN is missing. Nested columns are judged by their JSON text.
    """
    numbers, texts = {}, {}
    for field in df.schema.fields:
        name, kind = field.name, kind_of(field.dataType)
        value = without_nan(df, name)
        if kind == "numeric":
            numbers[name] = number(df, name)
        elif kind == "time":
            numbers[name] = epoch_micros(df, name) / F.lit(1_000_000.0)
        elif isinstance(field.dataType, T.BooleanType):
            numbers[name] = value.cast("int").cast("double")
        else:
            value = value if isinstance(field.dataType, T.StringType) else F.to_json(value)
            numbers[name] = F.char_length(value).cast("double")
        texts[name] = value
    stats = statistics(df, numbers, ["n", "mean", "min", "max"])
    ends = df.agg(*(
        pick(v).cast("string").alias(f"{e}{i}") for i, v in enumerate(texts.values()) for e, pick in (("l", F.min), ("h", F.max))
    )).first()
    distinct = F.approx_count_distinct if estimate_distinct else F.count_distinct
    counts = df.agg(*(distinct(v).alias(f"d{i}") for i, v in enumerate(texts.values()))).first()
    kinds = {f.name: "boolean" if isinstance(f.dataType, T.BooleanType) else kind_of(f.dataType) for f in df.schema.fields}
    rows = [
        (
            c, kinds[c], stats[c]["n"], stats[c]["rows"] - stats[c]["n"], counts[f"d{i}"], stats[c]["min"], stats[c]["max"],
            stats[c]["mean"], ends[f"l{i}"], ends[f"h{i}"],
        )
        for i, c in enumerate(texts)
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "column string, kind string, n long, missing long, distinct_values long, low double, high double, mean double, "
        "first string, last string",
    )


def useless_columns(df: DataFrame) -> list[str]:
    """Columns that are all missing or hold a single value, found by one min/max aggregate."""
    aggregates = []
    for i, name in enumerate(df.columns):
        value = without_nan(df, name)
        aggregates += [F.min(value).alias(f"l{i}"), F.max(value).alias(f"h{i}")]
    row = df.agg(*aggregates).first()
    return [c for i, c in enumerate(df.columns) if row[f"l{i}"] == row[f"h{i}"]]


def drop_useless_columns(df: DataFrame) -> DataFrame:
    return DropUseless().fit_transform(df)


class DropUselessModel(Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.select(*(col(c) for c in df.columns if c not in self.state))


class DropUseless(Step):
    """Drops, from any table, the columns that carried nothing in training; ``keep`` names exceptions."""

    model = DropUselessModel

    def learn(self, df: DataFrame) -> dict[str, dict]:
        kept = set(self.settings or ())
        return {c: {"useless": True} for c in useless_columns(df) if c not in kept}


def identify_column_types(df: DataFrame) -> dict[str, list[str]]:
    """``{"numeric": […], "categorical": […], "time": […]}`` from the schema alone."""
    kinds: dict[str, list[str]] = {"numeric": [], "categorical": [], "time": []}
    for field in df.schema.fields:
        kinds[kind_of(field.dataType)].append(field.name)
    return kinds


def column_types_table(df: DataFrame) -> DataFrame:
    """One row per column: kind and number of usable values."""
    counts = df.agg(*(F.count(without_nan(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)))
    row = counts.first()
    rows = [
        (f.name, kind_of(f.dataType), row[f"c{i}"]) for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(rows, "column string, kind string, n_valid long")


def label_correlation(df: DataFrame, label: str, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every numeric column with the label, all in one aggregate."""
    names = [c for c in (columns or numeric_columns(df)) if c != label]
    y = number(df, label)
    row = df.agg(*(correlation(number(df, c), y).alias(f"c{i}") for i, c in enumerate(names))).first()
    return df.sparkSession.createDataFrame(
        [(c, row[f"c{i}"]) for i, c in enumerate(names)], "column string, correlation double"
    )
