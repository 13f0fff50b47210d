"""Safe type conversion: text to numbers, columns to categories, one-hot columns, sentinels."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import TEXT_TYPES, col, kind_of, present, quoted, type_of
from millrace.operators.base import Fitted, Step

WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"


def as_double(df: DataFrame, name: str) -> Column:
    """Text read as DOUBLE; what is no number, or spells NaN, is NULL."""
    parsed = F.expr(f"try_cast({quoted(name)} as double)")
    return F.nanvl(parsed, F.lit(None).cast("double"))


def as_long(name: str) -> Column:
    """Text read as BIGINT: digits exactly, other spellings of a whole number through DOUBLE. A number
    that is not whole is NULL, never cut."""
    text = quoted(name)
    digits = F.expr(f"try_cast(trim({text}) as bigint)")
    value = F.expr(f"try_cast({text} as double)")
    through_double = F.when(value == F.floor(value), F.expr(f"try_cast(try_cast({text} as double) as bigint)"))
    return F.when(col(name).rlike(WHOLE_NUMBER), digits).otherwise(through_double)


@dataclass(frozen=True)
class CastNumericSettings:
    """``numeric_columns=None`` converts every text column that parses; ``[]`` converts nothing."""

    numeric_columns: list[str] | None = None
    preserve_object_integer_types: bool = True
    exclude_cols: list[str] = field(default_factory=list)


class CastNumericModel(Fitted):
    def expressions(self, df: DataFrame) -> dict[str, Column]:
        made = {}
        for name in present(df, self.state):
            if isinstance(type_of(df, name), TEXT_TYPES):
                whole = self.state[name]["type"] == "bigint"
                made[name] = as_long(name) if whole else as_double(df, name)
            else:
                made[name] = col(name).cast(self.state[name]["type"])
        return made


class CastNumeric(Step):
    """Text becomes BIGINT when every parsable value is whole, DOUBLE otherwise; bad text is NULL.

    Without named columns, text columns are taken in which every non-null value parses. A column
    without any value becomes DOUBLE when named.
    """

    model = CastNumericModel

    def __init__(self, settings: CastNumericSettings | None = None, pass_through: bool = False):
        super().__init__(settings or CastNumericSettings(), pass_through)

    def learn(self, df: DataFrame) -> dict[str, dict]:
        s = self.settings
        if s.numeric_columns is None:
            named = [c for c in df.columns if isinstance(type_of(df, c), TEXT_TYPES)]
        else:
            named = present(df, s.numeric_columns)
            unknown = [c for c in s.numeric_columns if c not in df.columns]
            if unknown:
                warnings.warn(f"columns not in the table: {unknown}", stacklevel=2)
        names = [c for c in named if c not in s.exclude_cols]
        text = [c for c in names if isinstance(type_of(df, c), TEXT_TYPES)]
        state = {
            c: {"type": type_of(df, c).simpleString() if kind_of(type_of(df, c)) == "numeric" else "bigint"}
            for c in names
            if c not in text
        }
        if not text:
            return state
        largest = float(2**63)
        aggregates = []
        for i, c in enumerate(text):
            x = as_double(df, c)
            whole = col(c).rlike(WHOLE_NUMBER) | ((x == F.floor(x)) & (F.abs(x) < largest))
            aggregates += [
                F.count(col(c)).alias(f"n{i}"),
                F.count(x).alias(f"p{i}"),
                F.count_if(x.isNotNull() & ~F.coalesce(whole, F.lit(False))).alias(f"f{i}"),
            ]
        row = df.agg(*aggregates).first()
        for i, c in enumerate(text):
            if s.numeric_columns is None and row[f"p{i}"] < max(1, row[f"n{i}"]):
                continue
            whole = row[f"p{i}"] > 0 and row[f"f{i}"] == 0 and s.preserve_object_integer_types
            state[c] = {"type": "bigint" if whole else "double"}
        return state


def cast_categorical(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The columns as trimmed text; by default every column that is neither number nor time."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if kind_of(f.dataType) == "categorical"]
    chosen = present(df, columns)
    return df.withColumns({c: F.trim(col(c).cast("string")) for c in chosen}) if chosen else df


@dataclass(frozen=True)
class OneHotSettings:
    columns: list[str]
    max_categories: int = 1000


class OneHotModel(Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        names = present(df, self.state)
        flags = [
            F.coalesce(col(c) == F.lit(v), F.lit(False)).cast("int").alias(f"{c}_{v}")
            for c in names
            for v in self.state[c]["categories"]
        ]
        return df.select(*(col(c) for c in df.columns if c not in names), *flags)


class OneHot(Step):
    """One 0/1 column per category seen in training; the source column goes away.

    Every category becomes a column of the table, so a column with more than ``max_categories``
    categories is refused: encode it as a code instead.
    """

    model = OneHotModel

    def learn(self, df: DataFrame) -> dict[str, dict]:
        state = {}
        for name in present(df, self.settings.columns):
            limit = self.settings.max_categories
            rows = df.select(col(name).alias("v")).where("v is not null").distinct().limit(limit + 1)
            values = sorted(r["v"] for r in rows.collect())
            if len(values) > limit:
                raise ValueError(f"{name} has more than {limit} categories")
            state[name] = {"categories": values}
        return state


def sort_by_time(
    df: DataFrame, column: str, fmt: str = "dd.MM.yyyy HH:mm:ss", row_id: str | None = None
) -> DataFrame:
    """Parse time text and sort ascending; bad text sorts first as NULL.

    The sort is range-partitioned. Give a ``row_id`` where one time (or NULL) may hold many rows: it
    orders them and lets Spark spread them over several tasks.
    """
    parsed = F.expr(f"try_cast(try_to_timestamp({quoted(column)}, '{fmt}') as timestamp_ntz)")
    order = [col(column), *([col(row_id)] if row_id else [])]
    return df.withColumn(column, parsed).orderBy(*order)


@dataclass(frozen=True)
class Sentinel:
    """Values that mean "no measurement", and the range a real measurement can have."""

    values: tuple[float, ...] = ()
    low: float | None = None
    high: float | None = None


def fix_sentinels(df: DataFrame, rules: dict[str, Sentinel]) -> DataFrame:
    """Sentinels and physically impossible values become NULL."""
    made = {}
    for name in present(df, rules):
        rule, bad = rules[name], F.lit(False)
        if rule.values:
            bad = bad | col(name).isin(list(rule.values))
        if rule.low is not None:
            bad = bad | (col(name) < F.lit(rule.low))
        if rule.high is not None:
            bad = bad | (col(name) > F.lit(rule.high))
        made[name] = F.when(~bad, col(name))
    return df.withColumns(made) if made else df
