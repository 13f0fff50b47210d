"""The learn-on-train, apply-anywhere contract."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.ml import Estimator, Transformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Fitted(Transformer):
    """Learned numbers per column. ``transform`` is a projection: no action, no shuffle.

    ``state`` maps a column name to plain JSON values, so that it can be listed, saved and loaded.
    """

    def __init__(self, settings, state: dict[str, dict]):
        super().__init__()
        self.settings = settings
        self.state = state

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        """New or replaced columns for the given table."""
        raise NotImplementedError

    def _transform(self, df: DataFrame) -> DataFrame:
        added = self.expressions(df)
        return df.withColumns(added) if added else df

    def state_rows(self, step: str) -> list[tuple[str, str, str, str]]:
        return [
            (step, column, name, json.dumps(value, default=str))
            for column, values in self.state.items()
            for name, value in values.items()
        ]


class Step(Estimator):
    """A step that can be switched off: ``pass_through`` returns every table unchanged."""

    model = Fitted

    def __init__(self, settings=None, pass_through: bool = False):
        super().__init__()
        self.settings = settings
        self.pass_through = pass_through

    def learn(self, df: DataFrame) -> dict[str, dict]:
        raise NotImplementedError

    def learns_from_summaries(self) -> bool:
        """Whether ``learn`` also takes a summary in place of rows, and ``summary_columns`` says of what."""
        return False

    def _fit(self, df: DataFrame) -> Transformer:
        return Unchanged() if self.pass_through else self.model(self.settings, self.learn(df))

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


class Unchanged(Fitted):
    def __init__(self):
        super().__init__(None, {})

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        return {}


class Apply(Transformer):
    """A function from table to table as a step that learns nothing and keeps all rows."""

    def __init__(self, name: str, function: Callable[[DataFrame], DataFrame]):
        super().__init__()
        self.name = name
        self.function = function

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.function(df)


def _flat(name: str, value) -> list[tuple[str, object]]:
    """Nested settings as dotted names: ``rules.0.mean``."""
    if isinstance(value, dict):
        return [pair for key, inner in value.items() for pair in _flat(f"{name}.{key}", inner)]
    if isinstance(value, list):
        return [pair for i, inner in enumerate(value) for pair in _flat(f"{name}.{i}", inner)]
    return [(name, value)]


# The name under which a state holds the folder of a table that is too large for it.
TABLE = "table"
STATE_SCHEMA = "step string, column string, name string, value string"


def state_table(spark: SparkSession, models: dict[str, Fitted]) -> DataFrame:
    """All fitted values as rows ``(step, column, name, value)``, nested ones under dotted names."""
    rows = [
        (step, column, flat, None if single is None else str(single))
        for step, model in models.items()
        for column, values in model.state.items()
        for name, value in values.items()
        for flat, single in _flat(name, value)
    ]
    return spark.createDataFrame(rows, STATE_SCHEMA)


def save_state(spark: SparkSession, model: Fitted, path: str) -> None:
    """Write the fitted numbers of one step as a small JSON table, and beside it the tables it refers to."""
    rows = []
    for step, column, name, value in model.state_rows("step"):
        if name == TABLE:
            below = f"tables/{hashlib.sha256(column.encode()).hexdigest()[:16]}"
            spark.read.parquet(json.loads(value)).write.mode("overwrite").parquet(f"{path}/{below}")
            value = json.dumps(below)
        rows.append((step, column, name, value))
    spark.createDataFrame(rows, STATE_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/state")


def load_state(spark: SparkSession, model: type[Fitted], settings, path: str) -> Fitted:
    """Rebuild a fitted step from what :func:`save_state` wrote; nothing else is needed."""
    state: dict[str, dict] = {}
    saved = spark.read.schema(STATE_SCHEMA).json(f"{path}/state").where(F.col("name").isNotNull())
    for row in saved.collect():
        value = json.loads(row["value"])
        state.setdefault(row["column"], {})[row["name"]] = f"{path}/{value}" if row["name"] == TABLE else value
    return model(settings, state)
