"""Ordered preparation stages: fit on the training table, apply to any table."""

from __future__ import annotations

import inspect
import pickle
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.ml import Estimator, Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.base import Fitted, Step, Unchanged, load_state, save_state, state_table
from millrace.operators.mergeable import Summary, fit_summary, mergeable, summary_for
from millrace.session import materialize


@dataclass(frozen=True, eq=False)
class RowStep:
    """A step that changes the row count: it runs on every table anew and learns nothing."""

    name: str
    operate: Callable[[DataFrame], DataFrame]

    def apply(self, df: DataFrame) -> DataFrame:
        return self.operate(df)


@dataclass(frozen=True)
class Stage:
    """``len_change`` stages hold steps with ``apply``; all others hold estimators or transformers."""

    obj_list: tuple
    len_change: bool = False

    def __post_init__(self):
        if not isinstance(self.len_change, bool):
            raise TypeError("len_change must be True or False")
        if not self.obj_list:
            raise ValueError("a stage needs at least one step")
        for step in self.obj_list:
            if inspect.isclass(step):
                raise TypeError(f"{step.__name__} is a class; give an instance")
            if self.len_change and not callable(getattr(step, "apply", None)):
                raise TypeError(f"{type(step).__name__} has no apply method")
            if not self.len_change and not isinstance(step, (Estimator, Transformer)):
                raise TypeError(f"{type(step).__name__} can neither be fit nor transform")
        if len({id(step) for step in self.obj_list}) != len(self.obj_list):
            raise ValueError("a step appears twice in a stage")


def _step_name(step) -> str:
    return getattr(step, "name", None) or type(step).__name__


class Preparation:
    """All stages in order.

    With ``keep_row_changes`` the table is written after each row-changing step, so that the fits
    and counts behind it do not repeat its shuffle.
    """

    def __init__(self, stages: list[Stage | dict], keep_row_changes: bool = True):
        if not stages:
            raise ValueError("give at least one stage")
        self.stages = [
            s if isinstance(s, Stage) else Stage(tuple(s["obj_list"]), s["len_change"]) for s in stages
        ]
        steps = [id(step) for stage in self.stages for step in stage.obj_list]
        if len(set(steps)) != len(steps):
            raise ValueError("a step appears in two stages")
        self.keep_row_changes = keep_row_changes

    def fit_transform(self, df: DataFrame, growing: bool = False) -> tuple["Prepared", DataFrame]:
        """Fit each step on the output of the steps before it.

        With ``growing`` the steps that can learn from summaries do so, and the summaries are kept, so that
        :meth:`Prepared.extend` can add rows later without these.
        """
        prepared = Prepared([], self.keep_row_changes)
        for stage in self.stages:
            for step in stage.obj_list:
                name = f"{len(prepared.steps):02d}_{_step_name(step)}"
                if growing and mergeable(step):
                    prepared.summaries[name] = summary_for(step, df)
                    ready = fit_summary(step, prepared.summaries[name])
                else:
                    ready = step.fit(df) if isinstance(step, Estimator) else step
                if isinstance(step, Step):
                    prepared.makers[name] = step
                prepared.steps.append((name, ready))
                df = prepared.run(ready, df)
        return prepared, df

    def fit(self, df: DataFrame) -> "Prepared":
        return self.fit_transform(df)[0]


class Prepared:
    """Fitted steps. Row-changing steps run anew on every table; all others are projections.

    ``makers`` are the steps that the fitted ones came from, ``summaries`` what the growing ones have seen.
    """

    def __init__(self, steps: list[tuple[str, object]], keep_row_changes: bool = True,
                 makers: dict[str, Step] | None = None, summaries: dict[str, Summary] | None = None):
        self.steps = steps
        self.keep_row_changes = keep_row_changes
        self.makers = makers or {}
        self.summaries = summaries or {}

    def run(self, step, df: DataFrame) -> DataFrame:
        if isinstance(step, Transformer):
            return step.transform(df)
        changed = step.apply(df)
        return materialize(changed) if self.keep_row_changes else changed

    def transform(self, df: DataFrame) -> DataFrame:
        for _, step in self.steps:
            df = self.run(step, df)
        return df

    def extend(self, df: DataFrame) -> tuple["Prepared", DataFrame]:
        """The preparation that has seen these rows too, and the rows prepared by it; only they are read.

        Every growing step merges what it sees of them into its summary and is fitted again from that; all other
        steps stay as they are. A step behind others has seen earlier rows as those were prepared when they came.
        """
        grown = Prepared([], self.keep_row_changes, dict(self.makers))
        for name, step in self.steps:
            if name in self.summaries:
                maker = self.makers[name]
                grown.summaries[name] = self.summaries[name].merge(summary_for(maker, df))
                step = fit_summary(maker, grown.summaries[name])
            grown.steps.append((name, step))
            df = grown.run(step, df)
        return grown, df

    def refit(self, step: str, df: DataFrame) -> "Prepared":
        """The preparation with one step fitted anew on these rows, which the steps before it prepare; all others
        stay as they are."""
        wanted, again = self._full_name(step), Prepared([], self.keep_row_changes, dict(self.makers), dict(self.summaries))
        if wanted not in self.makers:
            raise ValueError(f"{wanted} learns nothing")
        reached = False
        for name, fitted in self.steps:
            if name == wanted:
                maker, reached = self.makers[name], True
                if name in self.summaries:
                    again.summaries[name] = summary_for(maker, df)
                    fitted = fit_summary(maker, again.summaries[name])
                else:
                    fitted = maker.fit(df)
            again.steps.append((name, fitted))
            if not reached:
                df = self.run(fitted, df)
        return again

    def _full_name(self, step: str) -> str:
        for full, _ in self.steps:
            if step in (full, full.split("_", 1)[1]):
                return full
        raise KeyError(f"no step {step!r}; there are {[n for n, _ in self.steps]}")

    def attribute(self, step: str, name: str):
        """One attribute of the fitted step with this name (with or without its number)."""
        return getattr(dict(self.steps)[self._full_name(step)], name)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write all steps below one folder: settings, learned numbers, and the tables they refer to.

        Settings may hold functions, so they are pickled; load only what you have saved yourself.
        """
        rows = []
        for place, (name, step) in enumerate(self.steps):
            own = isinstance(step, Fitted) and not isinstance(step, Unchanged)
            if own:
                save_state(spark, step, f"{path}/{place}")
            kept = (type(step), step.settings) if own else step
            maker = self.makers.get(name)
            if name in self.summaries:
                self.summaries[name].save(f"{path}/{place}/summary")
            made_by = None if maker is None else bytearray(cloudpickle.dumps((type(maker), maker.settings, maker.pass_through)))
            rows.append((place, name, own, bytearray(cloudpickle.dumps(kept)), made_by, name in self.summaries))
        schema = "place int, name string, fitted boolean, content binary, maker binary, growing boolean"
        table = spark.createDataFrame(rows, schema).coalesce(1)
        table.withColumn("keep_row_changes", F.lit(self.keep_row_changes)).write.mode("overwrite").parquet(f"{path}/steps")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Prepared":
        """The steps that :meth:`save` wrote; they need nothing but that folder."""
        steps, keep, makers, summaries = [], True, {}, {}
        for row in spark.read.parquet(f"{path}/steps").orderBy("place").collect():
            if row["maker"] is not None:
                kind, settings, pass_through = pickle.loads(bytes(row["maker"]))
                makers[row["name"]] = kind(settings, pass_through)
            if row["growing"]:
                summaries[row["name"]] = Summary.load(spark, f"{path}/{row['place']}/summary")
            kept, keep = pickle.loads(bytes(row["content"])), row["keep_row_changes"]
            if row["fitted"]:
                kept = load_state(spark, *kept, f"{path}/{row['place']}")
            steps.append((row["name"], kept))
        return cls(steps, keep, makers, summaries)

    def fitted_state(self, spark: SparkSession) -> DataFrame:
        return state_table(spark, {n: s for n, s in self.steps if isinstance(s, Fitted)})
