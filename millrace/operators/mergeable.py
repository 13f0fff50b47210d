"""Statistics that can be merged: a fit over old and new rows that reads only the new ones.

A :class:`Summary` holds, per numeric column, counts, means and centred moments up to the fourth, the
extremes and a KLL sketch of quantiles, and the exact counts of the values of text columns. Summaries of
two tables merge into the summary of their union. Counts, extremes and categories merge exactly, moments up
to the rounding of doubles; a quantile's rank is within :func:`rank_error` of the wanted one (99 of
100 times), merged or not. Steps that learn from such statistics alone learn from a summary as they do from rows.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, finite, number, numeric_columns, present, text_columns
from millrace.operators.base import Step
from millrace.plans.counts import value_counts
from millrace.plans.statistics import COLUMNS_PER_PASS
from millrace.session import materialize

#: Size of a quantile sketch; about eleven bytes each.
SKETCH_SIZE = 2048
MOMENTS = ("n", "mean", "m2", "m3", "m4")


def rank_error(size: int = SKETCH_SIZE) -> float:
    """The share of rows by which a sketch's quantile may miss its rank, by the published bound of KLL sketches."""
    return 2.446 / size**0.9433


def merged_moments(a: dict, b: dict) -> dict:
    """Count, mean and sums of centred powers of the union of two groups of numbers."""
    n = a["n"] + b["n"]
    if not a["n"] or not b["n"]:
        return {k: (a if a["n"] else b)[k] for k in MOMENTS}
    d, p, q = b["mean"] - a["mean"], a["n"] / n, b["n"] / n
    m2 = a["m2"] + b["m2"] + d * d * p * b["n"]
    m3 = a["m3"] + b["m3"] + d**3 * p * b["n"] * (p - q) + 3 * d * (p * b["m2"] - q * a["m2"])
    m4 = (a["m4"] + b["m4"] + d**4 * p * b["n"] * (p * p - p * q + q * q)
          + 6 * d * d * (p * p * b["m2"] + q * q * a["m2"]) + 4 * d * (p * b["m3"] - q * a["m3"]))
    return {"n": n, "mean": a["mean"] + d * q, "m2": m2, "m3": m3, "m4": m4}


@dataclass(frozen=True)
class Summary:
    """``numbers`` maps a column to its counts, moments, extremes and sketch; ``values`` counts the texts (and other
    listed values) as rows ``column, value, n``. ``schema`` is that of the summarized table."""

    schema: T.StructType
    rows: int
    numbers: dict[str, dict]
    values: DataFrame

    @property
    def empty(self) -> DataFrame:
        """A table of the summarized columns without rows: it tells steps names and types."""
        return self.values.sparkSession.createDataFrame([], self.schema)

    def merge(self, other: "Summary") -> "Summary":
        """The summary of both tables' rows."""
        if sorted(self.schema.fieldNames()) != sorted(other.schema.fieldNames()) or set(self.numbers) != set(other.numbers):
            raise ValueError("summaries of different columns")
        spark, found = self.values.sparkSession, {}
        for c, a in self.numbers.items():
            b = other.numbers[c]
            ends = {"min": [v for v in (a["min"], b["min"]) if v is not None], "max": [v for v in (a["max"], b["max"]) if v is not None]}
            found[c] = merged_moments(a, b) | {k: a[k] + b[k] for k in ("present", "plus", "minus", "not_flag")}
            found[c] |= {"min": min(ends["min"], default=None), "max": max(ends["max"], default=None), "sketch": a["sketch"] or b["sketch"]}
        both = [(c, a["sketch"], other.numbers[c]["sketch"]) for c, a in self.numbers.items() if a["sketch"] and other.numbers[c]["sketch"]]
        if both:
            merged = spark.createDataFrame(both, "c string, a binary, b binary").select("c", F.kll_sketch_merge_double("a", "b").alias("s"))
            for row in merged.collect():  # one row per column
                found[row["c"]]["sketch"] = bytes(row["s"])
        values = self.values.unionByName(other.values).groupBy("column", "value").agg(F.sum("n").alias("n"))
        return Summary(self.schema, self.rows + other.rows, found, materialize(values))

    def statistics(self, values: dict[str, Column], names, finite_only: bool = True) -> dict[str, dict]:
        """As :func:`millrace.plans.statistics.statistics` gives them for columns of these names."""
        found = {}
        for c in values:
            s = self.numbers[c]
            n, known = s["n"], {"rows": self.rows, "n": s["n"], "mean": None, "std": None, "std_sample": None, "skew": None, "kurt": None,
                                "min": s["min"], "max": s["max"], "not_flag": s["not_flag"]}
            if n:
                known |= {"mean": s["mean"], "std": math.sqrt(s["m2"] / n), "std_sample": math.sqrt(s["m2"] / (n - 1)) if n > 1 else None}
                if s["m2"] > 0:
                    known |= {"skew": math.sqrt(n) * s["m3"] / s["m2"] ** 1.5, "kurt": n * s["m4"] / s["m2"] ** 2 - 3}
            if not finite_only:
                known["n"] = s["present"]
                if s["plus"] or s["minus"]:
                    mean = math.nan if s["plus"] and s["minus"] else math.inf if s["plus"] else -math.inf
                    known |= {"mean": mean, "std": math.nan, "skew": math.nan, "kurt": math.nan,
                              "min": -math.inf if s["minus"] else s["min"], "max": math.inf if s["plus"] else s["max"]}
                    if known["min"] is None or known["max"] is None:
                        known |= {"min": known["max"] if known["min"] is None else known["min"]}
                        known |= {"max": known["min"] if known["max"] is None else known["max"]}
            found[c] = {k: known[k] for k in ("rows", *names)}
        return found

    def quantiles(self, wanted: dict, bounds: dict | None = None) -> dict[str, list]:
        """Values whose ranks are within :func:`rank_error` of the wanted shares; infinities take no rank."""
        found = {c: [None] * len(shares) for c, (_, shares) in wanted.items()}
        asked = [(c, self.numbers[c]["sketch"]) for c, (_, shares) in wanted.items() if self.numbers[c]["n"] and shares]
        if asked:
            every = sorted({float(s) for c, _ in asked for s in wanted[c][1]})
            at = F.array(*(F.kll_sketch_get_quantile_double(F.col("s"), F.lit(q)) for q in every)).alias("v")
            for row in self.values.sparkSession.createDataFrame(asked, "c string, s binary").select("c", at).collect():
                found[row["c"]] = [row["v"][every.index(float(s))] for s in wanted[row["c"]][1]]
        return found

    def counts(self, columns: list[str]) -> DataFrame:
        """``column, value, n`` of counted columns."""
        return self.values.where(F.col("column").isin(*columns)) if columns else self.values.limit(0)

    def modes(self, columns: list[str], as_type: str = "string") -> dict:
        """The most frequent value of each counted column; the smallest among equals."""
        if not columns:
            return {}
        typed = F.col("value").cast(as_type)
        best = self.counts(columns).groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("order"), typed.alias("value"))).alias("best"))
        found = {r["column"]: r["best"]["value"] for r in best.collect()}
        return {c: found.get(c) for c in columns}

    def save(self, path: str) -> None:
        """Write the summary below one folder."""
        spark = self.values.sparkSession
        rows = [(c, json.dumps({k: v for k, v in s.items() if k != "sketch"}), s["sketch"]) for c, s in self.numbers.items()]
        head = ("", json.dumps({"rows": self.rows, "schema": self.schema.json()}), None)
        spark.createDataFrame([head, *rows], "c string, numbers string, sketch binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/numbers")
        self.values.write.mode("overwrite").parquet(f"{path}/values")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Summary":
        numbers, head = {}, {}
        for row in spark.read.parquet(f"{path}/numbers").collect():
            content = json.loads(row["numbers"])
            if row["c"]:
                numbers[row["c"]] = content | {"sketch": bytes(row["sketch"]) if row["sketch"] is not None else None}
            else:
                head = content
        schema = T.StructType.fromJson(json.loads(head["schema"]))
        return cls(schema, head["rows"], numbers, spark.read.parquet(f"{path}/values"))


def summarize(df: DataFrame, numbers: list[str] | None = None, counted: list[str] | None = None, sketch_size: int = SKETCH_SIZE) -> Summary:
    """The summary of a table: all numeric columns and the counts of all text columns, or those listed.

    Numeric columns may be listed in ``counted`` too, for a fill by the most frequent value. One aggregate serves
    sixteen columns, a second pass counts the values.
    """
    numbers = numeric_columns(df) if numbers is None else present(df, numbers)
    texts = text_columns(df) if counted is None else present(df, counted)
    found, rows = {}, 0
    for start in range(0, len(numbers), COLUMNS_PER_PASS):
        group, aggregates = numbers[start : start + COLUMNS_PER_PASS], []
        for i, c in enumerate(group):
            x, any_x = finite(df, c), number(df, c)
            made = {
                "present": F.count(any_x), "plus": F.count_if(any_x == math.inf), "minus": F.count_if(any_x == -math.inf), "n": F.count(x),
                "mean": F.avg(x), "var": F.var_pop(x), "skew": F.skewness(x), "kurt": F.kurtosis(x), "min": F.min(x), "max": F.max(x),
                "not_flag": F.count_if(~x.isin(0.0, 1.0)), "sketch": F.kll_sketch_agg_double(x, F.lit(sketch_size)),
            }
            aggregates += [value.alias(f"{name}{i}") for name, value in made.items()]
        row = df.agg(F.count(F.lit(1)).alias("rows"), *aggregates).first()
        rows = row["rows"]
        for i, c in enumerate(group):
            n, var = row[f"n{i}"], row[f"var{i}"] or 0.0
            own = {k: row[f"{k}{i}"] for k in ("present", "plus", "minus", "n", "min", "max", "not_flag")}
            own |= {"mean": row[f"mean{i}"] or 0.0, "m2": n * var, "m3": 0.0, "m4": 0.0}
            if n and var > 0:
                own |= {"m3": (row[f"skew{i}"] or 0.0) * n * var**1.5, "m4": ((row[f"kurt{i}"] or 0.0) + 3) * n * var**2}
            found[c] = own | {"sketch": bytes(row[f"sketch{i}"]) if n else None}
    if not numbers:
        rows = df.count()
    spark = df.sparkSession
    values = materialize(value_counts(df, texts)) if texts else spark.createDataFrame([], "column string, value string, n long")
    for c in texts:
        found.setdefault(c, None)
    totals = {r["column"]: r["n"] for r in values.groupBy("column").agg(F.sum("n").alias("n")).collect()}
    blank = {"plus": 0, "minus": 0, "mean": 0.0, "m2": 0.0, "m3": 0.0, "m4": 0.0, "min": None, "max": None, "not_flag": 0, "sketch": None}
    for c, s in found.items():
        if s is None:
            found[c] = blank | {"n": totals.get(c, 0), "present": totals.get(c, 0)}
    return Summary(df.select(*(col(c) for c in dict.fromkeys([*numbers, *texts]))).schema, rows, found, values)


def summary_for(step: Step, df: DataFrame, sketch_size: int = SKETCH_SIZE) -> Summary:
    """What the step has to know of the table to be fitted again together with later rows."""
    numbers, counted = step.summary_columns(df)
    return summarize(df, numbers, counted, sketch_size)


def fit_summary(step: Step, summary: Summary):
    """The fitted step that the summarized rows give; nothing is read but the summary."""
    if step.pass_through:
        return step.fit(summary.empty)
    return step.model(step.settings, step.learn(summary.empty, summary))


def mergeable(step) -> bool:
    """Whether the step can be fitted from a summary."""
    return hasattr(step, "summary_columns") and step.learns_from_summaries()

