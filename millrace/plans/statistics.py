"""Statistics of many columns in one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AGGREGATES = {
    "n": F.count,
    "mean": F.avg,
    "std": F.stddev_pop,
    "std_sample": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "skew": F.skewness,
    "kurt": F.kurtosis,
    "not_flag": lambda value: F.count_if(~value.isin(0.0, 1.0)),
}


COLUMNS_PER_PASS = 16


def statistics(df: DataFrame, values: dict[str, Column], names) -> dict[str, dict]:
    """``{key: {statistic: value}}`` for every expression.

    One aggregate per ``COLUMNS_PER_PASS`` expressions: more would not fit one compiled loop, and
    each pass over a columnar table reads only its own columns. Partial aggregation leaves one row
    per task, so neither the row count nor skew matters.
    """
    keys, names, found = list(values), list(names), {}
    for start in range(0, len(keys), COLUMNS_PER_PASS):
        group = keys[start : start + COLUMNS_PER_PASS]
        aggregates = [
            AGGREGATES[name](values[key]).alias(f"s{i}_{name}")
            for i, key in enumerate(group)
            for name in names
        ]
        row = df.agg(F.count(F.lit(1)).alias("rows"), *aggregates).first()
        found |= {
            key: {"rows": row["rows"], **{name: row[f"s{i}_{name}"] for name in names}}
            for i, key in enumerate(group)
        }
    return found


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows with both values; NULL when either does not vary.

    Spark's own ``corr`` raises a division error for a constant column.
    """
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)
