"""Time columns: what they hold, how to read them, and features derived from them."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import (
    FLOAT_TYPES, TEXT_TYPES, TIME_TYPES, col, epoch_micros, from_epoch_micros, number, present, quoted, type_of,
)
from millrace.operators.base import Fitted, Step
from millrace.plans.order import steps_in_order
from millrace.plans.quantiles import quantiles
from millrace.session import materialize

# Strptime directives and the same fields in Spark's date patterns.
DIRECTIVES = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%I": "hh", "%M": "mm",
    "%S": "ss", "%f": "SSSSSS", "%p": "a", "%b": "MMM", "%B": "MMMM", "%j": "DDD",
}

# Formats tried on a text column, the first of equally good ones wins.
TEXT_FORMATS = (
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%d %H:%M",
    "%Y-%m-%d",
    "%Y/%m/%d %H:%M:%S",
    "%Y/%m/%d",
    "%d.%m.%Y %H:%M:%S",
    "%d.%m.%Y",
    "%m/%d/%Y %H:%M:%S",
    "%m/%d/%Y",
    "%d/%m/%Y %H:%M:%S",
    "%d/%m/%Y",
    "%Y%m%d",
    "%Y-%m-%dT%H:%M:%S",
)

EXCEL_EPOCH_SECONDS = 2_209_161_600  # 1899-12-30 to 1970-01-01
DAY_SECONDS = 86_400.0
YEAR_SECONDS = 365.2425 * DAY_SECONDS
PERIODS = {"Day": DAY_SECONDS, "Month": YEAR_SECONDS / 12, "Year": YEAR_SECONDS}


def spark_pattern(fmt: str) -> str:
    """A strptime format as a Spark date pattern; patterns without ``%`` pass unchanged."""
    if "%" not in fmt:
        return fmt
    out, literal, i = "", "", 0
    while i < len(fmt):
        if fmt[i] == "%":
            if fmt[i : i + 2] not in DIRECTIVES:
                raise ValueError(f"unsupported directive {fmt[i:i + 2]!r} in {fmt!r}")
            out += f"'{literal}'" if literal.isalpha() else literal
            out, literal, i = out + DIRECTIVES[fmt[i : i + 2]], "", i + 2
        else:
            literal, i = literal + fmt[i], i + 1
    return out + (f"'{literal}'" if literal.isalpha() else literal)


def parse_text(name: str, fmt: str) -> Column:
    """Text as TIMESTAMP_NTZ; what does not fit the format is NULL."""
    pattern = spark_pattern(fmt).replace("\\", "\\\\").replace("'", "\\'")
    return F.expr(f"cast(try_to_timestamp({quoted(name)}, '{pattern}') as timestamp_ntz)")


def parse_time(df: DataFrame, name: str, kind: str, fmt: str | None = None) -> Column:
    """The column as TIMESTAMP_NTZ, by its kind (see :func:`detect_time_types`)."""
    if kind == "datetime64":
        return col(name).cast("timestamp_ntz")
    if kind == "string":
        if not fmt:
            raise ValueError("a text column needs a format")
        return parse_text(name, fmt)
    x = number(df, name)
    if kind == "unix_timestamp":
        seconds = F.when(F.abs(x) >= 1e11, x / 1000.0).otherwise(x)
    elif kind == "excel_date":
        seconds = x * DAY_SECONDS - EXCEL_EPOCH_SECONDS
    else:
        raise ValueError(f"{name} holds no time ({kind})")
    return from_epoch_micros(F.round(seconds * 1e6), T.TimestampNTZType())


def detect_time_types(
    df: DataFrame, columns: list[str], order_by: str | None = None, regularity: float = 0.5
) -> dict[str, str]:
    """``datetime64``, ``string``, ``unix_timestamp``, ``excel_date`` or ``unknown_numeric`` each.

    A numeric column is a time if all its values have 10 or 13 digits (unix), or lie in the range of
    Excel day numbers (five digits), and all its values rise at a regular pace along ``order_by``: no
    step falls, and the median absolute deviation of the steps is up to ``regularity`` times their median.
    Without ``order_by`` the values are taken in their own order, so that only the pace is judged. Fewer
    than five values stay undecided. One aggregate serves all columns; a column with the right digits is
    then ordered once, in buckets.
    """
    kinds, numeric = {}, []
    for name in columns:
        data_type = type_of(df, name)
        if isinstance(data_type, TIME_TYPES):
            kinds[name] = "datetime64"
        elif isinstance(data_type, TEXT_TYPES):
            kinds[name] = "string"
        else:
            kinds[name] = "unknown_numeric"
            if isinstance(data_type, T.NumericType):
                numeric.append(name)
    if not numeric:
        return kinds
    aggregates = []
    for i, c in enumerate(numeric):
        x = number(df, c)
        aggregates += [
            F.count(x).alias(f"n{i}"), F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}"),
            F.min(x == F.floor(x)).alias(f"w{i}"),
        ]
    row = df.agg(*aggregates).first()
    for i, c in enumerate(numeric):
        n, low, high = row[f"n{i}"], row[f"l{i}"], row[f"h{i}"]
        if n < 5:
            continue
        if row[f"w{i}"] and (1e9 <= low and high < 1e10 or 1e12 <= low and high < 1e13):
            kind = "unix_timestamp"
        elif 10_000 <= low and high < 100_000:
            kind = "excel_date"
        else:
            continue
        if _rises_regularly(df, c, order_by, regularity):
            kinds[c] = kind
    return kinds


def _rises_regularly(df: DataFrame, name: str, order_by: str | None, regularity: float) -> bool:
    if order_by and isinstance(type_of(df, order_by), FLOAT_TYPES):
        raise ValueError("order_by must be a time or a whole number")
    order = col(order_by) if order_by else number(df, name)
    rows = df.select(order.alias("place"), number(df, name).alias("x")).where("x is not null")
    steps = materialize(steps_in_order(rows, "place", "x"))
    falls = steps.agg(F.min("step").alias("least")).first()["least"]
    if falls is None or falls < 0:
        return False
    middle = quantiles(steps, {"m": (F.col("step"), [0.5])})["m"][0]
    away = F.abs(F.col("step") - F.lit(middle))
    return middle > 0 and quantiles(steps, {"m": (away, [0.5])})["m"][0] / middle <= regularity


def find_time_column(df: DataFrame, order_by: str | None = None) -> str | None:
    """The first typed time column; else the first numeric time; else the first text column that
    mostly parses."""
    typed = [c for c in df.columns if isinstance(type_of(df, c), TIME_TYPES)]
    if typed:
        return typed[0]
    kinds = detect_time_types(df, df.columns, order_by)
    numeric = [c for c in df.columns if kinds[c] in ("unix_timestamp", "excel_date")]
    if numeric:
        return numeric[0]
    texts = [c for c in df.columns if kinds[c] == "string"]
    scores = format_scores(df, texts)
    readable = [c for c in texts if max(s["share"] for s in scores[c].values()) > 0.5]
    return readable[0] if readable else None


def format_scores(df: DataFrame, columns: list[str], formats=TEXT_FORMATS) -> dict[str, dict]:
    """Parsed values per column and format, all from one aggregate."""
    if not columns:
        return {}
    aggregates = []
    for i, c in enumerate(columns):
        aggregates.append(F.count(col(c)).alias(f"n{i}"))
        aggregates += [F.count(parse_text(c, f)).alias(f"c{i}_{j}") for j, f in enumerate(formats)]
    row = df.agg(*aggregates).first()
    return {
        c: {
            f: {"parsed": row[f"c{i}_{j}"], "share": row[f"c{i}_{j}"] / row[f"n{i}"] if row[f"n{i}"] else 0.0}
            for j, f in enumerate(formats)
        }
        for i, c in enumerate(columns)
    }


def detect_time_format(df: DataFrame, column: str, formats=TEXT_FORMATS) -> tuple[str, float]:
    """The format that reads the most values (ties: the first listed) and the share it reads."""
    scores = format_scores(df, [column], formats)[column]
    best = max(formats, key=lambda f: (scores[f]["parsed"], -list(formats).index(f)))
    return best, scores[best]["share"]


def parse_success_rate(df: DataFrame, column: str, fmt: str) -> DataFrame:
    """Rows, non-null values, parsed values and their ratio."""
    n, parsed = F.count(col(column)), F.count(parse_text(column, fmt))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), n.alias("n_values"), parsed.alias("n_parsed"),
        F.try_divide(parsed, n).alias("success_rate"),
    )


@dataclass(frozen=True)
class TimeFeatureSettings:
    """Without ``time_column`` the table is searched; ``format=None`` on text means detect it."""

    time_column: str | None = None
    format: str | None = None
    order_by: str | None = None


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer")
        .when(month.isNotNull(), "autumn")
    )


class TimeFeatureModel(Fitted):
    """``state[time column]``: kind, format, and the earliest time in training."""

    def _transform(self, df: DataFrame) -> DataFrame:
        for name in present(df, self.state):
            s = self.state[name]
            parsed = df.withColumn(name, parse_time(df, name, s["kind"], s["format"]))
            micros = epoch_micros(parsed, name)
            since = (micros - F.lit(s["start"])) / F.lit(1e6)
            moment = F.hour(col(name))
            made = {
                "is_night": ((moment >= 20) | (moment <= 5)).cast("tinyint"),
                "season": season(F.month(col(name))),
                "timedelta": since,
                "days_since_start": since / DAY_SECONDS,
                "years_since_start": since / YEAR_SECONDS,
            }
            seconds = micros / F.lit(1e6)
            for label, period in PERIODS.items():
                angle = seconds * F.lit(2 * math.pi / period)
                made |= {f"{label}_sin": F.sin(angle), f"{label}_cos": F.cos(angle)}
            df = parsed.withColumns(made)
        return df


class TimeFeatures(Step):
    """Parse the time column and add night flag, season, elapsed time and cyclic features.

    Night is 20:00 to 05:59; seasons are Dec–Feb winter and so on; elapsed time counts from the
    earliest training row; a missing time gives missing features.
    """

    model = TimeFeatureModel

    def __init__(self, settings: TimeFeatureSettings | None = None, pass_through: bool = False):
        super().__init__(settings or TimeFeatureSettings(), pass_through)

    def learn(self, df: DataFrame) -> dict[str, dict]:
        s = self.settings
        name = s.time_column or find_time_column(df, s.order_by)
        if name is None or name not in df.columns:
            raise ValueError("no time column found")
        kind = detect_time_types(df, [name], s.order_by)[name]
        fmt = s.format
        if kind == "string" and not fmt:
            fmt, share = detect_time_format(df, name)
            if share == 0:
                raise ValueError(f"no known time format reads {name}")
        parsed = df.withColumn(name, parse_time(df, name, kind, fmt))
        start = parsed.agg(F.min(epoch_micros(parsed, name)).alias("start")).first()["start"]
        return {name: {"kind": kind, "format": fmt, "start": start}}


def wind_vector(df: DataFrame, dir_cols: list[str], var_cols: list[str]) -> DataFrame:
    """``<speed>_x`` and ``<speed>_y`` from a direction in degrees; inputs stay.

    One direction serves all speeds, several directions pair up with them; absent columns are skipped.
    """
    made = {}
    for i, speed in enumerate(var_cols):
        direction = dir_cols[i] if len(dir_cols) == len(var_cols) else dir_cols[0]
        if speed in df.columns and direction in df.columns:
            angle = F.radians(col(direction))
            made[f"{speed}_x"] = col(speed) * F.cos(angle)
            made[f"{speed}_y"] = col(speed) * F.sin(angle)
    return df.withColumns(made) if made else df
