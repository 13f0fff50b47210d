"""Naming, typing and cleaning helpers that return plain ``Column`` expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_TYPES = (T.StringType, T.VarcharType, T.CharType)
FLOAT_TYPES = (T.DoubleType, T.FloatType)
TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def quoted(name: str) -> str:
    """The name in backticks, so that dots, dashes and blanks in it are harmless."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, TEXT_TYPES)]


def time_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, TIME_TYPES)]


def kind_of(data_type: T.DataType) -> str:
    """``numeric``, ``time`` or ``categorical``: every column falls into one of them."""
    if isinstance(data_type, T.NumericType):
        return "numeric"
    return "time" if isinstance(data_type, TIME_TYPES) else "categorical"


def present(df: DataFrame, names) -> list[str]:
    """The given names that exist in the table, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def without_nan(df: DataFrame, name: str) -> Column:
    """The column with NaN read as missing."""
    if isinstance(type_of(df, name), FLOAT_TYPES):
        return F.nanvl(col(name), F.lit(None).cast(type_of(df, name)))
    return col(name)


def number(df: DataFrame, name: str) -> Column:
    """The column as DOUBLE with NaN read as missing: the form every statistic is taken over."""
    return without_nan(df, name).cast("double")


def finite(df: DataFrame, name: str) -> Column:
    """Like :func:`number`, with infinities read as missing too."""
    value = number(df, name)
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970-01-01 as BIGINT; NTZ values are taken as they read, in any session."""
    data_type, value = type_of(df, name), col(name)
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(data_type, T.DateType):
        return F.unix_date(value).cast("long") * F.lit(86_400_000_000)
    if isinstance(data_type, T.TimestampNTZType):
        if df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC"):
            return F.unix_micros(value.cast("timestamp"))
        days = F.unix_date(value.cast("date")).cast("long")
        minutes = F.hour(value) * 60 + F.minute(value)
        seconds = F.extract(F.lit("SECOND"), value)  # DECIMAL(8, 6), fraction included
        return (days * 1440 + minutes) * 60_000_000 + (seconds * 1_000_000).cast("long")
    return value.cast("long")


def from_epoch_micros(micros: Column, data_type: T.DataType) -> Column:
    """The inverse of :func:`epoch_micros` for a time column of the given type."""
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(micros.cast("long"))
    day = 86_400_000_000
    whole = micros.cast("long")
    days = F.floor(whole / F.lit(day)).cast("int")
    rest = (whole - days.cast("long") * day).cast("decimal(18,0)") / F.lit(1_000_000)
    interval = F.make_dt_interval(days=days, secs=rest.cast("decimal(18,6)"))
    return (F.lit("1970-01-01").cast("timestamp_ntz") + interval).cast(data_type)


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn NaN into NULL in the float columns, so that every later aggregate skips it."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, FLOAT_TYPES)]
    chosen = floats if columns is None else [c for c in columns if c in floats]
    return df.withColumns({c: without_nan(df, c) for c in chosen}) if chosen else df
