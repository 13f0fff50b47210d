"""Text columns whose times are written in several ways: a form per value, day and month settled by the column.

A value's shape (digit runs, words, separators) tells which family of formats it belongs to. Where a family leaves
open which field is day, month or two-digit year, all values of the column that have its separator are
counted under each reading; the reading that fits most of them wins, then the one that fits most of the whole
column, then the family's own order. A value that the winner can't read is read by the next one, so no value
that some reading fits is lost. Everything is built from expressions: one aggregate to learn, a projection to apply.

Years of two digits lie between 1969 and 2068. A written offset from UTC is taken off, times without one are read as
they stand. Ten digits alone are seconds since 1970, thirteen milliseconds, sixteen microseconds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, present
from millrace.operators.base import Fitted, Step

# The first three letters of English month names, in order.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

CLOCK = r"(?:(?:[Tt]|,? +)\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?(?: ?[AaPp]\.?[Mm]\.?)?(?: ?(?:[Zz]|UTC|[+-]\d{2}:?\d{2}))?)?"
#: Families: pattern of the whole value, and the readings of its three date fields, likeliest first.
FAMILIES = {
    "year_first": (r"^\d{4}([-/. ])\d{1,2}\1\d{1,2}" + CLOCK + "$", ("ymd",)),
    "year_last": (r"^\d{1,2}([-/. ])\d{1,2}\1\d{4}" + CLOCK + "$", ("mdy", "dmy")),
    "short_year": (r"^\d{1,2}([-/. ])\d{1,2}\1\d{2}" + CLOCK + "$", ("mdy", "dmy", "ymd")),
    "day_name_year": (r"^\d{1,2}([-/. ])[A-Za-z]{3,9}[-/., ]{1,2}\d{4}" + CLOCK + "$", ("dby",)),
    "name_day_year": (r"^()[A-Za-z]{3,9}\.? \d{1,2},? \d{4}" + CLOCK + "$", ("bdy",)),
    "compact": (r"^()\d{8}(?:[Tt ]?\d{4}(?:\d{2})?)?$", ("compact",)),
    "epoch": (r"^()-?(?:\d{10}|\d{13}|\d{16})(?:\.\d+)?$", ("epoch",)),
}
READINGS = ("mdy", "dmy", "ymd")


def shape(value: Column) -> Column:
    """The value with every digit as 9 and every run of letters as A: ``99/99/9999 99:99 A``."""
    return F.regexp_replace(F.regexp_replace(F.trim(value), r"\p{L}+", "A"), r"\d", "9")


def family(value: Column) -> Column:
    """The name of the family a value belongs to, or NULL."""
    found, text = F.lit(None).cast("string"), F.trim(value)
    for name, (pattern, _) in reversed(FAMILIES.items()):
        found = F.when(text.rlike(pattern), name).otherwise(found)
    return found


def separator(value: Column) -> Column:
    """What stands between the first two date fields."""
    return F.regexp_extract(F.trim(value), r"^\d{1,4}([-/. ])", 1)


def _field(value: Column, place: int) -> Column:
    """The number in this place, digit runs counted from 0."""
    return F.try_element_at(F.regexp_extract_all(F.trim(value), F.lit(r"(\d+)"), 1), F.lit(place + 1)).try_cast("int")


def _whole_year(year: Column) -> Column:
    return F.when(year >= 100, year).when(year < 69, year + 2000).otherwise(year + 1900)


def _date(value: Column, reading: str) -> tuple[Column, Column, Column]:
    """Year, month and day by one reading."""
    if "b" in reading:
        name = F.substring(F.lower(F.regexp_extract(F.trim(value), r"([A-Za-z]{3})", 1)), 1, 3)
        places = F.array(*map(F.lit, MONTHS))
        month = F.array_position(places, name).cast("int")
        return _field(value, 1), F.when(month > 0, month), _field(value, 0)
    if reading == "compact":
        digits = F.trim(value)
        return tuple(F.substring(digits, a, n).try_cast("int") for a, n in ((1, 4), (5, 2), (7, 2)))
    at = {part: reading.index(part) for part in "ymd"}
    return _whole_year(_field(value, at["y"])), _field(value, at["m"]), _field(value, at["d"])


def _clock(value: Column, compact: bool) -> tuple[Column, Column, Column]:
    text = F.trim(value)
    if compact:
        rest = F.regexp_replace(F.substring(text, 9, 12), "[^0-9]", "")
        part = [F.coalesce(F.substring(rest, a, 2).try_cast("int"), F.lit(0)) for a in (1, 3, 5)]
        return part[0], part[1], part[2].cast("decimal(8,6)")
    hour = F.regexp_extract(text, r"(\d{1,2}):\d{2}", 1).try_cast("int")
    minute = F.regexp_extract(text, r"\d{1,2}:(\d{2})", 1).try_cast("int")
    second = F.translate(F.regexp_extract(text, r"\d{1,2}:\d{2}:(\d{2}(?:[.,]\d{1,6})?)", 1), ",", ".").try_cast("decimal(8,6)")
    half = F.lower(F.regexp_extract(text, r"\d ?([AaPp])\.?[Mm]\.?(?: |$|[Zz+-]|UTC)", 1))
    hour = F.when(half == "", hour).when(~hour.between(1, 12), None).otherwise(hour % 12 + F.when(half == "p", 12).otherwise(0))
    return F.coalesce(hour, F.when(half == "", F.lit(0))), F.coalesce(minute, F.lit(0)), F.coalesce(second, F.lit(0).cast("decimal(8,6)"))


def read_as(value: Column, reading: str) -> Column:
    """The value as TIMESTAMP_NTZ by one reading; NULL where that gives no moment."""
    text = F.trim(value)
    if reading == "epoch":
        number = text.try_cast("decimal(38,9)")
        digits = F.length(F.regexp_extract(text, r"(\d+)", 1))
        micros = F.when(digits == 10, number * 1_000_000).when(digits == 13, number * 1_000).otherwise(number)
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_micros(micros.cast("long")).cast("timestamp_ntz"))
    moment = F.try_make_timestamp_ntz(*_date(value, reading), *_clock(value, reading == "compact"))
    offset = r"([+-])(\d{2}):?(\d{2})$"
    ahead = F.regexp_extract(text, r":\d{2}.*?" + offset, 2).try_cast("int") * 60 + F.regexp_extract(text, r":\d{2}.*?" + offset, 3).try_cast("int")
    ahead = F.when(F.regexp_extract(text, r":\d{2}.*?" + offset, 1) == "-", -ahead).otherwise(ahead)
    return moment - F.make_dt_interval(mins=F.coalesce(ahead, F.lit(0)))


def read_mixed(value: Column, orders: dict[str, list[str]]) -> Column:
    """The value as TIMESTAMP_NTZ: by its family, and by the readings learned for family and separator in order."""
    found, kind = F.lit(None).cast("timestamp_ntz"), family(value)
    for name, (_, own) in FAMILIES.items():
        if len(own) == 1:
            found = F.when(kind == name, read_as(value, own[0])).otherwise(found)
            continue
        by_default = F.coalesce(*(read_as(value, r) for r in orders.get(name, own)))
        read = by_default
        for key, learned in orders.items():
            if key.startswith(f"{name} "):
                read = F.when(separator(value) == key[len(name) + 1 :].replace("_", " "), F.coalesce(*(read_as(value, r) for r in learned))).otherwise(read)
        found = F.when(kind == name, read).otherwise(found)
    return found


def learn_orders(df: DataFrame, column: str) -> dict[str, list[str]]:
    """The readings of the open families, best first, for each separator met; one aggregate over all values."""
    value = col(column)
    fits = {r: F.count_if(read_as(value, r).isNotNull()).alias(r) for r in READINGS}
    open_families = [name for name, (_, own) in FAMILIES.items() if len(own) > 1]
    rows = (
        df.select(family(value).alias("family"), separator(value).alias("separator"), value.alias(column))
        .where(F.col("family").isin(*open_families)).groupBy("family", "separator").agg(*fits.values()).collect()
    )
    whole = {r: sum(row[r] for row in rows) for r in READINGS}
    orders = {}
    for name in open_families:
        own = FAMILIES[name][1]
        orders[name] = sorted(own, key=lambda r: (-whole[r], own.index(r)))
        for row in rows:
            if row["family"] == name:
                key = f"{name} {row['separator'].replace(' ', '_')}"
                orders[key] = sorted(own, key=lambda r, row=row: (-row[r], -whole[r], own.index(r)))
    return orders


def parse_time_mixed(df: DataFrame, column: str) -> DataFrame:
    """The table with the text column as TIMESTAMP_NTZ; what no reading fits is NULL."""
    return df.withColumn(column, read_mixed(col(column), learn_orders(df, column)))


def time_shapes(df: DataFrame, column: str) -> DataFrame:
    """``(shape, family, n, n_parsed, example)`` of all shapes of the column."""
    value = col(column)
    read = read_mixed(value, learn_orders(df, column))
    rows = df.where(value.isNotNull()).select(shape(value).alias("shape"), family(value).alias("family"), read.alias("read"), value.alias("value"))
    return rows.groupBy("shape", "family").agg(
        F.count(F.lit(1)).alias("n"), F.count("read").alias("n_parsed"), F.min("value").alias("example"))


@dataclass(frozen=True)
class MixedTimeSettings:
    columns: tuple[str, ...]


class MixedTimeModel(Fitted):
    """``state[column]``: the readings learned in training."""

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        return {c: read_mixed(col(c), self.state[c]["orders"]) for c in present(df, self.state)}


class ParseMixedTimes(Step):
    """Read text columns as times; how day and month stand is learned from the training table."""

    model = MixedTimeModel

    def learn(self, df: DataFrame) -> dict[str, dict]:
        return {c: {"orders": learn_orders(df, c)} for c in present(df, self.settings.columns)}
