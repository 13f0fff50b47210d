"""URL filters over time: dated list entries become validity intervals, captures meet those of their time.

An entry says that a pattern was added to or removed from a category at some time. Between an addition and
the next event of the same pattern and category the pattern is active. A pattern is a host (which covers its
subdomains) or a host with a path (which covers the paths below it). A capture asks for every pattern that
covers its url: its host, the parents of the host, and each of these with each leading part of the path; the
join is by pattern and by slice of time, so that neither a long history nor a hot host meets in one key, and
the interval is checked in the join.

Intervals are cut to the slices between the first and the last capture; these rows are broadcast while there are at
most ``BROADCAST_ROWS`` of them, and shuffled beyond.

Defined results: captures that are equal in key, url and time are one row with their number in ``captures``.
A capture without a time or url meets no entry and is allowed. Entries without pattern, category or time are
left out; at one instant a removal counts after an addition; a repeated addition changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.frames import BROADCAST_ROWS, col

#: Days of one slice of time.
SLICE_DAYS = 30


def host_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case without user, port and last dot, and path without query; both empty if there are none."""
    text = F.coalesce(url, F.lit(""))
    form = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"
    return F.regexp_replace(F.lower(F.regexp_extract(text, form, 1)), r"\.$", ""), F.regexp_extract(text, form, 2)


def covering_patterns(url: Column, deepest: int | None = None) -> Column:
    """All patterns that cover a url, or those with paths of up to ``deepest`` parts."""
    host, path = host_path(url)
    labels = F.split(host, r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    if deepest is not None:
        parts = F.slice(parts, 1, deepest) if deepest else F.array().cast("array<string>")
    paths = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.transform(
        F.slice(parts, F.lit(1), i), lambda p: F.concat(F.lit("/"), p)), ""))
    every = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))
    return F.when(host != "", F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """``pattern``, ``category``, ``valid_from`` and ``valid_to`` (null: still active) of dated entries with
    ``pattern``, ``category``, ``action`` ('add' or 'remove') and ``at``."""
    dated = entries.where("pattern is not null and category is not null and at is not null and action in ('add', 'remove')")
    once = dated.groupBy("pattern", "category", "at").agg(F.max("action").alias("action"))
    history = Window.partitionBy("pattern", "category").orderBy("at")
    changes = once.withColumn("before", F.lag("action").over(history)).where(
        (F.col("action") != F.coalesce("before", F.lit("remove"))))
    return (
        changes.withColumn("valid_to", F.lead("at").over(history)).where("action = 'add'")
        .select("pattern", "category", F.col("at").alias("valid_from"), "valid_to")
    )


def slices(active: DataFrame, slice_of: Callable[[Column], Column], low: int, high: int) -> DataFrame:
    """One row for each interval and slice of time from ``low`` to ``high`` that it reaches into."""
    first = F.greatest(slice_of(F.col("valid_from")), F.lit(low))
    end = F.least(F.coalesce(slice_of(F.col("valid_to")), F.lit(high)), F.lit(high))
    return active.where(first <= end).withColumn("slice", F.explode(F.sequence(first, end)))


def evaluate(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", time: str = "fetched_at",
             slice_days: int = SLICE_DAYS) -> DataFrame:
    """Per capture: key, url, time, ``captures``, ``allowed``, and the active ``categories`` and ``patterns``."""
    seconds = slice_days * 86_400
    slice_of = lambda t: F.floor(F.unix_seconds(t) / F.lit(seconds))
    once = captures.groupBy(col(key).alias("key"), col(url).alias("url"), col(time).alias("time")).agg(F.count("*").alias("captures"))
    span = once.agg(F.min(F.unix_seconds("time")).alias("first"), F.max(F.unix_seconds("time")).alias("last")).first()
    active = intervals(entries)
    # no listed path has more parts than this, so longer ones of a url are not asked for
    deepest = active.agg(F.max(F.size(F.filter(F.split("pattern", "/"), lambda p: p != "")) - 1)).first()[0] or 0
    sliced = slices(active, slice_of, (span["first"] or 0) // seconds, (span["last"] or 0) // seconds)
    few = sliced.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    asked = once.select("key", "url", "time", "captures", F.explode_outer(covering_patterns(F.col("url"), max(0, deepest))).alias("asked")).withColumn(
        "asked_slice", slice_of(F.col("time")))
    meets = (
        (F.col("asked") == F.col("pattern")) & (F.col("asked_slice") == F.col("slice")) & (F.col("valid_from") <= F.col("time"))
        & (F.col("valid_to").isNull() | (F.col("time") < F.col("valid_to")))
    )
    found = asked.join(F.broadcast(sliced) if few else sliced, meets, "left")
    judged = found.groupBy("key", "url", "time", "captures").agg(
        F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"),
        F.array_join(F.array_sort(F.collect_set("pattern")), ",").alias("patterns"))
    return judged.select(
        F.col("key").alias(key), F.col("url").alias(url), F.col("time").alias(time), "captures",
        (F.col("categories") == "").alias("allowed"), "categories", "patterns")
