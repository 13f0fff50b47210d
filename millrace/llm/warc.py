"""Not-modified revisits of web archives: each finds the response it stands for and the headers it updates.

A revisit (status 304) refers to the latest earlier full response (status 200) of the same canonical url; see
``latest_earlier`` for the as-of join. Its validators must agree with those of that response: the entity tags
(weakly compared) if both have one, else the modification dates if both have one. If they do, the response's
headers are kept and those that a 304 may update replace them; headers that describe the stored body stay.

Defined results: a revisit without an earlier full response is ``no_original``; one whose validators differ is
``mismatch``, one without common validators ``unverified``, all others ``resolved``. Only resolved revisits get
merged headers. Null headers are no headers. Captures without a time, or with a null or empty canonical url, are
``no_original``. Repeated revisits
are repeated; among full responses of one url and instant the one of the largest id counts (and among equal
ids the one of the largest header list).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.asof import latest_earlier
from millrace.llm.frames import col

#: Headers that a 304 response never changes, because they describe the stored body or one hop.
KEPT_HEADERS = (
    "content-length", "content-encoding", "content-type", "content-range", "content-md5", "transfer-encoding", "connection",
    "keep-alive", "proxy-authenticate", "proxy-connection", "te", "trailer", "upgrade",
)
#: Query parameters that name no other content.
TRACKING = ("ref", "fbclid", "gclid", "msclkid", "sessionid", "sid")


def canonical_url(url: Column) -> Column:
    """Host without www, default port and case; path without a last slash; sorted parameters without tracking
    ones; no scheme, user or fragment. Null stays null."""
    plain = F.regexp_replace(url, r"#.*$", "")
    form = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?@]*@)?([^/?]*)([^?]*)\??(.*)$"
    host = F.regexp_replace(F.lower(F.regexp_extract(plain, form, 1)), r"^www[0-9]*\.|\.?(:80|:443)?$", "")
    path = F.regexp_replace(F.regexp_extract(plain, form, 2), r"/+$", "")
    params = F.filter(F.split(F.regexp_extract(plain, form, 3), "&"), lambda p: (p != "") & ~is_tracking(p))
    query = F.array_join(F.array_sort(params), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def is_tracking(parameter: Column) -> Column:
    name = F.lower(F.substring_index(parameter, "=", 1))
    return name.isin(*TRACKING) | name.startswith("utm_")


def lower_names(headers: Column) -> Column:
    """A header map with names in lower case (the last of equal names) and without null values."""
    pairs = F.filter(F.map_entries(headers), lambda e: e["value"].isNotNull())
    lowered = F.transform(pairs, lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value")))
    last = F.filter(lowered, lambda e, i: ~F.exists(
        F.slice(lowered, i + 2, F.size(lowered)), lambda later: later["key"] == e["key"]))
    return F.coalesce(F.map_from_entries(last), F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>")))


def merged_headers(stored: Column, update: Column) -> Column:
    """The stored headers with those that the update may change; both have names in lower case."""
    may = F.map_filter(update, lambda k, _: ~k.isin(*KEPT_HEADERS))
    rest = F.map_filter(stored, lambda k, _: ~F.array_contains(F.map_keys(may), k))
    return F.map_concat(rest, may)


def agreement(stored: Column, revisit: Column) -> Column:
    """True or false as the validators agree, null if there are none to compare."""
    strong = lambda headers: F.regexp_replace(headers["etag"], r"^W/", "")
    tags, dates = strong(stored) == strong(revisit), stored["last-modified"] == revisit["last-modified"]
    return F.coalesce(tags, dates)


def resolve(captures: DataFrame, key: str = "page_id", url: str = "url", time: str = "fetched_at", status: str = "status",
            headers: str = "headers", full: int = 200, not_modified: int = 304) -> DataFrame:
    """One row for each revisit: key, ``canonical_url``, time, ``refers_to``, ``state`` and merged ``headers``."""
    named = captures.select(
        col(key).alias("id"), canonical_url(col(url)).alias("key"), col(time).alias("time"), col(status).alias("status"),
        lower_names(col(headers)).alias("headers"))
    # captures without a url stand for nothing: they are neither found nor find
    originals = named.where((F.col("status") == full) & F.col("id").isNotNull() & (F.col("key") != ""))
    revisits = named.where(F.col("status") == not_modified)
    # the headers travel with the event, so that no later join by record has a hot or a missing key
    record = F.struct("id", F.array_sort(F.map_entries("headers")).alias("headers"))
    found = latest_earlier(originals.select("key", "time", record.alias("value")), revisits)
    found = found.select(
        F.col("key").alias("of_key"), F.col("time").alias("of_time"), F.col("found.id").alias("refers_to"),
        F.map_from_entries("found.headers").alias("stored"))
    both = revisits.join(found, F.col("key").eqNullSafe(F.col("of_key")) & (F.col("time") == F.col("of_time")), "left")
    agree = agreement(F.col("stored"), F.col("headers"))
    state = (
        F.when(F.col("refers_to").isNull(), "no_original").when(agree.isNull(), "unverified")
        .when(agree, "resolved").otherwise("mismatch"))
    return both.select(
        F.col("id").alias(key), F.col("key").alias("canonical_url"), F.col("time").alias(time), "refers_to", state.alias("state"),
        F.when(state == "resolved", merged_headers(F.col("stored"), F.col("headers"))).alias("headers"))
