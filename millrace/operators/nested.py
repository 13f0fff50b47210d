"""JSON text in columns: which paths it holds, of which types and how often, and typed columns from them.

Texts are parsed once into Spark's VARIANT. Paths are discovered level by level: a level's values are exploded from
those of the level before, and only counts per path and type come back, so neither wide nor many documents
matter. One pass over the table goes down ``LEVELS_A_PASS`` levels; a container stays beside its members until the
pass ends, and there are more passes only where documents go deeper.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, present
from millrace.operators.base import Fitted, Step

#: Levels that are followed at most; deeper values count as their container.
MOST_LEVELS = 64
#: Levels that one pass over the documents opens.
LEVELS_A_PASS = 4
ITEM = "[*]"


def parsed(value: Column) -> Column:
    """The text as VARIANT; NULL where it is no JSON."""
    return F.try_parse_json(value)


def _kind(v: Column) -> Column:
    """``object``, ``array``, ``null`` or the scalar's type."""
    name = F.schema_of_variant(v)
    return (
        F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array").when(name == "VOID", "null")
        .when(name.startswith("DECIMAL"), "decimal").otherwise(F.lower(name))
    )


def _step(path: Column, key: Column) -> Column:
    """The path of a member, names that are no plain words in quotes; of an item, for all items alike."""
    quoted = F.concat(F.lit("['"), F.regexp_replace(key, r"(['\\])", r"\\$1"), F.lit("']"))
    return F.when(key.isNull(), F.concat(path, F.lit(ITEM))).when(
        key.rlike("^[A-Za-z_][A-Za-z0-9_]*$"), F.concat(path, F.lit("."), key)).otherwise(F.concat(path, quoted))


def _opened(values: DataFrame) -> DataFrame:
    """``values`` has ``path, type, v``, and ``v`` only for containers to be opened. Each of them is kept as settled,
    unless its type has been counted (NULL), and followed by its members or items.

    Nothing is filtered by what is parsed: Spark would move such a filter below the parsing and parse for it again.
    """
    v, kind, opens, settled = F.col("v"), F.col("type"), F.array(F.lit(True)), F.array(F.lit(False))
    parts = F.when(v.isNull(), settled).when(kind.isNull(), opens).otherwise(F.concat(settled, opens))
    parted = values.select("path", "type", "v", F.explode(parts).alias("open")).select("path", "type", "open", F.when(F.col("open"), v).alias("v"))
    members = values.sparkSession.tvf.variant_explode_outer(F.col("v").outer())  # place, key (NULL for items) and value
    inner = parted.lateralJoin(members).where(~F.col("open") | F.col("pos").isNotNull())
    inner = inner.select("path", "type", "open", "key", "value", _kind(F.col("value")).alias("kind"))
    return inner.select(
        F.when(F.col("open"), _step(F.col("path"), F.col("key"))).otherwise(F.col("path")).alias("path"),
        F.when(F.col("open"), F.col("kind")).otherwise(kind).alias("type"),
        F.when(F.col("kind").isin("object", "array"), F.col("value")).alias("v"))


def json_profile(df: DataFrame, column: str) -> DataFrame:
    """``(path, type, n, share)`` of all values of the column's documents; ``share`` is that of the type at its path.

    The row of path ``$`` and type ``invalid`` counts texts that are no JSON; missing texts count nowhere.
    """
    documents = df.select(col(column).alias("text")).select("text", parsed(F.col("text")).alias("v"))
    documents = documents.select("v", F.when(F.col("text").isNotNull(), F.coalesce(_kind(F.col("v")), F.lit("invalid"))).alias("type"))
    values = documents.select(F.lit("$").alias("path"), "type", F.when(F.col("type").isin("object", "array"), F.col("v")).alias("v"))
    found, levels = [], 1
    while True:
        for _ in range(min(LEVELS_A_PASS, MOST_LEVELS - levels)):
            values, levels = _opened(values), levels + 1
        rows = values.groupBy("path", "type").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("left")).collect()
        found += [(r["path"], r["type"], r["n"]) for r in rows if r["type"] is not None]
        if levels == MOST_LEVELS or not any(r["left"] for r in rows):
            break
        values = values.where(F.col("v").isNotNull()).select("path", F.lit(None).cast("string").alias("type"), "v")
    totals: dict[str, int] = {}
    for path, _, n in found:
        totals[path] = totals.get(path, 0) + n
    return df.sparkSession.createDataFrame([(p, t, n, n / totals[p]) for p, t, n in found], "path string, type string, n long, share double")


def column_types(profile: DataFrame) -> dict[str, str]:
    """A type per path that all its values fit: whole numbers, numbers, truth values and times, else text.

    Containers and everything below items have no column of their own; a path that holds containers in some
    documents gets their JSON as text.
    """
    kinds: dict[str, set[str]] = {}
    for row in profile.collect():
        kinds.setdefault(row["path"], set()).add(row["type"])
    found = {}
    for path, held in kinds.items():
        held = held - {"null", "invalid"}
        if path == "$" or ITEM in path or not held or held <= {"object"}:
            continue
        if held <= {"bigint", "int", "smallint", "tinyint"}:
            found[path] = "bigint"
        elif held <= {"bigint", "int", "smallint", "tinyint", "double", "float", "decimal"}:
            found[path] = "double"
        elif held == {"boolean"}:
            found[path] = "boolean"
        else:
            found[path] = "string"
    return found


@dataclass(frozen=True)
class JsonSettings:
    """``columns`` hold JSON texts. A path's column is named ``<column>_<path>``, its parts joined by ``separator``."""

    columns: tuple[str, ...]
    separator: str = "_"
    drop: bool = False


def column_name(column: str, path: str, separator: str = "_") -> str:
    """``props`` and ``$.a['b c']`` make ``props_a_b c``."""
    plain = path[1:].replace("['", ".").replace("']", "").replace("\\'", "'").replace("\\\\", "\\")
    return column + plain.replace(".", separator)


def json_columns(df: DataFrame, column: str, types: dict[str, str], separator: str = "_") -> DataFrame:
    """The table with a typed column for each path; what is absent or of another type is NULL."""
    names = {path: column_name(column, path, separator) for path in types}
    taken = {c.lower() for c in df.columns}
    clashes = sorted(n for n in names.values() if n.lower() in taken)
    if clashes or len({n.lower() for n in names.values()}) < len(names):
        raise ValueError(f"names of JSON columns clash: {clashes or sorted(names.values())}; choose another separator")
    v = parsed(col(column))
    return df.withColumns({names[path]: F.try_variant_get(v, path, kind) for path, kind in types.items()})


class JsonModel(Fitted):
    """``state[column]``: the type of each path, learned in training."""

    def _transform(self, df: DataFrame) -> DataFrame:
        for name in present(df, self.state):
            df = json_columns(df, name, self.state[name]["types"], self.settings.separator)
            if self.settings.drop:
                df = df.drop(col(name))
        return df


class JsonColumns(Step):
    """Typed columns for all paths of JSON texts that the training table shows."""

    model = JsonModel

    def learn(self, df: DataFrame) -> dict[str, dict]:
        return {c: {"types": column_types(json_profile(df, c))} for c in present(df, self.settings.columns)}
