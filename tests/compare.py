"""Run registered queries and their SQL oracles on the same tables and compare all rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "tinyint": "TINYINT", "double": "DOUBLE",
    "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ", timespec="microseconds")
    return value


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(df, sql: str, connection) -> list[str]:
    """What differs between a Spark result and the oracle's; empty when they agree."""
    result = connection.execute(sql)
    expected = {d[0]: str(d[1]) for d in result.description}
    expected_rows = _rows(result.fetchall(), list(expected))
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    problems = []
    if sorted(found) != sorted(expected):
        return [f"columns {sorted(found)} != {sorted(expected)}"]
    for name, spark_type in found.items():
        if TYPES.get(spark_type, spark_type) != expected[name]:
            problems.append(f"type of {name}: {spark_type} != {expected[name]}")
    rows = _rows([tuple(r) for r in df.collect()], list(found))
    if len(rows) != len(expected_rows):
        problems.append(f"{len(rows)} rows != {len(expected_rows)}")
    else:
        wrong = [(a, b) for a, b in zip(rows, expected_rows, strict=True) if a != b]
        if wrong:
            problems.append(f"{len(wrong)} of {len(rows)} rows differ, first {wrong[0]}")
    return problems


def main() -> None:
    import __spark_entry__ as entry
    from millrace.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    oracles, failed = entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = function(spark, sf_dir)
            if name in oracles:
                problems = differences(df, oracles[name], connection)
                note = "ok" if not problems else "DIFFERS " + "; ".join(problems)
            else:
                note = f"rows only: {df.count()}"
        except Exception as error:
            note = f"FAILED {type(error).__name__}: {str(error)[:700]}"
        failed += note.startswith(("DIFFERS", "FAILED"))
        print(f"{name:24s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
