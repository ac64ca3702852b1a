"""Order-insensitive comparison of a Spark result with DuckDB's answer."""

from __future__ import annotations

import math
import time
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def differences(df, db: duckdb.DuckDBPyConnection, text: str) -> list[str]:
    """What differs in column names, types or values; empty when equal."""
    result = db.execute(text)
    theirs = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    ours = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    found = []
    if ours != theirs:
        found.append(f"schema: spark {set(ours.items()) - set(theirs.items())} sql {set(theirs.items()) - set(ours.items())}")
    names, order = sorted(ours), sorted(theirs)
    if names != order:
        return found
    spark_rows = Counter(tuple(_plain(row[n]) for n in names) for row in df.collect())
    where = {name: i for i, name in enumerate(theirs)}
    sql_rows = Counter(tuple(_plain(row[where[n]]) for n in names) for row in expected)
    if spark_rows != sql_rows:
        more, less = spark_rows - sql_rows, sql_rows - spark_rows
        found.append(f"rows: spark {sum(spark_rows.values())} sql {sum(sql_rows.values())}; "
                     f"only spark {sum(more.values())} e.g. {dict(zip(names, next(iter(more), ())))}; "
                     f"only sql {sum(less.values())} e.g. {dict(zip(names, next(iter(less), ())))}")
    return found


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def check_all(spark, folder: str, names: list[str] | None = None) -> int:
    """Print one line per registered query; returns the number of failures."""
    import __spark_entry__ as entry

    db, texts, failures = connect(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            if name in texts:
                found = differences(query(spark, folder), db, texts[name])
                state = "ok" if not found else "DIFFERS " + " | ".join(found)
            else:
                state = f"rows {query(spark, folder).count()}"
        except Exception as error:  # report and go on with the next query
            state = "FAILS " + str(error)[:1500]
        failures += state.startswith(("DIFFERS", "FAILS"))
        print(f"{name:34s} {time.time() - began:6.1f}s {state}", flush=True)
    return failures
