"""Row-by-row comparison of a registered query with its oracle SQL."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _family(type_name: str) -> str:
    name = str(type_name).lower()
    for family, names in {
        "int": ("int", "bigint", "integer", "hugeint", "long", "smallint", "tinyint"),
        "float": ("double", "float"),
        "text": ("string", "varchar"),
        "bool": ("boolean",),
    }.items():
        if name in names:
            return family
    return name


def _value(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def differences(df, relation) -> list[str]:
    """What differs in columns, types, row counts and values; empty when equal."""
    found = []
    spark_columns = sorted(df.columns)
    duck_columns = sorted(relation.columns)
    if spark_columns != duck_columns:
        return [f"columns {spark_columns} != {duck_columns}"]
    spark_types = {name: _family(kind) for name, kind in df.dtypes}
    duck_types = {n: _family(t) for n, t in zip(relation.columns, relation.types, strict=True)}
    if spark_types != duck_types:
        found.append(f"types {spark_types} != {duck_types}")
    ours = Counter(tuple(_value(row[c]) for c in spark_columns) for row in df.collect())
    order = [relation.columns.index(c) for c in duck_columns]
    theirs = Counter(tuple(_value(row[i]) for i in order) for row in relation.fetchall())
    if ours != theirs:
        found.append(
            f"rows {sum(ours.values())} != {sum(theirs.values())}; "
            f"only spark {list((ours - theirs).items())[:3]}; "
            f"only duckdb {list((theirs - ours).items())[:3]}"
        )
    return found
