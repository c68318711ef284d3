"""Order-insensitive comparison of a Spark result with DuckDB's answer."""

import math
from pathlib import Path

import duckdb


def duckdb_over(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def _duck_types(relation):
    names = {
        "VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double",
        "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
    }
    return {c.lower(): names.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types, strict=True)}


def assert_same(spark_df, relation):
    spark_types = {f.name.lower(): f.dataType.simpleString() for f in spark_df.schema.fields}
    assert spark_types == _duck_types(relation)
    got_names, got = rows_by_name(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want_names, want = rows_by_name(relation.columns, relation.fetchall())
    assert [n.lower() for n in got_names] == [n.lower() for n in want_names]
    assert len(got) == len(want)
    different = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
    assert not different, different[:3]
