"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return db


def cell(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(names, records):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in at) for r in records)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(db, sql):
    rel = db.sql(sql)
    return rows_of(rel.columns, rel.fetchall())


def schema_of(df):
    return sorted((f.name, KINDS.get(f.dataType.simpleString(), f.dataType.simpleString())) for f in df.schema.fields)


def duck_schema(db, sql):
    rel = db.sql(sql)
    return sorted((n, str(t)) for n, t in zip(rel.columns, rel.types, strict=True))
