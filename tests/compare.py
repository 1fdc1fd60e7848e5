"""Comparison of a Spark result with the rows of the checking SQL."""

import glob
import math
import os

import duckdb


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def _plain(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, text):
    result = con.execute(text)
    return rows_of([d[0] for d in result.description], result.fetchall())


# Spark type and the type the checking SQL must give for it.
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def schemas(df, con, text):
    ours = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {text}").fetchall()}
    return ours, theirs
