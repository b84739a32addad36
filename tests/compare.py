"""Compare a query's rows with those of its SQL."""

import math
from datetime import datetime

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x)
    if isinstance(x, datetime):
        return x.isoformat()
    return repr(x)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
               "timestamp_ntz": "TIMESTAMP"}


def differences(df, con, sql):
    """A list of what differs; empty if the results agree."""
    got_columns, got = as_rows(df.columns, df.collect())
    cursor = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    want_columns, want = as_rows(list(types), cursor.fetchall())
    found = []
    if got_columns != want_columns:
        found.append(f"columns {got_columns} / {want_columns}")
    else:
        kinds = {n: SPARK_TYPES.get(t, t) for n, t in df.dtypes}
        found += [f"type of {n}: {kinds[n]} / {types[n]}" for n in kinds if kinds[n] != types[n]]
    if len(got) != len(want):
        found.append(f"rows {len(got)} / {len(want)}")
    if got != want:
        only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        found.append(f"only here {only_got[:3]}; only in SQL {only_want[:3]}; {len(only_got)} / {len(only_want)}")
    return found
