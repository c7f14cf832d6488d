"""Compare a Spark result with SQL over the same tables: names, kinds of types, and all rows."""

import datetime
import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


SPARK_KIND = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def rows_of(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    def plain(v):
        if isinstance(v, datetime.datetime):
            return v.isoformat(" ")
        return v
    return sorted((tuple(plain(r[i]) for i in order) for r in records),
                  key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def check(df, con, sql):
    """None when both agree, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for field in df.schema.fields:
        kind = SPARK_KIND.get(field.dataType.simpleString(), field.dataType.simpleString())
        if kinds[field.name] != kind:
            return f"type of {field.name}: {kind} != {kinds[field.name]}"
    got = [tuple(r) for r in df.collect()]
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    left, right = rows_of(got, df.columns), rows_of(expected, names)
    for a, b in zip(left, right):
        if a != b:
            return f"{sorted(names)}: {a} != {b}"
    return None
