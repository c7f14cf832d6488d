"""Rows as JSON text: lenient decode, encode, and keyed records with tombstones.

Timestamps are ISO-8601 text to the microsecond: instants carry their offset, zone-less times
none, and on reading the fraction and the offset may be missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

_CORRUPT = "_corrupt"

# Spark's default stops at milliseconds.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
              "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def encode_row(columns: list[str]) -> Column:
    """NULL fields are left out of the text; a reader gets NULL for a missing field."""
    return F.to_json(F.struct(*columns), JSON_TIMES)


def _marked(text: str | Column, schema: T.StructType) -> Column:
    """The parsed row with, if the text does not parse, that text as one more field.

    In permissive mode a bad row is a struct of NULLs, not a NULL struct, so ask for the bad text
    itself.
    """
    fields = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    return F.from_json(text, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def decode_order(text: str, schema: T.StructType) -> Column:
    """The order columns of a record. One without any, or with broken ones, has none: not a struct of NULLs.

    An object that parses and does not begin with its end has a field; only other texts are read
    a second time for their field names.
    """
    def known(row: Column) -> Column:
        has_fields = F.col(text).startswith('{"') & row[_CORRUPT].isNull() | (F.size(F.json_object_keys(text)) > 0)
        return F.when(has_fields, F.struct(*[row[f.name].alias(f.name) for f in schema.fields]))
    return F.get(F.transform(F.array(_marked(text, schema)), known), F.lit(0))


def decode_rows(df: DataFrame, text: str, schema: T.StructType, keep: list[str] | None = None,
                required: bool = False) -> DataFrame:
    """Parse JSON text into declared columns, next to the columns named in ``keep``.

    A missing field becomes NULL and a row that does not parse is skipped. With ``required``
    a row that does not parse fails the job instead.

    The parsed row goes through ``inline``: a filter on it could otherwise be moved below the
    projection that parses, and each row would be parsed twice.
    """
    keep = keep or []
    known = df.filter(F.col(text).isNotNull())
    if required:
        parsed = F.from_json(text, schema, {"mode": "FAILFAST"})
        return known.select(*keep, F.inline(F.array(parsed)))
    return known.select(*keep, F.inline(F.array(_marked(text, schema)))).filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT)


def key_partition(keys: list[str], partitions: int) -> Column:
    """A partition number that depends on the key alone."""
    return F.pmod(F.xxhash64(*keys), F.lit(partitions)).cast("int")


def encode_keyed(changes: DataFrame, keys: list[str], values: list[str],
                 *extra: Column) -> DataFrame:
    """Changes as key and value text. A delete has no value; before-images are not sent."""
    return changes.filter(F.col("op") != "-U").select(
        encode_row(keys).alias("key"),
        F.when(F.col("op") != "-D", encode_row(values)).alias("value"),
        *extra,
    )


def decode_keyed(records: DataFrame, key_schema: T.StructType, value_schema: T.StructType,
                 keep: list[str] | None = None) -> DataFrame:
    """Back to changes: a record without value is a delete, any other an update by key.

    Records whose key or value does not parse are skipped (``unreadable`` counts them): a value
    that is merely broken is neither a delete nor a row of NULLs.
    """
    keep = keep or []
    plain = T.StructType([f for f in value_schema.fields if f.name not in key_schema.names])
    op = F.when(F.col("value").isNull(), F.lit("-D")).otherwise(F.lit("+U"))

    def with_value(key: Column) -> Column:
        value = _marked(F.coalesce("value", F.lit("{}")), plain)
        return F.struct(key.alias("_key"), F.when(key[_CORRUPT].isNull(), value).alias("_value"))
    # Both are parsed in one step, so texts need not go from one to the next. `inline` as in `decode_rows`.
    rows = records.filter(F.col("key").isNotNull()).select(
        *keep, op.alias("op"), F.inline(F.transform(F.array(_marked("key", key_schema)), with_value)))
    return rows.filter(F.col("_key")[_CORRUPT].isNull() & F.col("_value")[_CORRUPT].isNull()).select(
        *keep, "op", *[F.col("_key")[n].alias(n) for n in key_schema.names], *[F.col("_value")[n].alias(n) for n in plain.names])


def unreadable(df: DataFrame, texts: dict[str, T.StructType]) -> DataFrame:
    """One row: how many rows came, and by text column how many of its texts do not parse."""
    def bad(text: str, schema: T.StructType) -> Column:
        return F.count_if(_marked(text, schema)[_CORRUPT].isNotNull()).alias(f"bad_{text}")
    return df.agg(F.count("*").alias("records"), *[bad(t, s) for t, s in texts.items()])
