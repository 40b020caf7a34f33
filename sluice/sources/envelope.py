"""The record envelope: key, value, topic, partition, offset, timestamp, headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADERS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]))
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()), T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("headers", HEADERS)])


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def as_envelope(df: DataFrame, topic, key=None, value=None, partition=0, offset=0, timestamp=None, headers=None) -> DataFrame:
    """An envelope made of any table; arguments are columns or constants.

    Text keys and values become bytes; structs, maps and arrays stay typed.
    """
    def payload(c) -> Column:
        c = _column(c)
        kind = df.select(c.alias("c")).schema["c"].dataType
        return c if isinstance(kind, (T.StructType, T.MapType, T.ArrayType, T.BinaryType)) else c.cast("string").cast("binary")

    return df.select(payload(key).alias("key"), payload(value).alias("value"), _column(topic).cast("string").alias("topic"),
                     _column(partition).cast("int").alias("partition"), _column(offset).cast("bigint").alias("offset"),
                     _column(timestamp).cast("timestamp").alias("timestamp"), _column(headers).cast(HEADERS).alias("headers"))


def read_structured(df: DataFrame, topic, key: Column, value: Column, **rest) -> DataFrame:
    """An envelope whose key and value already carry a schema; a value without one is refused."""
    kind = df.select(value.alias("v")).schema["v"].dataType
    if not isinstance(kind, (T.StructType, T.MapType, T.ArrayType)):
        raise ValueError("A Schema is required")
    return as_envelope(df, topic, key, value, **rest)
