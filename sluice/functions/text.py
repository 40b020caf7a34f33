"""Small text, number and collection functions as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def split_trimmed(text: Column, separator: str) -> Column:
    """Tokens between separators, white space around separators dropped, empty tokens kept."""
    return F.split(F.trim(text), rf"\s*{_quote(separator)}\s*", -1)


def split_pair(text: Column, separator: str, blank_value: bool = True) -> Column:
    """struct(key, value) of a ``key<sep>value`` token; null if it isn't one or its key is blank."""
    parts = split_trimmed(text, separator)
    value = F.coalesce(F.get(parts, 1), F.lit(""))
    good = (F.size(parts) <= 2) & (F.get(parts, 0) != "")
    if not blank_value:
        good &= value != ""
    return F.when(good, F.struct(F.get(parts, 0).alias("key"), value.alias("value")))


def _quote(separator: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", separator)


def words_of(text: Column) -> Column:
    """Tokens between runs of white space."""
    return F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != "")


def last_wins(entries: Column) -> Column:
    """Map of an array of struct(key, value) entries; of equal keys the last counts."""
    keys = F.transform(entries, lambda e: e["key"])
    kept = F.filter(F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), e["value"].alias("value"), i.alias("at"))),
                    lambda e: e["at"] == F.size(keys) - F.array_position(F.reverse(keys), e["key"]))
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"], e["value"])))


def unsigned_text(value: Column, bits: int) -> Column:
    """Text of a signed 32- or 64-bit number read as unsigned."""
    if bits == 32:
        return value.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)).cast("string")
    wide = value.cast("decimal(20,0)")
    return F.when(value < 0, wide + F.lit(str(2**64)).cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)").cast("string")


def utf8_text(value: Column) -> Column:
    """Bytes as UTF-8, malformed ones replaced."""
    return F.make_valid_utf8(value.cast("string"))


def byte_list_text(value: Column) -> Column:
    """``[97, 98, -1]``: bytes as signed numbers."""
    def signed(i: Column) -> Column:
        n = F.conv(F.hex(F.substring(value, i, 1)), 16, 10).cast("int")
        return F.when(n > 127, n - 256).otherwise(n).cast("string")

    n = F.octet_length(value)
    numbers = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), signed)).otherwise(F.array().cast("array<string>"))
    return F.concat(F.lit("["), F.array_join(numbers, ", "), F.lit("]"))


def map_text(value: Column, between: str = ": ") -> Column:
    """``{k: v, ...}`` of a map of strings; null values read ``null``."""
    pairs = F.transform(F.map_entries(value), lambda e: F.concat(e["key"], F.lit(between), F.coalesce(e["value"], F.lit("null"))))
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


def indexed(name: str, items: Column) -> Column:
    """Map ``name[i]`` -> i-th item of an array of strings."""
    return F.map_from_entries(F.transform(items, lambda e, i: F.struct(F.concat(F.lit(f"{name}["), i.cast("string"), F.lit("]")), e)))


def millis_text(value: Column) -> Column:
    """Epoch milliseconds of a timestamp as text."""
    return F.unix_millis(value).cast("string")


def json_keys(value: Column) -> Column:
    """Keys of a JSON object in order; null if it isn't one."""
    return F.map_keys(F.from_json(value, T.MapType(T.StringType(), T.StringType())))


def json_length(value: Column) -> Column:
    """Elements of a JSON array; null if it isn't one."""
    return F.json_array_length(value)


def json_element(value: Column, index: int) -> Column:
    """Text of an array's element; null if null or out of range."""
    return F.get(F.from_json(value, T.ArrayType(T.StringType())), index)
