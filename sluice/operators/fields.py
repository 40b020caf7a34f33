"""Flat field maps from records: named paths, wildcard discovery and their combination."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import STRINGS, Formats, extract, fixed, parse, unused
from ..functions.text import words_of

FAILURE = "struct<stage:string,reason:string,expression:string,message:string>"


def _failure(results: dict[str, str], stage: str) -> Column:
    """The first failing result, in the order given."""
    none = F.lit(None).cast(FAILURE)
    each = [F.when(~F.col(c)["ok"], F.struct(F.lit(stage).alias("stage"), F.col(c)["reason"].alias("reason"), F.lit(e).alias("expression"), F.col(c)["message"].alias("message"))) for c, e in results.items()]
    return F.coalesce(*each, none)


def map_fields(df: DataFrame, fields: dict[str, str], discover: list[str] | str | None = None, skip_failed: bool = False,
               map_non_scalar: bool = False, formats: Formats = Formats()) -> DataFrame:
    """``df`` with ``fields`` (map of text) and ``failure`` (null if all went well).

    ``fields``: name -> ``#{path}``; ``discover``: wildcard paths whose finds come first and are
    overridden by named fields. A failing field fails the record (null ``fields``), or with
    ``skip_failed`` is left out.
    """
    stars = [discover] if isinstance(discover, str) else list(discover or [])
    if not fields and not stars:
        raise ValueError("no fields")
    if any(not n.strip() for n in fields):
        raise ValueError("blank field name")
    one, star = unused(df, "_f"), unused(df, "_d")
    paths = {f"{one}{k}": parse(e) for k, e in enumerate(fields.values())} | {f"{star}{k}": parse(e, wildcard=True) for k, e in enumerate(stars)}
    expressions = dict(zip(paths, [*fields.values(), *stars]))
    out = extract(df, paths, formats, map_non_scalar)
    empty = F.create_map().cast(STRINGS)
    found = [F.coalesce(F.col(f"{star}{k}")["fields"], empty) for k in range(len(stars))]
    entries = [F.struct(F.lit(n).alias("key"), F.col(f"{one}{k}")["text"].alias("value")) for k, n in enumerate(fields)]
    if skip_failed:
        pairs = F.filter(F.array(*[F.struct(F.col(f"{one}{k}")["ok"].alias("ok"), e.alias("entry")) for k, e in enumerate(entries)]), lambda p: p["ok"]) if entries else None
        named = F.map_from_entries(F.transform(pairs, lambda p: p["entry"])) if entries else empty
    else:
        named = F.map_from_entries(F.array(*entries)) if entries else empty
    fields_ = reduce(overlay, [*found, named])
    failure = F.lit(None).cast(FAILURE) if skip_failed else _failure(expressions, "field")
    out = fixed(out.drop("failure", "fields"), {"failure": failure, "fields": F.when(failure.isNull(), fields_)})
    return out.drop(*paths)


def overlay(low: Column, high: Column) -> Column:
    """Both maps' entries; where both have a key the second counts."""
    return F.map_concat(F.map_filter(low, lambda k, v: ~F.map_contains_key(high, k)), high)


def discover(df: DataFrame, wildcard: str, map_non_scalar: bool = True, formats: Formats = Formats(), skip_failed: bool = False) -> DataFrame:
    """``df`` with the fields a wildcard path finds: object properties, array elements or headers."""
    return map_fields(df, {}, wildcard, skip_failed, map_non_scalar, formats)


def select_fields(df: DataFrame, names: str | Column) -> DataFrame:
    """Keep of ``fields`` those a client asks for, a list separated by white space."""
    wanted = words_of(F.lit(names) if isinstance(names, str) else names)
    return df.withColumn("fields", F.map_filter("fields", lambda k, v: F.array_contains(wanted, k)))
