"""Change streams: ADD, UPDATE and DELETE by key, snapshot control, and the table they describe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import unused
from .fields import overlay
from .scans import last_value

CHANGES = ("ADD", "UPDATE", "DELETE")
CONTROLS = ("CS", "EOS")
ORDER = ("timestamp", "partition", "offset")


def check_command_fields(names, mode: str) -> None:
    """Refuse a field mapping that command mode can't work with."""
    if "key" not in names:
        raise ValueError("command mode needs a field named key")
    if mode == "enforce" and "command" not in names:
        raise ValueError("enforced command mode needs a field named command")


def command_mode(auto: bool, enforce: bool) -> str | None:
    """``auto`` wins over ``enforce``."""
    return "auto" if auto else "enforce" if enforce else None


def command_validity(fields: Column) -> Column:
    """Whether a fields map is a valid change or snapshot control."""
    key, command = fields["key"], fields["command"]
    there = F.coalesce(F.trim(key) != "", F.lit(False))
    change = (key != "snapshot") & command.isin(*CHANGES)
    control = (key == "snapshot") & command.isin(*CONTROLS)
    return there & F.coalesce(change | control, F.lit(False))


def enforce_command(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid updates, and discarded ones with ``stage`` and ``reason``."""
    valid = unused(df, "_valid")
    marked = df.withColumn(valid, command_validity(F.col("fields")))
    reason = (F.when(F.coalesce(F.trim(F.col("fields")["key"]), F.lit("")) == "", "missing_key").when(F.col("fields")["command"].isNull(), "missing_command").otherwise("invalid_command"))
    bad = marked.where(~F.col(valid)).withColumn("stage", F.lit("command")).withColumn("reason", reason)
    return marked.where(valid).drop(valid), bad.drop(valid)


def snapshot_control(df: DataFrame) -> DataFrame:
    """``event_kind``: CS clears the snapshot, EOS ends it, anything else is an update."""
    command = F.col("fields")["command"]
    return df.withColumn("event_kind", F.when(command == "CS", "clear_snapshot").when(command == "EOS", "end_of_snapshot").otherwise("update"))


def _with_before(df: DataFrame, before: DataFrame | None, on: list[str], name: str) -> DataFrame:
    """``df`` with the boolean ``name``: whether its ``on`` columns stand in ``before``."""
    if before is None:
        return df.withColumn(name, F.lit(False))
    stem = unused(df, "_b")
    there = before.select(*[F.col(c).alias(f"{stem}{k}") for k, c in enumerate(on)], F.lit(True).alias(name)).distinct()
    match = [F.col(c).eqNullSafe(F.col(f"{stem}{k}")) for k, c in enumerate(on)]
    return df.join(there, match, "left").drop(*[f"{stem}{k}" for k in range(len(on))]).withColumn(name, F.coalesce(name, F.lit(False)))


def _switch() -> Column:
    """What a row makes of its item's snapshot: begun (true), ended (false), or nothing."""
    return F.when(F.col("fields")["command"] == "CS", True).when(F.col("fields")["command"] == "EOS", False)


def tag_snapshot(df: DataFrame, keys: tuple[str, ...] = ("item",), order: tuple[str, ...] = ORDER, ended: DataFrame | None = None, segment: int = 600) -> DataFrame:
    """``is_snapshot`` of each row: from the start or a CS until after an EOS, by item in order.

    Order across partitions is that of ``order``; a one-partition topic is exact. ``ended`` names
    the keys whose snapshot had ended before the first row. Where ``order`` begins with a time,
    an item's rows are scanned in segments of so many seconds, by several tasks.
    """
    timed = df.schema[order[0]].dataType.typeName().startswith("timestamp")
    place = F.floor(F.unix_micros(F.col(order[0]).cast("timestamp")) / (segment * 1_000_000)) if timed else F.lit(0)
    ended_, switched = unused(df, "_ended"), unused(df, "_switched")
    begun = _with_before(df, ended, list(keys), ended_)
    scanned = last_value(begun, switched, _switch(), keys, order, place, inclusive=False)
    return scanned.withColumn("is_snapshot", F.coalesce(switched, ~F.col(ended_))).drop(ended_, switched)


def ended_snapshots(df: DataFrame, keys: tuple[str, ...] = ("item",), order: tuple[str, ...] = ORDER, ended: DataFrame | None = None) -> DataFrame:
    """The keys whose snapshot has ended after the last row; reduced before the shuffle."""
    last = df.select(*keys, F.struct(*order).alias("_at"), _switch().alias("_switch")).where("_switch is not null").groupBy(*keys).agg(F.max_by("_switch", "_at").alias("_switch"))
    return _carried(last, ended, list(keys), ~F.col("_switch"))


def snapshot_changes(df: DataFrame, keys: tuple[str, ...] = ("item",), order: tuple[str, ...] = ORDER) -> DataFrame:
    """The keys whose snapshot ended or began (``gone``: it isn't ended any more), by their last switch; reduced before the shuffle."""
    switches = df.select(*keys, F.struct(*order).alias("at"), _switch().alias("begun")).where("begun is not null")
    return switches.groupBy(*keys).agg(F.max_by("begun", "at").alias("gone"))


def key_changes(df: DataFrame, keys: tuple[str, ...] = ("item",), order: tuple[str, ...] = ORDER) -> DataFrame:
    """The keys (``keys`` and key) that changed, ``gone`` if they were deleted last; reduced before the shuffle."""
    rows = df.select(*keys, F.col("fields")["key"].alias("key"), F.struct(*order).alias("at"), F.col("fields")["command"].alias("command"))
    last = rows.where(F.col("command").isin(*CHANGES)).groupBy(*keys, "key").agg(F.max_by("command", "at").alias("command"))
    return last.select(*keys, "key", (F.col("command") == "DELETE").alias("gone"))


def _carried(last: DataFrame, before: DataFrame | None, on: list[str], holds: Column) -> DataFrame:
    """The keys that hold by their last row, and those of ``before`` that had no row."""
    now = last.where(holds).select(*on)
    if before is None:
        return now
    seen = last.select(*[F.col(c).alias(f"_b_{c}") for c in on])
    return now.unionByName(before.select(*on).join(seen, [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in on], "left_anti"))


def auto_command(df: DataFrame, tombstone: Column, track_keys: bool = False, keys: tuple[str, ...] = ("item",), order: tuple[str, ...] = ORDER, live: DataFrame | None = None) -> DataFrame:
    """Commands from payloads: a record adds, a tombstone deletes and keeps only its key.

    With ``track_keys`` a key seen since its last deletion is updated instead of added; ``live``
    has those (``keys`` and key) that were seen before the first row.
    """
    gone, key, seen, lived = (unused(df, n) for n in ("_gone", "_key", "_seen", "_live"))
    check = df.withColumn(gone, tombstone).withColumn(key, F.col("fields")["key"])
    command = F.lit("ADD")
    if track_keys:
        before = Window.partitionBy(*keys, key).orderBy(*order).rowsBetween(-1, -1)
        known = live.withColumnRenamed("key", key) if live is not None else None
        check = _with_before(check, known, [*keys, key], lived)
        check = check.withColumn(seen, F.coalesce(~F.last(gone).over(before), F.col(lived))).drop(lived)
        command = F.when(F.col(seen), "UPDATE").otherwise("ADD")
    added = overlay(F.col("fields"), F.create_map(F.lit("command"), command))
    deleted = F.create_map(F.lit("key"), F.col(key), F.lit("command"), F.lit("DELETE"))
    out = check.withColumn("fields", F.when(F.col(gone), deleted).otherwise(added))
    return out.drop(gone, key, *([seen] if track_keys else []))


def live_keys(df: DataFrame, keys: tuple[str, ...] = ("item",), order: tuple[str, ...] = ORDER, live: DataFrame | None = None) -> DataFrame:
    """The keys (``keys`` and key) not deleted after the last row of a change stream; reduced before the shuffle."""
    last = df.select(*keys, F.col("fields")["key"].alias("key"), F.struct(*order).alias("_at"), F.col("fields")["command"].alias("_command"))
    last = last.where(F.col("_command").isin(*CHANGES)).groupBy(*keys, "key").agg(F.max_by("_command", "_at").alias("_command"))
    return _carried(last, live, [*keys, "key"], F.col("_command") != "DELETE")


def materialize_board(df: DataFrame, keys: tuple[str, ...] = ("item",), order: tuple[str, ...] = ORDER) -> DataFrame:
    """The table of each item after all changes: rows after its last CS, the last of each key, deleted ones gone."""
    position = F.struct(*order)
    command, key = F.col("fields")["command"], F.col("fields")["key"]
    rows = df.select(*keys, position.alias("_at"), command.alias("_command"), key.alias("_key"), "fields")
    # Both aggregations reduce before the shuffle, so a busy item isn't gathered anywhere.
    cleared = rows.where("_command = 'CS'").groupBy(*keys).agg(F.max("_at").alias("_cleared"))
    last = rows.where(F.col("_command").isin(*CHANGES)).groupBy(*keys, "_key").agg(F.max_by(F.struct("_at", "_command", "fields"), "_at").alias("_last"))
    joined = last.join(cleared, list(keys), "left").where(F.col("_cleared").isNull() | (F.col("_last._at") > F.col("_cleared")))
    board = joined.where("_last._command <> 'DELETE'")
    return board.select(*keys, F.col("_key").alias("key"), F.map_filter("_last.fields", lambda k, v: k != "command").alias("fields"))


def sorted_board(board: DataFrame, field: str, ascending: bool = True, keys: tuple[str, ...] = ("item",)) -> DataFrame:
    """A board in order of a field, then the key, within each item."""
    by = F.col("fields")[field]
    return board.orderBy(*keys, by.asc() if ascending else by.desc(), "key")
