"""The record pipeline: expand templates, route, map fields, apply command mode and error policy."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.decode import is_tombstone, split_decodable
from ..functions.paths import Formats
from ..operators.command import auto_command, check_command_fields, enforce_command, key_changes, snapshot_changes, snapshot_control, tag_snapshot
from ..operators.errors import error_rows
from ..operators.fields import map_fields
from ..operators.routing import expand_templates, route
from ..streaming.kept import LiveSubscriptions


@dataclass(frozen=True)
class Spec:
    """What to do with records: templates (for all topics or by topic), fields and policies."""

    templates: list | dict
    fields: dict = field(default_factory=dict)
    discover: tuple = ()
    formats: Formats = Formats()
    skip_failed: bool = False
    map_non_scalar: bool = False
    evaluate_fields: str = "routed"  # or "always": unrouted records' bad fields are errors too
    command: str | None = None  # "auto" or "enforce"
    track_keys: bool = False
    on_decode_error: str = "fail"  # or "dead_letter": payloads that don't decode are errors like others
    schemas: dict | None = None  # JSON schemas by payload column

    def __post_init__(self):
        if self.on_decode_error not in ("fail", "dead_letter"):
            raise ValueError(f"on_decode_error {self.on_decode_error!r}")
        if self.evaluate_fields not in ("routed", "always"):
            raise ValueError(f"evaluate_fields {self.evaluate_fields!r}")
        if self.command:
            check_command_fields(self.fields, self.command)


def process(records: DataFrame, subs: DataFrame, spec: Spec) -> tuple[DataFrame, DataFrame]:
    """Updates (one row per record and subscription, with ``failure`` null) and error rows.

    Records whose payloads don't decode stop the query, or are errors by ``on_decode_error``.
    Records whose templates fail give no updates. With ``routed`` fields are evaluated after the
    join, so that records nobody wants raise nothing; with ``always`` before it.
    """
    return _process(records, subs, spec, None)[:2]


class Changes:
    """``process`` over micro-batches: takes what command mode keeps between them, and returns what changes in it.

    What is kept (session, item, key): in ``enforce`` mode the items whose snapshot has ended, in
    ``auto`` mode with ``track_keys`` the keys that are there; else nothing. ``initial`` has what is
    kept before the first batch. ``subs`` may be ``LiveSubscriptions``, which change while the
    stream runs.
    """

    KEPT = "session string, item string, key string"

    def __init__(self, subs: DataFrame | LiveSubscriptions, spec: Spec, initial: DataFrame | None = None):
        self.subs, self.spec, self.initial = subs, spec, initial

    def __call__(self, records: DataFrame, before: DataFrame | None, subs: DataFrame | None = None, hold: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        """Updates, error rows, and what changes of what is kept (with ``gone``). ``hold`` keeps a frame that is read several times."""
        return _process(records, self.subs if subs is None else subs, self.spec, before, hold)


def _decoded(records: DataFrame, spec: Spec) -> tuple[DataFrame, DataFrame | None]:
    """Records whose binary payloads decode, and the others as error rows (none if they stop the query)."""
    sides = {c: f for c, f in (("key", spec.formats.key), ("value", spec.formats.value)) if dict(records.dtypes)[c] in ("binary", "string")}
    good, bad = split_decodable(records, sides, spec.on_decode_error, spec.schemas)
    if spec.on_decode_error == "fail":
        return good, None
    none = F.lit(None).cast("string")
    return good, bad.select(*records.columns, "stage", F.lit("malformed").alias("reason"), none.alias("expression"), "message")


def _process(records: DataFrame, subs: DataFrame, spec: Spec, before: DataFrame | None, hold: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    hold = hold or (lambda df: df)
    records, undecoded = _decoded(records, spec)
    expanded = hold(expand_templates(records, spec.templates, spec.formats))
    template_errors = error_rows(expanded)
    good = expanded.where("failure is null").drop("failure")
    mapping = {"fields": spec.fields, "discover": list(spec.discover), "skip_failed": spec.skip_failed, "map_non_scalar": spec.map_non_scalar, "formats": spec.formats}
    if spec.evaluate_fields == "always":
        mapped = hold(map_fields(good, **mapping))
        field_errors = error_rows(mapped)
        routed = route(mapped.where("failure is null").drop("failure"), subs)
    else:
        mapped = hold(map_fields(route(good, subs), **mapping))
        # One error a record, however many subscriptions it has.
        field_errors = error_rows(mapped).select(*template_errors.columns).dropDuplicates(["topic", "partition", "offset"])
        routed = mapped.where("failure is null").drop("failure")
    errors = template_errors.unionByName(field_errors.select(*template_errors.columns))
    if undecoded is not None:
        errors = errors.unionByName(undecoded.select(*template_errors.columns))
    keys, after = tuple(c for c in ("session", "item") if c in routed.columns), None
    if routed.isStreaming and (spec.command == "enforce" or spec.track_keys):
        raise ValueError("command mode keeps state between records: run it by stream_updates(records, Changes(subs, spec), ...)")
    if spec.command == "auto":
        routed = auto_command(routed, is_tombstone(F.col("value"), spec.formats.value), spec.track_keys, keys, live=before)
        if spec.track_keys:
            after = key_changes(routed, keys)
    if spec.command == "enforce":
        routed, rejected = enforce_command(routed)
        after = snapshot_changes(routed, keys).withColumn("key", F.lit(None).cast("string"))
        routed = tag_snapshot(snapshot_control(routed), keys, ended=before)
        none = F.lit(None).cast("string")
        errors = errors.unionByName(rejected.select(*[c for c in template_errors.columns if c not in ("stage", "reason", "expression", "message")], "stage", "reason", none.alias("expression"), F.lit("command discarded").alias("message")))
    else:
        routed = routed.withColumn("event_kind", F.lit("update")).withColumn("is_snapshot", F.lit(False))
    if after is not None and "session" not in keys:
        after = after.withColumn("session", F.lit(None).cast("string"))
    return routed, errors, after.select("session", "item", "key", "gone") if after is not None else None
