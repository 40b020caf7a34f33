"""Routing: topics to item templates, templates to item names, item names to subscriptions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import Formats, extract, fixed, parse, unused
from ..functions.text import words_of
from .fields import FAILURE, _failure

#: Rows of a side up to which it is sent to every executor.
BROADCAST_ROWS = 100_000


def sized(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``side`` marked for broadcast if it has at most so many rows, else left to shuffle."""
    if side.isStreaming:
        return side
    return F.broadcast(side) if side.limit(rows + 1).count() <= rows else side


@dataclass(frozen=True)
class Template:
    """``prefix-#{p=PATH,...}``: parameters by name; a plain item has none."""

    text: str
    prefix: str
    params: tuple[tuple[str, str], ...]


def parse_template(text: str) -> Template:
    """Split an item template; scalar paths only, no repeated parameters."""
    if not text or not text.strip():
        raise ValueError("blank item")
    m = re.fullmatch(r"([^#]+)-#\{(.*)\}", text, re.S)
    if not m:
        if "#{" in text:
            raise ValueError(f"invalid template {text!r}")
        return Template(text, text, ())
    params = {}
    for part in re.split(r",(?=\s*\w+\s*=)", m[2]):
        name, eq, path = part.partition("=")
        name = name.strip()
        if not eq or not re.fullmatch(r"\w+", name) or name in params:
            raise ValueError(f"invalid parameter {part!r} in {text!r}")
        params[name] = path.strip()
        parse("#{" + path.strip() + "}")
    return Template(text, m[1], tuple(sorted(params.items())))


def route_topics(df: DataFrame, mapping: DataFrame, regex: bool = False, topics: list[str] | None = None) -> DataFrame:
    """Records with each item reference of their topic: ``mapping`` (topic, item_ref).

    With ``regex`` the mapping's topics are patterns that must match in full; a record gets the
    union of all that match. ``topics`` lists the topics there are, as the cluster tells them; else
    the records are read once more for theirs. Records of other topics give no rows.
    """
    topic, name = unused(df, "_topic"), unused(df, "_name")
    mapping = mapping.select(F.col("topic").alias(topic), "item_ref").distinct()
    if not regex:
        return df.join(sized(mapping), F.col("topic") == F.col(topic)).drop(topic)
    # Patterns are matched against the distinct topics, which are few, and the records joined by topic.
    if topics is None:
        there = df.select(F.col("topic").alias(name)).distinct()
    else:
        there = df.sparkSession.createDataFrame([(t,) for t in dict.fromkeys(topics)], f"{name} string")
    matched = there.join(F.broadcast(mapping) if mapping.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else mapping,
                          F.rlike(F.col(name), F.concat(F.lit("^(?:"), F.col(topic), F.lit(")$")))).select(name, "item_ref").distinct()
    return df.join(sized(matched), F.col("topic") == F.col(name)).drop(name)


def expand_templates(df: DataFrame, templates: list[str] | dict[str, list[str]], formats: Formats = Formats()) -> DataFrame:
    """``df`` with ``items`` (distinct canonical names) and ``failure`` of the first failing template.

    ``templates``: items and templates for all records, or by topic. A parameter that is null reads
    ``null`` if it is the template's only one, else the record fails (``null_parameter``). A failing
    template fails the record whatever else.
    """
    by_topic = templates if isinstance(templates, dict) else {None: templates}
    parsed = {text: parse_template(text) for some in by_topic.values() for text in some}
    paths, place, stem = {}, {}, unused(df, "_t")
    for t in parsed.values():
        for _, path in t.params:
            if path not in place:
                place[path] = f"{stem}{len(place)}"
                paths[place[path]] = parse("#{" + path + "}")
    out = extract(df, paths, formats)
    names, failures = [], [F.lit(None).cast(FAILURE)]
    for text, t in parsed.items():
        topics = [topic for topic, some in by_topic.items() if text in some and topic is not None]
        mine = F.lit(True) if None in by_topic else F.col("topic").isin(topics)
        if not t.params:
            names.append(F.when(mine, F.lit(t.prefix)))
            continue
        columns = {place[path]: "#{" + path + "}" for _, path in t.params}
        values = [F.col(place[path])["text"] for _, path in t.params]
        failures.append(F.when(mine, _failure(columns, "template")))
        if len(values) > 1:
            no_value = F.struct(F.lit("template").alias("stage"), F.lit("null_parameter").alias("reason"), F.lit(text).alias("expression"), F.lit("A parameter is null").alias("message"))
            failures.append(F.when(mine & F.greatest(*[v.isNull().cast("int") for v in values]).cast("boolean"), no_value))
        parts = []
        for k, ((name, _), value) in enumerate(zip(t.params, values)):
            parts += [F.lit(f"{',' if k else t.prefix + '-['}{name}="), F.coalesce(value, F.lit("null"))]
        names.append(F.when(mine, F.concat(*parts, F.lit("]"))))
    items = F.array_distinct(F.filter(F.array(*names), lambda n: n.isNotNull()))
    failure = F.coalesce(*failures)
    return fixed(out.drop("failure", "items"), {"failure": failure, "items": F.when(failure.isNull(), items)}).drop(*paths)


def canonical_item(text: Column) -> Column:
    """struct(valid, item, prefix, params) of subscription text: parameters sorted by name.

    ``item-[]`` is ``item``; ``item-`` stays; repeated parameters or malformed ones aren't valid.
    """
    shape = r"(?s)^(.+?)-\[(.*)\]$"
    has = text.rlike(shape)
    inner, prefix = F.regexp_extract(text, shape, 2), F.regexp_extract(text, shape, 1)
    tokens = F.filter(F.split(inner, r",(?=\s*\w+\s*=)"), lambda t: F.trim(t) != "")
    pairs = F.array_sort(F.transform(tokens, lambda t: F.struct(F.trim(F.substring_index(t, "=", 1)).alias("name"), F.regexp_replace(t, r"(?s)^[^=]*=", "").alias("value"), t.contains("=").alias("ok"))))
    names = F.transform(pairs, lambda p: p["name"])
    good = F.forall(pairs, lambda p: p["ok"] & p["name"].rlike(r"^\w+$")) & (F.size(F.array_distinct(names)) == F.size(names))
    joined = F.array_join(F.transform(pairs, lambda p: F.concat(p["name"], F.lit("="), p["value"])), ",")
    item = F.when(~has, text).when(F.size(pairs) == 0, prefix).otherwise(F.concat(prefix, F.lit("-["), joined, F.lit("]")))
    valid = F.coalesce(F.when(F.trim(text) == "", F.lit(False)).when(has, good).otherwise(~text.rlike(r"-\[|\]$")), F.lit(False))
    none = F.array().cast("array<string>")
    return F.struct(valid.alias("valid"), F.when(valid, item).alias("item"), F.when(valid, F.when(has, prefix).otherwise(text)).alias("prefix"),
                    F.when(valid, F.when(has, names).otherwise(none)).alias("params"))


def split_items(df: DataFrame, column: str) -> DataFrame:
    """One row per item of a list separated by white space, with its canonical form."""
    return df.withColumn("requested", F.explode(words_of(F.col(column)))).withColumn("canonical", canonical_item(F.col("requested")))


def match_templates(subs: DataFrame, templates: list[str], column: str = "item_text") -> tuple[DataFrame, DataFrame]:
    """Subscriptions some template admits, with ``item``; and the others with ``reason``.

    One is admitted if its prefix and its set of parameter names equal a template's.
    """
    schemas = sorted({(t.prefix, tuple(n for n, _ in t.params)) for t in map(parse_template, templates)})
    c, ok = unused(subs, "_c"), unused(subs, "_ok")
    marked = subs.withColumn(c, canonical_item(F.col(column)))
    admitted = F.coalesce(*[F.when((F.col(f"{c}.prefix") == p) & (F.col(f"{c}.params") == F.array(*[F.lit(n) for n in names]).cast("array<string>")), F.lit(True)) for p, names in schemas], F.lit(False))
    marked = marked.withColumn(ok, admitted).withColumn("item", F.col(f"{c}.item"))
    good = marked.where(ok).drop(c, ok)
    bad = marked.where(~F.col(ok)).withColumn("reason", F.when(F.col(f"{c}.valid"), "no_template").otherwise("invalid_item")).drop(c, ok, "item")
    return good, bad


def route(df: DataFrame, subs: DataFrame) -> DataFrame:
    """A row per record and subscription whose canonical name is one of the record's ``items``.

    Subscriptions with ``from_time`` and ``to_time`` (null: open) get the records of that time only,
    by ``timestamp``: from the first on, up to but without the second.
    """
    names = df.where("items is not null").withColumn("item", F.explode("items"))
    # Not nullable, so that no null check is pushed below the projection that decodes the record.
    names = names.withColumn("item", F.coalesce("item", F.lit(""))).drop("items")
    if not {"from_time", "to_time"} <= set(subs.columns):
        return names.join(sized(subs), "item")
    return _in_time(names, subs)


#: Widths of time buckets, in seconds: powers of RADIX.
RADIX, LEVELS = 8, 13


def _in_time(names: DataFrame, subs: DataFrame) -> DataFrame:
    """Records (item, timestamp, ...) with the intervals of their item that hold their time.

    An interval goes to the one or two buckets of the smallest width that isn't below its length, so
    a record meets only intervals of its item that lie near its time, one bucket a width that is in
    use. Open intervals have one bucket an item.
    """
    begin, end, level, bucket = (unused(names.join(subs.limit(0), "item"), n) for n in ("_from", "_to", "_level", "_bucket"))
    timed = subs.withColumnsRenamed({"from_time": begin, "to_time": end})
    first, last = F.unix_micros(F.col(begin).cast("timestamp")), F.unix_micros(F.col(end).cast("timestamp"))
    widths = [1_000_000 * RADIX**k for k in range(LEVELS)]
    open_ = F.col(begin).isNull() | F.col(end).isNull() | (last - first > widths[-1])
    smaller = sum((F.when(last - first > w, 1).otherwise(0) for w in widths), F.lit(0))
    timed = timed.where(F.col(begin).isNull() | F.col(end).isNull() | (last > first)).withColumn(level, F.when(open_, F.lit(LEVELS)).otherwise(smaller))
    levels = sorted(r[0] for r in timed.select(level).distinct().collect()) or [LEVELS]  # LEVELS + 1 numbers at most
    width = F.get(F.array(*[F.lit(w) for w in widths]), F.col(level))
    near = F.when(F.col(level) == LEVELS, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.floor(first / width), F.floor((last - 1) / width)))
    timed = timed.withColumn(bucket, F.explode(near))
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    places = F.array(*[F.struct(F.lit(k).alias(level), (F.floor(at / widths[k]) if k < LEVELS else F.lit(0)).cast("long").alias(bucket)) for k in levels])
    placed = names.select("*", F.inline(places))
    within = (F.col(begin).isNull() | (F.col("timestamp") >= F.col(begin))) & (F.col(end).isNull() | (F.col("timestamp") < F.col(end)))
    return placed.join(sized(timed), ["item", level, bucket]).where(within).drop(begin, end, level, bucket)


def with_routed(df: DataFrame, subs: DataFrame, column: str = "routed", most_items: int | None = None) -> DataFrame:
    """``df`` with a boolean column: whether at least one subscription wants the record.

    With ``most_items``, the largest number of items of a record (that of the templates), and a
    bounded number of wanted items no record moves: each place of ``items`` is looked up in what
    every task holds. Streams need it. Otherwise only items and positions move to be compared, and
    records are joined to the positions found.
    """
    at, item, hit = (unused(df, n) for n in ("_at", "_item", "_hit"))
    items = subs.select(F.col("item").alias(item)).where(F.col(item).isNotNull()).distinct()
    if most_items is not None and items.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        found, hits = df, []
        for k in range(most_items):
            hits.append(f"{hit}{k}")
            found = found.join(F.broadcast(items.withColumn(hits[-1], F.lit(True))), F.get("items", F.lit(k)) == F.col(item), "left").drop(item)
        return found.withColumn(column, F.coalesce(*[F.col(h) for h in hits], F.lit(False))).drop(*hits)
    if df.isStreaming:
        raise ValueError("on a stream the number of items of a record (most_items) and a bounded number of wanted items are needed")
    keyed = df.withColumn(at, F.struct("topic", "partition", "offset"))
    positions = keyed.select(at, F.explode("items").alias(item)).join(sized(items), item, "left_semi").select(at).distinct()
    return keyed.join(positions.withColumn(hit, F.lit(True)), at, "left").withColumn(column, F.coalesce(hit, F.lit(False))).drop(at, hit)


def filter_routed(df: DataFrame, subs: DataFrame, most_items: int | None = None) -> DataFrame:
    """Records that at least one subscription wants; see ``with_routed``."""
    flag = unused(df, "_routed")
    return with_routed(df, subs, flag, most_items).where(flag).drop(flag)


def unrouted(df: DataFrame, subs: DataFrame, most_items: int | None = None) -> DataFrame:
    """Records that no subscription wants; see ``with_routed``."""
    flag = unused(df, "_routed")
    return with_routed(df, subs, flag, most_items).where(~F.col(flag)).drop(flag)


def admit(subs: DataFrame, connections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Subscriptions (connection, mode, ...) that may go on, and the others with ``reason``.

    ``connections``: connection, enabled, command_mode. With command mode only COMMAND
    subscriptions are allowed.
    """
    c, enabled, command = (unused(subs, n) for n in ("_c", "_enabled", "_command"))
    known = connections.select(F.col("connection").alias(c), F.col("enabled").alias(enabled), F.col("command_mode").alias(command))
    joined = subs.join(sized(known), F.col("connection") == F.col(c), "left")
    reason = (F.when(F.col(c).isNull(), "unknown_connection").when(~F.coalesce(enabled, F.lit(False)), "connection_disabled")
              .when(F.coalesce(command, F.lit(False)) & (F.coalesce("mode", F.lit("")) != "COMMAND"), "command_mode_required"))
    marked = joined.withColumn("reason", reason).drop(c, enabled, command)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def active_subscriptions(log: DataFrame, order: str = "seq", keys: tuple[str, ...] = ("item",)) -> DataFrame:
    """The subscriptions that stand after a log (item, action, order, ...): the last entry of each
    name counts, and unsubscribed ones are gone."""
    others = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order)).alias("_last"))
    return last.where(F.col("_last")["action"] == "subscribe").select(*keys, "_last.*")


def subscription_intervals(log: DataFrame, order: str = "seq", keys: tuple[str, ...] = ("item",), names: tuple[str, str] = ("from_seq", "to_seq")) -> DataFrame:
    """From where to where each subscription of a log stands: keys, from_seq, to_seq (null: open).

    With an ``order`` that is a time and the names ``from_time`` and ``to_time`` it is what ``route`` takes.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    return log.withColumn(names[1], F.lead(order).over(w)).where("action = 'subscribe'").withColumnRenamed(order, names[0]).drop("action")


def items_by_session(log: DataFrame, order: str = "seq") -> DataFrame:
    """The sorted items each session holds after a log (session, item, action, order)."""
    return active_subscriptions(log, order, ("session", "item")).groupBy("session").agg(F.array_sort(F.collect_set("item")).alias("items"))


def union_topics(*frames: DataFrame) -> DataFrame:
    """Several topics' records in one frame, columns by name."""
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
