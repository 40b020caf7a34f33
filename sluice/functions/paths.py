"""Path extraction: ``#{ROOT.name[i]['k'].*}`` compiled to columns.

A path is split once, while the plan is built. JSON is stepped into layer by layer, one projection
a depth, so that paths with a common start parse it once; typed columns (structs, maps, arrays)
are stepped into by plain field access. Each path gives ``struct(ok, text, reason, message)``, or
with a wildcard ``struct(ok, fields, reason, message)``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .decode import decode
from .text import byte_list_text, indexed, map_text, millis_text, utf8_text

ROOTS = ("KEY", "VALUE", "TIMESTAMP", "PARTITION", "OFFSET", "TOPIC", "HEADERS")
CONSTANTS = ("TIMESTAMP", "PARTITION", "OFFSET", "TOPIC")
STRINGS = T.MapType(T.StringType(), T.StringType())

_STEP = re.compile(r"\.([^.\[\]*]+)|\[(\d+)\]|\['([^']+)'\]")


@dataclass(frozen=True)
class Path:
    expression: str
    root: str
    steps: tuple  # names (str) and indexes (int)
    wildcard: bool = False

    @property
    def name(self) -> str:
        """The last property with the indexes after it."""
        tail = ""
        for step in reversed(self.steps):
            if isinstance(step, str):
                return step + tail
            tail = f"[{step}]{tail}"
        return self.root + tail


def parse(expression: str, wildcard: bool = False) -> Path:
    """Split ``#{...}``; anything malformed, or a stray or missing ``*``, is refused here."""
    m = re.fullmatch(r"#\{(.+)\}", expression or "")
    if not m:
        raise ValueError(f"not a path: {expression!r}")
    inner = m[1]
    star = inner.endswith(".*")
    if star != wildcard:
        raise ValueError(f"{'missing' if wildcard else 'stray'} wildcard in {expression}")
    body = inner[:-2] if star else inner
    root = re.match(r"[A-Z]*", body)[0]
    if root not in ROOTS:
        raise ValueError(f"unknown root in {expression}")
    steps, at = [], len(root)
    while at < len(body):
        m = _STEP.match(body, at)
        if not m or (m[1] is not None and m[1] != m[1].strip()):
            raise ValueError(f"invalid path {expression}")
        steps.append(int(m[2]) if m[2] is not None else m[1] or m[3])
        at = m.end()
    if root in CONSTANTS and (steps or star):
        raise ValueError(f"{root} has no parts: {expression}")
    return Path(inner, root, tuple(steps), star)


def _node(kind: Column, text: Column, reason=None, message=None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(kind.alias("kind"), text.alias("text"), (none if reason is None else reason).alias("reason"), (none if message is None else message).alias("message"))


def _failed(reason: str, message: str) -> Column:
    none = F.lit(None).cast("string")
    return _node(none, none, F.lit(reason), F.lit(message))


def _kind(raw: Column) -> Column:
    first = F.substring(raw, 1, 1)
    return F.when(first == "{", "object").when(first == "[", "array").when(raw.isNull() | (raw == "null"), "null").otherwise("scalar")


def _json_root(text: Column) -> Column:
    """The node of a whole JSON payload."""
    kind = _kind(F.ltrim(text))
    plain = F.when(kind == "scalar", F.get_json_object(text, "$")).when(kind == "null", None).otherwise(text)
    return _node(kind, plain)


def _json_child(above: Column, parsed: Column, types: Column, step, owner: str) -> Column:
    """One step down from a node; ``parsed`` is its object or array as strings, ``types`` as variants."""
    kind = above["kind"]
    if isinstance(step, str):
        child = F.element_at(parsed, F.lit(step))
        typed = F.element_at(types, F.lit(step))
        found = F.map_contains_key(parsed, F.lit(step))
        missing = _failed("field_not_found", f"Field [{step}] not found")
        wrong = (F.when(kind == "null", _failed("null_object", f"Cannot retrieve field [{step}] from a null object"))
                 .when(kind == "scalar", _failed("scalar_object", f"Cannot retrieve field [{step}] from a scalar object"))
                 .when(kind == "array", _failed("array_object", f"Cannot retrieve field [{step}] from an array object")))
    else:
        child = F.get(parsed, step)
        typed = F.get(types, step)
        found = F.size(parsed) > step
        missing = _failed("index_out_of_bounds", f"Field not found at index [{step}]")
        wrong = (F.when(kind == "null", _failed("null_object", f"Cannot retrieve index [{step}] from a null object"))
                 .when(kind == "scalar", _failed("not_indexed", f"Field [{owner}] is not indexed"))
                 .when(kind == "object", _failed("non_array_object", f"Cannot retrieve index [{step}] from a non-array object")))
    # Text that looks like an object or array is one, unless its type says otherwise.
    looks = child.startswith("{") | child.startswith("[")
    named = F.create_map(F.lit("{"), F.lit("object"), F.lit("["), F.lit("array"))
    own = _node(F.when(child.isNull(), "null").when(~looks, "scalar").otherwise(F.coalesce(F.element_at(named, F.substring(F.coalesce(F.to_json(typed), child), 1, 1)), F.lit("scalar"))), child)
    return F.when(above["reason"].isNotNull(), above).otherwise(wrong.when(F.coalesce(found, F.lit(False)), own).otherwise(missing))


def fixed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with further columns that are worked out exactly once.

    A one-row generator: filters and joins above it are not pushed below, where they would repeat
    the columns' expressions, and projections above it don't unfold them.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))) if columns else df


class _Json:
    """Nodes of JSON roots, added to the frame one depth at a time."""

    def __init__(self, df: DataFrame, taken: str):
        self.df, self.taken, self.nodes, self.parsed, self.types = df, taken, {}, {}, {}
        self.order: list[tuple] = []

    def _name(self, key) -> str:
        self.order.append(key)
        return f"{self.taken}{len(self.order)}"

    def walk(self, roots: dict[str, Column], paths: list[Path]) -> None:
        layer = {}
        for root, text in roots.items():
            self.nodes[root, ()] = name = self._name(root)
            layer[name] = _json_root(text)
        self.df = fixed(self.df, layer)
        depth = 0
        while any(len(p.steps) + p.wildcard > depth for p in paths):
            parse_layer, step_layer = {}, {}
            for p in paths:
                if len(p.steps) + p.wildcard <= depth or (p.root, p.steps[:depth]) not in self.nodes:
                    continue
                at = (p.root, p.steps[:depth])
                above = F.col(self.nodes[at])
                ends = depth == len(p.steps)
                for form in ({"map", "list"} if ends else {"map" if isinstance(p.steps[depth], str) else "list"}):
                    if (*at, form) not in self.parsed:
                        kind, schema = ("object", STRINGS) if form == "map" else ("array", T.ArrayType(T.StringType()))
                        self.parsed[(*at, form)] = name = self._name((at, form))
                        parse_layer[name] = F.when(above["kind"] == kind, F.from_json(above["text"], schema))
                    if not ends and (*at, form) not in self.types:
                        # One typed parse for all children, where a string in the text may look like an object or array:
                        # its quote then stands right before the brace, bracket or escape.
                        kind, schema = ("object", T.MapType(T.StringType(), T.VariantType())) if form == "map" else ("array", T.ArrayType(T.VariantType()))
                        self.types[(*at, form)] = name = self._name((at, form, "types"))
                        alike = above["text"].contains('"{') | above["text"].contains('"[') | above["text"].contains('"\\u')
                        parse_layer[name] = F.when((above["kind"] == kind) & alike, F.from_json(above["text"], schema))
                if not ends and (p.root, p.steps[: depth + 1]) not in self.nodes:
                    owner = Path("", p.root, p.steps[:depth]).name
                    form = "map" if isinstance(p.steps[depth], str) else "list"
                    self.nodes[p.root, p.steps[: depth + 1]] = name = self._name((p.root, p.steps[: depth + 1]))
                    step_layer[name] = _json_child(above, F.col(self.parsed[(*at, form)]), F.col(self.types[(*at, form)]), p.steps[depth], owner)
            self.df = fixed(fixed(self.df, parse_layer), step_layer)
            depth += 1

    def node(self, p: Path) -> Column:
        return F.col(self.nodes[p.root, p.steps])

    def fields(self, p: Path) -> Column:
        """What the wildcard finds below the path's node."""
        objects, lists = (F.col(self.parsed[p.root, p.steps, form]) for form in ("map", "list"))
        return F.coalesce(objects, indexed(p.name, lists), F.create_map().cast(STRINGS))


def text_of(value: Column, kind: T.DataType) -> Column:
    """Text of a typed value: structs and arrays as JSON, maps as ``{k: v}``, bytes as a list."""
    if isinstance(kind, T.BinaryType):
        return byte_list_text(value)
    if isinstance(kind, T.TimestampType):
        return millis_text(value)
    if isinstance(kind, T.MapType):
        strings = F.transform_values(value, lambda k, v: text_of(v, kind.valueType))
        if not isinstance(kind.keyType, T.StringType):
            strings = F.map_from_entries(F.transform(F.map_entries(strings), lambda e: F.struct(e["key"].cast("string"), e["value"])))
        return map_text(strings)
    if isinstance(kind, (T.StructType, T.ArrayType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    return value.cast("string")


def _typed(value: Column, kind: T.DataType, p: Path, non_scalar: bool) -> Column:
    """A path over a typed column: what can be is decided while the plan is built."""
    failures, owner = [], p.root

    def fail(reason: str, message: str) -> Column:
        return F.struct(F.lit(reason).alias("reason"), F.lit(message).alias("message"))

    for step in p.steps:
        what = f"field [{step}]" if isinstance(step, str) else f"index [{step}]"
        failures.append(F.when(value.isNull(), fail("null_object", f"Cannot retrieve {what} from a null object")))
        if isinstance(step, str):
            if isinstance(kind, T.StructType) and step in kind.names:
                value, kind = value.getField(step), kind[step].dataType
            elif isinstance(kind, T.MapType):
                keys = F.transform(F.map_keys(value), lambda k: k.cast("string"))
                failures.append(F.when(~F.array_contains(keys, step), fail("field_not_found", f"Field [{step}] not found")))
                value, kind = F.element_at(value, F.lit(step).cast(kind.keyType)), kind.valueType
            elif isinstance(kind, T.StructType):
                failures.append(fail("field_not_found", f"Field [{step}] not found"))
                break
            elif isinstance(kind, T.ArrayType):
                failures.append(fail("array_object", f"Cannot retrieve field [{step}] from an array object"))
                break
            else:
                failures.append(fail("scalar_object", f"Cannot retrieve field [{step}] from a scalar object"))
                break
            owner = step
        elif isinstance(kind, T.ArrayType):
            failures.append(F.when(F.size(value) <= step, fail("index_out_of_bounds", f"Field not found at index [{step}]")))
            value, kind = F.get(value, step), kind.elementType
            owner += f"[{step}]"
        elif isinstance(kind, (T.StructType, T.MapType)):
            failures.append(fail("non_array_object", f"Cannot retrieve index [{step}] from a non-array object"))
            break
        else:
            failures.append(fail("not_indexed", f"Field [{owner}] is not indexed"))
            break
    else:
        if not non_scalar and not p.wildcard and isinstance(kind, (T.StructType, T.MapType, T.ArrayType)):
            failures.append(F.when(value.isNotNull(), fail("non_scalar", _complex(p))))
    failure = F.coalesce(*failures) if failures else F.lit(None).cast("struct<reason:string,message:string>")
    if p.wildcard:
        if isinstance(kind, T.StructType):
            names = F.array(*[F.lit(n) for n in kind.names])
            fields = F.map_from_arrays(names, F.array(*[text_of(value.getField(f.name), f.dataType) for f in kind.fields]))
        elif isinstance(kind, T.MapType):
            fields = F.map_from_entries(F.transform(F.map_entries(value), lambda e: F.struct(e["key"].cast("string"), text_of(e["value"], kind.valueType))))
        elif isinstance(kind, T.ArrayType):
            fields = indexed(p.name, F.transform(value, lambda e: text_of(e, kind.elementType)))
        else:
            fields = F.create_map().cast(STRINGS)
        fields = F.coalesce(F.when(value.isNotNull(), fields), F.create_map().cast(STRINGS))
        return F.struct(failure.isNull().alias("ok"), F.when(failure.isNull(), fields).alias("fields"), failure["reason"].alias("reason"), failure["message"].alias("message"))
    # A whole payload of bytes reads as hexadecimal digits, bytes within a value as a list.
    shown = F.hex(value) if isinstance(kind, T.BinaryType) and not p.steps else text_of(value, kind)
    return F.struct(failure.isNull().alias("ok"), F.when(failure.isNull(), shown).alias("text"), failure["reason"].alias("reason"), failure["message"].alias("message"))


def _complex(p: Path) -> str:
    return f"The expression [{p.expression}] must evaluate to a non-complex object"


def _headers(p: Path, non_scalar: bool) -> Column:
    """Paths over ``headers``: an array of struct(key, value) whose keys may repeat."""
    headers = F.coalesce("headers", F.array().cast("array<struct<key:string,value:binary>>"))

    def result(failure: Column | None, text: Column, name: str = "text") -> Column:
        failure = F.lit(None).cast("struct<reason:string,message:string>") if failure is None else failure
        return F.struct(failure.isNull().alias("ok"), F.when(failure.isNull(), text).alias(name), failure["reason"].alias("reason"), failure["message"].alias("message"))

    def fail(reason: str, message: str) -> Column:
        return F.struct(F.lit(reason).alias("reason"), F.lit(message).alias("message"))

    def texts(of: Column) -> Column:
        return F.transform(of, lambda h: utf8_text(h["value"]))

    steps = list(p.steps)
    if p.wildcard and not steps:
        keys = F.transform(headers, lambda h: h["key"])

        def entry(h: Column, i: Column) -> Column:
            same = F.size(F.filter(keys, lambda k: k == h["key"]))
            before = F.size(F.filter(F.slice(keys, 1, i), lambda k: k == h["key"]))
            name = F.when(same > 1, F.concat(h["key"], F.lit("["), before.cast("string"), F.lit("]"))).otherwise(h["key"])
            return F.struct(name, utf8_text(h["value"]))

        return result(None, F.map_from_entries(F.transform(headers, entry)), "fields")
    if not steps:
        pairs = F.transform(headers, lambda h: F.concat(h["key"], F.lit("="), utf8_text(h["value"])))
        whole = F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))
        return result(None if non_scalar else fail("non_scalar", _complex(p)), whole)
    first, rest = steps[0], steps[1:]
    if isinstance(first, int):
        items, owner = F.slice(headers, first + 1, 1), f"HEADERS[{first}]"
        failure = F.when(F.size(headers) <= first, fail("index_out_of_bounds", f"Field not found at index [{first}]"))
        single = F.lit(True)
    else:
        items, owner = F.filter(headers, lambda h: h["key"] == first), first
        failure = F.when(F.size(items) == 0, fail("field_not_found", f"Field [{first}] not found"))
        single = F.size(items) == 1
    text, one = texts(items), F.get(texts(items), 0)
    for step in rest:
        if isinstance(step, int):
            failure = F.coalesce(failure, F.when(single, fail("not_indexed", f"Field [{owner}] is not indexed")),
                                 F.when(F.size(text) <= step, fail("index_out_of_bounds", f"Field not found at index [{step}]")))
            one, single, owner = F.get(text, step), F.lit(True), f"{owner}[{step}]"
        else:
            failure = F.coalesce(failure, F.when(single, fail("scalar_object", f"Cannot retrieve field [{step}] from a scalar object")),
                                 fail("array_object", f"Cannot retrieve field [{step}] from an array object"))
    if p.wildcard:
        fields = F.when(single, F.create_map().cast(STRINGS)).otherwise(indexed(owner, text))
        return result(failure, fields, "fields")
    if non_scalar:
        shown = F.when(single, one).otherwise(F.concat(F.lit("["), F.array_join(text, ", "), F.lit("]")))
        return result(failure, shown)
    return result(F.coalesce(failure, F.when(~single, fail("non_scalar", _complex(p)))), one)


@dataclass(frozen=True)
class Formats:
    """How keys and values are encoded, with the decoders' options."""

    key: str = "STRING"
    value: str = "JSON"
    key_options: tuple = ()
    value_options: tuple = ()


def unused(df: DataFrame, stem: str) -> str:
    """``stem`` with as many underscores before it as no column of ``df`` begins with, whatever the case."""
    while any(c.lower().startswith(stem.lower()) for c in df.columns):
        stem = "_" + stem
    return stem


def extract(df: DataFrame, paths: dict[str, Path], formats: Formats = Formats(), non_scalar: bool = False) -> DataFrame:
    """``df`` (an envelope) with one result column for each path."""
    taken = "_x"
    while any(c.startswith(taken) for c in df.columns):
        taken += "x"
    columns, kept = list(df.columns), df
    none = F.lit(None).cast("string")
    roots, payloads = {}, {}
    for root, column, fmt, options in (("KEY", "key", formats.key, formats.key_options), ("VALUE", "value", formats.value, formats.value_options)):
        if any(p.root == root for p in paths.values()):
            decoded = decode(F.col(column), fmt, **dict(options)) if not isinstance(df.schema[column].dataType, (T.StructType, T.MapType, T.ArrayType)) else F.col(column)
            payloads[root] = name = f"{taken}_{column}"
            kept = fixed(kept, {name: decoded})
            if fmt.upper() == "JSON" and isinstance(kept.schema[name].dataType, T.StringType):
                roots[root] = F.col(name)
    tree = _Json(kept, taken)
    tree.walk(roots, [p for p in paths.values() if p.root in roots])
    results = {}
    for name, p in paths.items():
        if p.root in CONSTANTS:
            value = {"TOPIC": F.col("topic"), "PARTITION": F.col("partition").cast("string"), "OFFSET": F.col("offset").cast("string"), "TIMESTAMP": millis_text(F.col("timestamp"))}[p.root]
            results[name] = F.struct(F.lit(True).alias("ok"), value.alias("text"), none.alias("reason"), none.alias("message"))
        elif p.root == "HEADERS":
            results[name] = _headers(p, non_scalar)
        elif p.root in roots:
            node = tree.node(p)
            if p.wildcard:
                results[name] = F.struct(node["reason"].isNull().alias("ok"), F.when(node["reason"].isNull(), tree.fields(p)).alias("fields"), node["reason"].alias("reason"), node["message"].alias("message"))
            else:
                complex_ = node["kind"].isin("object", "array") if not non_scalar else F.lit(False)
                bad = F.coalesce(complex_, F.lit(False))
                reason = F.coalesce(node["reason"], F.when(bad, F.lit("non_scalar")))
                results[name] = F.struct(reason.isNull().alias("ok"), F.when(reason.isNull(), node["text"]).alias("text"), reason.alias("reason"), F.coalesce(node["message"], F.when(bad, F.lit(_complex(p)))).alias("message"))
        else:
            results[name] = _typed(F.col(payloads[p.root]), tree.df.schema[payloads[p.root]].dataType, p, non_scalar)
    return fixed(tree.df.drop(*results), results).select(*[F.col(f"`{c}`") for c in columns if c not in results], *results)
