"""Decoding record keys and values: bytes of a format -> a column the path functions step into."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import last_wins, split_pair, split_trimmed, utf8_text

FORMATS = ("AVRO", "JSON", "PROTOBUF", "KVP", "STRING", "INTEGER", "BOOLEAN", "BYTE_ARRAY", "BYTE_BUFFER", "BYTES", "DOUBLE", "FLOAT", "LONG", "SHORT", "UUID", "STRUCT")
#: Formats whose empty payload is null.
STRUCTURED = ("AVRO", "JSON", "PROTOBUF", "KVP")

_custom: dict[str, Callable[[Column], Column]] = {}


def register_format(name: str, decoder: Callable[[Column], Column]) -> None:
    """Add a record format of the user's own: a function from the payload column to a column."""
    _custom[name.upper()] = decoder


def _fixed(value: Column, size: int, result: Column, what: str) -> Column:
    """``result`` where the payload has so many bytes; any other length is a decode failure."""
    wrong = F.raise_error(F.concat(F.lit(f"{what} needs {size} bytes, found "), F.octet_length(value).cast("string")))
    return F.when(value.isNull(), None).when(F.octet_length(value) == size, result).otherwise(wrong)


def _signed(value: Column, bits: int) -> Column:
    if bits == 64:
        return F.conv(F.hex(value), 16, -10).cast("bigint")
    number = F.conv(F.hex(value), 16, 10).cast("bigint")
    return F.when(number >= 1 << (bits - 1), number - (1 << bits)).otherwise(number)


def _ieee(value: Column, exponent_bits: int, mantissa_bits: int) -> Column:
    """A big-endian IEEE-754 number as a double; every step is exact."""
    digits = F.hex(value)
    half = F.conv(F.substring(digits, 1, 8), 16, 10).cast("bigint")  # the first 32 bits
    rest = mantissa_bits - (31 - exponent_bits)  # mantissa bits that follow them
    low = F.conv(F.substring(digits, 9, 8), 16, 10).cast("bigint") if rest else F.lit(0).cast("bigint")
    top = (half % (1 << (31 - exponent_bits))).cast("bigint")
    mantissa = (top * F.lit(1 << rest) + low).cast("double")
    exponent = F.floor(half / (1 << (31 - exponent_bits))).cast("bigint") % (1 << exponent_bits)
    bias, most = (1 << (exponent_bits - 1)) - 1, (1 << exponent_bits) - 1
    special = F.when(mantissa == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    small = mantissa * F.lit(2.0 ** (1 - bias - mantissa_bits))
    usual = (mantissa * F.lit(2.0**-mantissa_bits) + 1) * F.pow(F.lit(2.0), (exponent - bias).cast("double"))
    size = F.when(exponent == most, special).when(exponent == 0, small).otherwise(usual)
    return F.when(half >= 1 << 31, -size).otherwise(size)


def kvp(value: Column, pair_separator: str = ",", key_value_separator: str = "=") -> Column:
    """Map of ``k=v,k=v`` text; a missing value is empty, tokens with more parts or a blank key are
    dropped, the last of equal keys wins, blank text is null."""
    text = utf8_text(value)
    pairs = F.filter(F.transform(split_trimmed(text, pair_separator), lambda t: split_pair(t, key_value_separator)), lambda p: p.isNotNull())
    return F.when(F.trim(text) != "", last_wins(pairs))


def decode(value: Column, fmt: str, **options) -> Column:
    """The payload column decoded by format.

    JSON stays text (empty is null); KVP takes ``pair_separator`` and ``key_value_separator``;
    AVRO takes ``schema`` (JSON text); PROTOBUF takes ``message`` and ``descriptor`` (a file's
    path) or ``descriptor_bytes``; STRUCT is already decoded. A wrong length is a decode failure.
    """
    fmt = fmt.upper()
    if fmt in _custom:
        return _custom[fmt](value)
    if fmt == "STRUCT":
        return value
    if fmt == "JSON":
        text = utf8_text(value)
        return F.when(F.trim(text) != "", text)
    if fmt == "KVP":
        return kvp(value, options.get("pair_separator", ","), options.get("key_value_separator", "="))
    if fmt == "STRING":
        return utf8_text(value)
    if fmt in ("INTEGER", "LONG", "SHORT"):
        bits, to = {"INTEGER": (32, "int"), "LONG": (64, "bigint"), "SHORT": (16, "smallint")}[fmt]
        return _fixed(value, bits // 8, _signed(value, bits), fmt).cast(to)
    if fmt == "DOUBLE":
        return _fixed(value, 8, _ieee(value, 11, 52), fmt)
    if fmt == "FLOAT":
        return _fixed(value, 4, _ieee(value, 8, 23), fmt).cast("float")
    if fmt == "BOOLEAN":
        return F.when(value.isNull(), None).when(F.hex(value).isin("00", "01"), F.hex(value) == "01").otherwise(F.raise_error(F.lit("BOOLEAN needs one byte, 0 or 1")))
    if fmt in ("BYTE_ARRAY", "BYTE_BUFFER", "BYTES"):
        return value
    if fmt == "UUID":
        text = F.lower(utf8_text(value))
        good = text.rlike("^[0-9a-f]{1,8}(-[0-9a-f]{1,4}){3}-[0-9a-f]{1,12}$")
        return F.when(value.isNull(), None).when(good, text).otherwise(F.raise_error(F.concat(F.lit("no UUID: "), text)))
    if fmt == "AVRO":
        from pyspark.sql.avro.functions import from_avro  # needs spark-avro on the class path

        return from_avro(F.when(F.octet_length(value) > 0, value), options["schema"])
    if fmt == "PROTOBUF":
        from pyspark.sql.protobuf.functions import from_protobuf  # needs spark-protobuf on the class path

        return from_protobuf(F.when(F.octet_length(value) > 0, value), options["message"], options.get("descriptor"), binaryDescriptorSet=options.get("descriptor_bytes"))
    raise ValueError(f"unknown format {fmt}")


def is_tombstone(value: Column, fmt: str = "JSON") -> Column:
    """No payload: null, or empty for structured formats."""
    return value.isNull() | (F.octet_length(value) == 0) if fmt.upper() in STRUCTURED else value.isNull()


_JSON_TYPES = {"string": r'^"', "object": r"^\{", "array": r"^\[", "integer": r"^-?\d+(\.0+)?$", "number": r"^-?\d", "boolean": "^(true|false)$", "null": "^null$"}
_NOTES = {"$schema", "$id", "title", "description"}
_BOUNDS = {
    "minimum": ("number", lambda x, bound: x >= bound), "maximum": ("number", lambda x, bound: x <= bound),
    "exclusiveMinimum": ("number", lambda x, bound: x > bound), "exclusiveMaximum": ("number", lambda x, bound: x < bound),
    "minLength": ("string", lambda x, bound: F.char_length(x) >= bound), "maxLength": ("string", lambda x, bound: F.char_length(x) <= bound),
    "pattern": ("string", lambda x, bound: x.rlike(bound)),
    "minItems": ("array", lambda x, bound: F.array_size(x) >= bound), "maxItems": ("array", lambda x, bound: F.array_size(x) <= bound),
}
_KEYWORDS = {"type", "enum", "properties", "required", "additionalProperties", "items", *_BOUNDS, *_NOTES}


def _equals(value: Column, raw: Column, wanted) -> Column:
    """Whether a variant (``raw``: as JSON) is one given value of an ``enum``."""
    if wanted is None or isinstance(wanted, bool):
        return raw == {None: "null", True: "true", False: "false"}[wanted]
    if isinstance(wanted, str):
        return raw.rlike(_JSON_TYPES["string"]) & (F.try_variant_get(value, "$", "string") == wanted)
    if isinstance(wanted, (int, float)):
        return raw.rlike(_JSON_TYPES["number"]) & (F.try_variant_get(value, "$", "double") == float(wanted))
    raise ValueError(f"enum value {wanted!r} isn't supported")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _first(checks: list[Column]) -> Column:
    return F.coalesce(F.lit(None).cast("string"), *checks)


def _value_reason(value: Column, rule: dict, name: str) -> Column:
    """Why a variant breaks a rule (null: it doesn't). Bounds hold for values of their type only."""
    if set(rule) - _KEYWORDS:
        raise ValueError(f"schema keywords of {name} that aren't supported: {sorted(set(rule) - _KEYWORDS)}")
    kinds = [rule["type"]] if isinstance(rule.get("type"), str) else rule.get("type", [])
    if set(kinds) - set(_JSON_TYPES):
        raise ValueError(f"type {rule['type']} of {name} isn't supported")

    def checked(v: Column, raw: Column) -> Column:
        checks = []
        if kinds:
            fits = F.coalesce(raw.rlike("|".join(_JSON_TYPES[k] for k in kinds)), F.lit(False))
            checks.append(F.when(~fits, F.lit(f"type: {name}")))
        if "enum" in rule:
            one = F.lit(False)
            for wanted in rule["enum"]:
                one = one | F.coalesce(_equals(v, raw, wanted), F.lit(False))
            checks.append(F.when(~one, F.lit(f"enum: {name}")))
        for kind, to in (("number", "double"), ("string", "string"), ("array", "array<variant>"), ("object", "map<string,variant>")):
            def within(x: Column, kind=kind) -> list[Column]:
                some = [F.when(~holds(x, rule[keyword]), F.lit(f"{keyword}: {name}")) for keyword, (of, holds) in _BOUNDS.items() if of == kind and keyword in rule]
                if kind == "array" and rule.get("items"):
                    some.append(F.get(F.filter(F.transform(x, lambda item: _value_reason(item, rule["items"], f"{name}[]")), lambda r: r.isNotNull()), 0))
                return some + (_member_checks(x, rule, f"{name}.") if kind == "object" else [])

            if within(F.lit(None)):
                checks.append(F.when(raw.rlike(_JSON_TYPES[kind]), _let(F.try_variant_get(v, "$", to), lambda x: _first(within(x)))))
        return _first(checks)

    return _let(value, lambda v: _let(F.to_json(v), lambda raw: checked(v, raw)))


def _member_checks(members: Column, rule: dict, owner: str) -> list[Column]:
    """Why the members of an object (a map of variants) break a rule: a column a check."""
    more = rule.get("additionalProperties", True)
    if not isinstance(more, bool):
        raise ValueError("additionalProperties by a schema isn't supported")
    checks = [F.when(~F.map_contains_key(members, F.lit(n)), F.lit(f"required: {owner}{n}")) for n in rule.get("required", [])]
    for n, inner in rule.get("properties", {}).items():
        checks.append(F.when(F.map_contains_key(members, F.lit(n)), _value_reason(F.element_at(members, F.lit(n)), inner, f"{owner}{n}")))
    if more is False:
        others = F.array_except(F.map_keys(members), F.array(*[F.lit(n) for n in rule.get("properties", {})]).cast("array<string>"))
        checks.append(F.when(F.array_size(others) > 0, F.concat(F.lit(f"additional: {owner}"), F.get(others, 0))))
    return checks


def json_schema_violation(text: Column, schema: dict) -> Column:
    """Why a JSON object breaks a schema (null: it doesn't), with the place: ``type: lines[].part``.

    Understood at any depth: ``type`` (one or several), ``enum`` of plain values, ``properties``,
    ``required``, ``additionalProperties`` true or false, ``items`` by one schema, and bounds of
    numbers, lengths and patterns of strings, and sizes of arrays. Other keywords are refused while
    the plan is built. The whole payload must be an object.
    """
    if set(schema) - _KEYWORDS or schema.get("type", "object") != "object":
        raise ValueError(f"schema keywords that aren't supported: {sorted(set(schema) - _KEYWORDS) or schema['type']}")
    return F.when(text.isNotNull(), _let(F.from_json(text, T.MapType(T.StringType(), T.VariantType())),
                                         lambda members: _first([F.when(members.isNull(), F.lit("not an object")), *_member_checks(members, schema, "")])))


def decode_failure(df: DataFrame, sides: dict[str, str], schemas: dict[str, dict] | None = None) -> Column:
    """Why a record can't be decoded (null: it can). ``sides``: payload column -> format."""
    reasons = [F.lit(None).cast("string")]
    for column, fmt in sides.items():
        value, fmt = F.col(column), fmt.upper()
        if fmt == "JSON":
            text = decode(value, "JSON")
            reasons.append(F.when(text.isNotNull() & F.try_parse_json(text).isNull() & F.from_json(text, T.MapType(T.StringType(), T.StringType())).isNull(), F.lit(f"{column}: malformed JSON")))
            if schemas and column in schemas:
                reasons.append(F.concat(F.lit(f"{column}: "), json_schema_violation(text, schemas[column])))
        sizes = {"INTEGER": 4, "LONG": 8, "SHORT": 2, "DOUBLE": 8, "FLOAT": 4, "BOOLEAN": 1}
        if fmt in sizes:
            reasons.append(F.when(F.octet_length(value) != sizes[fmt], F.lit(f"{column}: {fmt} needs {sizes[fmt]} bytes")))
    return F.coalesce(*reasons)


def split_decodable(df: DataFrame, sides: dict[str, str], on_decode_error: str = "fail", schemas: dict[str, dict] | None = None) -> tuple[DataFrame, DataFrame]:
    """Records that decode, and those that don't with ``stage`` and ``message``.

    A decode error is fatal by default; ``on_decode_error="dead_letter"`` hands such records back.
    """
    if on_decode_error not in ("fail", "dead_letter"):
        raise ValueError(f"unknown policy {on_decode_error}")
    reason = decode_failure(df, sides, schemas)
    name = "_decode_failure"
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    marked, why = df.withColumn(name, reason), F.col(name)
    if on_decode_error == "fail":
        checked = marked.where(F.when(why.isNotNull(), F.raise_error(why).cast("boolean")).otherwise(F.lit(True)))
        return checked.drop(name), marked.where(F.lit(False)).select(*df.columns, F.lit("decode").alias("stage"), why.alias("message"))
    bad = marked.where(why.isNotNull()).select(*df.columns, F.lit("decode").alias("stage"), why.alias("message"))
    return marked.where(why.isNull()).drop(name), bad
