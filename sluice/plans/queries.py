"""Registered queries over the given tables, each with its SQL equivalent where there is one.

``@query(name, sql)`` registers a function (spark, sf_dir) -> DataFrame; names start with the
operators they show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import decode as D
from ..functions import text as X
from ..functions.paths import Formats
from ..operators import command as C
from ..operators import errors as E
from ..operators import hooks as J
from ..operators import metrics as H
from ..operators import ordering as G
from ..operators import routing as R
from ..operators.fields import discover, map_fields, select_fields
from ..sources.envelope import as_envelope, read_structured
from ..streaming.kept import KeptBoard, LiveSubscriptions, scratch_folder
from .pipeline import Spec, process

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_times(df: DataFrame, *names: str) -> DataFrame:
    """Time columns without a zone, as the tables have them."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


# -- records made of the tables ------------------------------------------------------------------


def event_records(spark: SparkSession, sf_dir: str, value: Column | None = None, headers: Column | None = None) -> DataFrame:
    """Topic ``events``: key user_id, JSON value with nested props, offset event_id."""
    e = load(spark, sf_dir, "events").withColumn("props", F.from_json("props", "struct<k:bigint>"))
    body = F.to_json(F.struct("event_id", "user_id", "event_type", "value", "props")) if value is None else value
    return as_envelope(e, "events", F.col("user_id"), body, F.col("user_id") % 4, F.col("event_id"), F.col("ts"), headers)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the array of their lines, in order of line number, part and supplier."""
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("lines"))
    return load(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


def order_value() -> Column:
    return F.struct("o_orderkey", "o_custkey", "o_orderstatus", "lines", F.struct("o_orderpriority", "o_custkey").alias("info"))


def order_records(spark: SparkSession, sf_dir: str, structured: bool = False) -> DataFrame:
    """Topics ``orders_<status>``: key o_orderkey, value with an array of lines."""
    o = order_lines(spark, sf_dir)
    topic = F.concat(F.lit("orders_"), F.col("o_orderstatus"))
    rest = {"partition": F.col("o_custkey") % 3, "offset": F.col("o_orderkey"), "timestamp": F.col("o_orderdate")}
    if structured:
        return read_structured(o, topic, F.col("o_orderkey"), order_value(), **rest)
    return as_envelope(o, topic, F.col("o_orderkey"), F.to_json(order_value(), {"ignoreNullFields": "false"}), **rest)


EVENT_HEADERS = "array(struct('type' as key, cast(event_type as binary) as value), struct('id' as key, cast(cast(event_id as string) as binary) as value), struct('type' as key, cast(cast(user_id as string) as binary) as value))"

_LINES = """WITH l AS (SELECT l_orderkey, list({'n': l_linenumber, 'p': l_partkey, 's': l_suppkey} ORDER BY l_linenumber, l_partkey, l_suppkey) AS lines FROM lineitem GROUP BY 1),
o AS (SELECT orders.*, lines FROM orders LEFT JOIN l ON o_orderkey = l_orderkey)
"""


def fields_as(df: DataFrame, *names: str, keep: tuple[str, ...] = ("offset",)) -> DataFrame:
    """The map's entries as plain columns."""
    return df.select(*keep, *[F.col("fields")[n].alias(n) for n in names])


# -- envelope and decoding -----------------------------------------------------------------------


@query("a5_envelope", """SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset", epoch_us(ts) // 1000 AS ts_ms,
CAST(user_id AS VARCHAR) AS key_text, user_id % 4 AS p_text FROM events""")
def a5_envelope(spark, sf_dir):
    r = event_records(spark, sf_dir)
    return r.select("topic", "partition", "offset", F.unix_millis("timestamp").alias("ts_ms"), F.col("key").cast("string").alias("key_text"), F.col("partition").cast("bigint").alias("p_text"))


@query("a6_structured", _LINES + """SELECT o_orderkey AS "offset", o_orderstatus AS status, CAST(lines[1].p AS VARCHAR) AS first_part,
o_orderpriority AS priority FROM o WHERE lines IS NOT NULL""")
def a6_structured(spark, sf_dir):
    out = map_fields(order_records(spark, sf_dir, True), {"status": "#{VALUE.o_orderstatus}", "first_part": "#{VALUE.lines[0].l_partkey}", "priority": "#{VALUE['info'].o_orderpriority}"})
    return fields_as(E.succeeded(out), "status", "first_part", "priority")


@query("b2_json_schema", """SELECT event_id AS "offset", CASE WHEN event_type NOT IN ('click', 'view', 'signup') THEN 'enum: event_type' END AS violation FROM events""")
def b2_json_schema(spark, sf_dir):
    schema = {"type": "object", "required": ["event_id", "event_type"], "additionalProperties": False,
              "properties": {"event_id": {"type": "integer"}, "user_id": {"type": "integer"}, "event_type": {"type": "string", "enum": ["click", "view", "signup"]},
                             "value": {"type": "number"}, "props": {"type": "object"}}}
    return event_records(spark, sf_dir).select("offset", D.json_schema_violation(D.decode(F.col("value"), "JSON"), schema).alias("violation"))


@query("b2_nested_schema", _LINES + """SELECT o_orderkey AS "offset", CASE WHEN lines IS NULL THEN 'type: lines' WHEN len(lines) > 5 THEN 'maxItems: lines'
WHEN len(list_filter(lines, lambda x: x.p > 1500)) > 0 THEN 'maximum: lines[].l_partkey' WHEN o_orderpriority LIKE '5%' THEN 'pattern: info.o_orderpriority' END AS violation FROM o""")
def b2_nested_schema(spark, sf_dir):
    line = {"type": "object", "required": ["l_partkey"], "properties": {"l_partkey": {"type": "integer", "maximum": 1500}, "l_linenumber": {"minimum": 1}, "l_suppkey": {"type": ["integer", "null"]}}, "additionalProperties": False}
    schema = {"required": ["o_orderkey"], "properties": {"lines": {"type": "array", "minItems": 1, "maxItems": 5, "items": line},
                                                         "info": {"type": "object", "properties": {"o_orderpriority": {"type": "string", "minLength": 3, "pattern": "^[1-4]-"}}}}}
    return order_records(spark, sf_dir).select("offset", D.json_schema_violation(D.decode(F.col("value"), "JSON"), schema).alias("violation"))


@query("b5_kvp", """SELECT event_id, event_type AS t, CAST(user_id AS VARCHAR) AS u, '' AS novalue, '2' AS dup, 4 AS n FROM events""")
def b5_kvp(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    raw = F.concat(F.lit("dup=1, t = "), "event_type", F.lit(" ,u="), F.col("user_id").cast("string"), F.lit(",a=b=c,=x,NOVALUE,dup=2"))
    m = F.col("m")
    return e.select("event_id", D.decode(raw.cast("binary"), "KVP").alias("m")).select("event_id", m["t"].alias("t"), m["u"].alias("u"), m["NOVALUE"].alias("novalue"), m["dup"].alias("dup"), F.size("m").cast("bigint").alias("n"))


@query("b6_b11_scalars", """SELECT event_id, event_type AS s, CAST(event_id AS INTEGER) AS i, event_id AS l, CAST(event_id % 30000 AS SMALLINT) AS h, user_id % 2 = 1 AS b,
'00000000-0000-0000-0000-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS u FROM events""")
def b6_b11_scalars(spark, sf_dir):
    e = load(spark, sf_dir, "events")

    def big_endian(value: Column, size: int) -> Column:
        return F.unhex(F.lpad(F.hex(value), 2 * size, "0"))

    return e.select("event_id", D.decode(F.col("event_type").cast("binary"), "STRING").alias("s"), D.decode(big_endian(F.col("event_id"), 4), "INTEGER").alias("i"),
                    D.decode(big_endian(F.col("event_id"), 8), "LONG").alias("l"), D.decode(big_endian(F.col("event_id") % 30000, 2), "SHORT").alias("h"),
                    D.decode(big_endian(F.col("user_id") % 2, 1), "BOOLEAN").alias("b"),
                    D.decode(F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(F.col("event_id").cast("string"), 12, "0")).cast("binary"), "UUID").alias("u"))


@query("b8_floating", "SELECT event_id, 1 + event_id * pow(2.0, -52) AS d, CAST(1 + event_id * pow(2.0, -23) AS FLOAT) AS f FROM events")
def b8_floating(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    bits = F.unhex(F.lpad(F.hex(F.col("event_id") + F.lit(4607182418800017408)), 16, "0"))
    return e.select("event_id", D.decode(bits, "DOUBLE").alias("d"), D.decode(F.unhex(F.lpad(F.hex(F.col("event_id") + F.lit(1065353216)), 8, "0")), "FLOAT").alias("f"))


@query("b12_tombstone", """SELECT event_type, count(*) AS n, count(*) FILTER (event_type = 'error') AS tombstones FROM events GROUP BY 1""")
def b12_tombstone(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    value = F.when(F.col("event_type") != "error", F.lit("{}")).otherwise("").cast("binary")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(D.is_tombstone(value, "JSON")).alias("tombstones"))


@query("b13_decode_failures", """SELECT event_id AS "offset", 'decode' AS stage, 'value: malformed JSON' AS message FROM events WHERE event_type = 'error'""")
def b13_decode_failures(spark, sf_dir):
    body = F.when(F.col("event_type") == "error", F.lit("{not json")).otherwise(F.to_json(F.struct("event_id")))
    bad = D.split_decodable(event_records(spark, sf_dir, body), {"value": "JSON"}, "dead_letter")[1]
    return bad.select("offset", "stage", "message")


# -- paths and fields ----------------------------------------------------------------------------


@query("c1_constants", """SELECT event_id AS "offset", 'events' AS topic, CAST(user_id % 4 AS VARCHAR) AS p, CAST(event_id AS VARCHAR) AS o, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS t FROM events""")
def c1_constants(spark, sf_dir):
    out = map_fields(event_records(spark, sf_dir), {"topic": "#{TOPIC}", "p": "#{PARTITION}", "o": "#{OFFSET}", "t": "#{TIMESTAMP}"})
    return fields_as(out, "topic", "p", "o", "t")


@query("c3_c6_navigation", _LINES + """SELECT o_orderkey AS "offset", o_orderpriority AS priority, CAST(lines[1].s AS VARCHAR) AS s0, CAST(lines[2].p AS VARCHAR) AS p1
FROM o WHERE len(lines) >= 2""")
def c3_c6_navigation(spark, sf_dir):
    out = map_fields(order_records(spark, sf_dir), {"priority": "#{VALUE.info['o_orderpriority']}", "s0": "#{VALUE.lines[0].l_suppkey}", "p1": "#{VALUE['lines'][1]['l_partkey']}"})
    return fields_as(E.succeeded(out), "priority", "s0", "p1")


@query("c7_c10_other_formats", """SELECT event_id AS "offset", event_type AS t, CAST(user_id AS VARCHAR) AS u FROM events""")
def c7_c10_other_formats(spark, sf_dir):
    body = F.concat(F.lit("t="), "event_type", F.lit(",u="), F.col("user_id").cast("string"))
    out = map_fields(event_records(spark, sf_dir, body), {"t": "#{VALUE.t}", "u": "#{VALUE['u']}"}, formats=Formats(value="KVP"))
    return fields_as(E.succeeded(out), "t", "u")


@query("c7_c8_typed_values", """SELECT event_id AS "offset", event_type AS kind, '[' || list_aggregate(list_transform(string_split(event_type, ''), lambda c: CAST(ascii(c) AS VARCHAR)), 'string_agg', ', ') || ']' AS fixed,
'n' || user_id AS numbered, CAST(event_id % 7 AS VARCHAR) AS second, CAST(user_id % 2 = 1 AS VARCHAR) AS flag, 'b' || event_type AS by_flag FROM events""")
def c7_c8_typed_values(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    value = F.struct(
        F.col("event_type").alias("kind"), F.col("event_type").cast("binary").alias("fixed"), F.create_map(F.lit(7), F.concat(F.lit("n"), F.col("user_id").cast("string"))).alias("numbered"),
        F.array(F.struct(F.lit(0).cast("long").alias("v")), F.struct((F.col("event_id") % 7).alias("v"))).alias("lines"), (F.col("user_id") % 2 == 1).alias("flag"),
        F.create_map(F.lit(True), F.concat(F.lit("b"), "event_type")).alias("by_flag"))
    records = read_structured(e, F.lit("events"), F.col("user_id"), value, partition=F.lit(0), offset=F.col("event_id"), timestamp=F.col("ts"))
    paths = {"kind": "#{VALUE.kind}", "fixed": "#{VALUE.fixed}", "numbered": "#{VALUE.numbered['7']}", "second": "#{VALUE.lines[1].v}", "flag": "#{VALUE.flag}", "by_flag": "#{VALUE.by_flag['true']}"}
    return fields_as(E.succeeded(map_fields(records, paths, formats=Formats(value="STRUCT"))), *paths)


@query("c11_c13_headers", """SELECT event_id AS "offset", CAST(event_id AS VARCHAR) AS id, event_type AS first_type, CAST(user_id AS VARCHAR) AS second_type, CAST(event_id AS VARCHAR) AS at1 FROM events""")
def c11_c13_headers(spark, sf_dir):
    out = map_fields(event_records(spark, sf_dir, headers=F.expr(EVENT_HEADERS)), {"id": "#{HEADERS.id}", "first_type": "#{HEADERS.type[0]}", "second_type": "#{HEADERS['type'][1]}", "at1": "#{HEADERS[1]}"})
    return fields_as(E.succeeded(out), "id", "first_type", "second_type", "at1")


@query("c14_c15_non_scalar", """SELECT event_id AS "offset", 'non_scalar' AS reason, props AS raw FROM (SELECT event_id, '{"k":' || regexp_extract(props, '-?[0-9]+') || '}' AS props FROM events)""")
def c14_c15_non_scalar(spark, sf_dir):
    r = event_records(spark, sf_dir)
    strict = map_fields(r, {"p": "#{VALUE.props}"}).select("offset", F.col("failure.reason").alias("reason"))
    loose = map_fields(r, {"raw": "#{VALUE.props}"}, map_non_scalar=True)
    return strict.join(fields_as(loose, "raw"), "offset")


@query("c16_map_fields", """SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS usr, CAST(value AS VARCHAR) AS amount, regexp_extract(props, '-?[0-9]+') AS k FROM events""")
def c16_map_fields(spark, sf_dir):
    out = map_fields(event_records(spark, sf_dir), {"usr": "#{KEY}", "amount": "#{VALUE.value}", "k": "#{VALUE.props.k}"})
    return fields_as(E.succeeded(out), "usr", "amount", "k")


@query("c17_skip_failed", _LINES + """SELECT o_orderkey AS "offset", CAST(lines[3].p AS VARCHAR) AS third, o_orderstatus AS status, CASE WHEN len(lines) >= 3 THEN 2 ELSE 1 END AS n FROM o""")
def c17_skip_failed(spark, sf_dir):
    out = map_fields(order_records(spark, sf_dir), {"third": "#{VALUE.lines[2].l_partkey}", "status": "#{VALUE.o_orderstatus}"}, skip_failed=True)
    return fields_as(out.withColumn("n", F.size("fields")), "third", "status", keep=("offset", "n"))


@query("c18_discover", """SELECT event_id AS "offset", unnest(['event_id', 'user_id', 'event_type', 'value', 'props']) AS name,
unnest([CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type, CAST(value AS VARCHAR), '{"k":' || regexp_extract(props, '-?[0-9]+') || '}']) AS text FROM events""")
def c18_discover(spark, sf_dir):
    return discover(event_records(spark, sf_dir), "#{VALUE.*}").select("offset", F.explode("fields").alias("name", "text"))


@query("c19_array_wildcard", _LINES + """SELECT o_orderkey AS "offset", 'lines[' || (i - 1) || ']' AS name,
'{"l_linenumber":' || lines[i].n || ',"l_partkey":' || lines[i].p || ',"l_suppkey":' || lines[i].s || '}' AS text FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM o WHERE lines IS NOT NULL)""")
def c19_array_wildcard(spark, sf_dir):
    return discover(order_records(spark, sf_dir), "#{VALUE.lines.*}").select("offset", F.explode("fields").alias("name", "text"))


@query("c20_nested_wildcard", """SELECT o_orderkey AS "offset", unnest(['o_orderpriority', 'o_custkey']) AS name, unnest([o_orderpriority, CAST(o_custkey AS VARCHAR)]) AS text FROM orders""")
def c20_nested_wildcard(spark, sf_dir):
    return discover(order_records(spark, sf_dir), "#{VALUE.info.*}").select("offset", F.explode("fields").alias("name", "text"))


@query("c21_header_wildcard", """SELECT event_id AS "offset", unnest(['type[0]', 'id', 'type[1]']) AS name, unnest([event_type, CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR)]) AS text FROM events""")
def c21_header_wildcard(spark, sf_dir):
    return discover(event_records(spark, sf_dir, headers=F.expr(EVENT_HEADERS)), "#{HEADERS.*}").select("offset", F.explode("fields").alias("name", "text"))


@query("c23_combined", """SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS event_type, CAST(value AS VARCHAR) AS v, 5 AS n FROM events""")
def c23_combined(spark, sf_dir):
    out = map_fields(event_records(spark, sf_dir), {"event_type": "#{KEY}"}, "#{VALUE.*}", map_non_scalar=True)
    return out.select("offset", F.col("fields")["event_type"].alias("event_type"), F.col("fields")["value"].alias("v"), F.size("fields").alias("n"))


@query("c24_failure_reasons", _LINES + """SELECT CASE WHEN lines IS NULL THEN 'null_object' ELSE 'index_out_of_bounds' END AS reason, count(*) AS n FROM o WHERE lines IS NULL OR len(lines) < 4 GROUP BY 1""")
def c24_failure_reasons(spark, sf_dir):
    out = map_fields(order_records(spark, sf_dir), {"fourth": "#{VALUE.lines[3].l_partkey}"})
    return E.error_rows(out).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("c25_select_fields", """SELECT event_id AS "offset", event_type AS event_type, 2 AS n FROM events""")
def c25_select_fields(spark, sf_dir):
    out = select_fields(discover(event_records(spark, sf_dir), "#{VALUE.*}"), " event_type   value other")
    return out.select("offset", F.col("fields")["event_type"].alias("event_type"), F.size("fields").alias("n"))


@query("c22_scalar_wildcard", """SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS usr, 1 AS n FROM events""")
def c22_scalar_wildcard(spark, sf_dir):
    """A wildcard over a payload that is text finds nothing; named fields stay."""
    out = map_fields(event_records(spark, sf_dir), {"usr": "#{KEY}"}, ["#{VALUE.*}", "#{KEY.*}"], formats=Formats(value="STRING"))
    return out.select("offset", F.col("fields")["usr"].alias("usr"), F.size("fields").alias("n"))


@query("c24_all_reasons", """SELECT event_id AS "offset",
CASE event_id % 8 WHEN 0 THEN 'null_object' WHEN 1 THEN 'scalar_object' WHEN 3 THEN 'field_not_found' WHEN 4 THEN 'non_scalar' WHEN 5 THEN NULL ELSE 'array_object' END AS named,
CASE event_id % 8 WHEN 0 THEN 'null_object' WHEN 1 THEN 'not_indexed' WHEN 2 THEN 'index_out_of_bounds' WHEN 6 THEN NULL WHEN 7 THEN 'non_scalar' ELSE 'non_array_object' END AS indexed,
CASE WHEN event_id % 8 IN (5, 6) THEN CAST(event_id AS VARCHAR) END AS text FROM events""")
def c24_all_reasons(spark, sf_dir):
    """All eight reasons, of one payload a record stepped into by name and by index."""
    n = F.col("event_id").cast("string")
    shapes = ["null", "5", F.concat(F.lit("["), n, F.lit("]")), '{"c":1}', '{"b":{"x":1}}', F.concat(F.lit('{"b":'), n, F.lit("}")), F.concat(F.lit("[1,"), n, F.lit("]")), "[1,[2]]"]
    value = F.concat(F.lit('{"a":'), F.coalesce(*[F.when(F.col("event_id") % 8 == k, F.lit(x) if isinstance(x, str) else x) for k, x in enumerate(shapes)]), F.lit("}"))
    r = event_records(spark, sf_dir, value)
    named = map_fields(r, {"x": "#{VALUE.a.b}"}).select("offset", F.col("failure.reason").alias("named"), F.col("fields")["x"].alias("x"))
    indexed = map_fields(r, {"y": "#{VALUE.a[1]}"}).select("offset", F.col("failure.reason").alias("indexed"), F.col("fields")["y"].alias("y"))
    return named.join(indexed, "offset").select("offset", "named", "indexed", F.coalesce("x", "y").alias("text"))


# -- routing -------------------------------------------------------------------------------------


def _mapping(spark: SparkSession, sf_dir: str, regex: bool = False) -> DataFrame:
    """Topics of order statuses with the items of two nations each."""
    n = load(spark, sf_dir, "nation").select("n_nationkey")
    status = F.when(F.col("n_nationkey") % 3 == 0, "F").when(F.col("n_nationkey") % 3 == 1, "O").otherwise("P" if not regex else "[OP]")
    return n.select(F.concat(F.lit("orders_"), status).alias("topic"), F.concat(F.lit("item-"), F.col("n_nationkey").cast("string")).alias("item_ref"))


@query("d1_route_topics", """SELECT o_orderkey AS "offset", 'item-' || n_nationkey AS item_ref FROM orders JOIN nation
ON o_orderstatus = CASE n_nationkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END""")
def d1_route_topics(spark, sf_dir):
    return R.route_topics(order_records(spark, sf_dir).select("topic", "offset"), _mapping(spark, sf_dir)).select("offset", "item_ref")


@query("d2_route_regex", """SELECT o_orderkey AS "offset", 'item-' || n_nationkey AS item_ref FROM orders JOIN nation
ON regexp_full_match(o_orderstatus, CASE n_nationkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE '[OP]' END)""")
def d2_route_regex(spark, sf_dir):
    return R.route_topics(order_records(spark, sf_dir).select("topic", "offset"), _mapping(spark, sf_dir, True), regex=True).select("offset", "item_ref")


@query("d4_templates", """SELECT event_id AS "offset", unnest(['events-[type=' || event_type || ']', 'user-[k=' || regexp_extract(props, '-?[0-9]+') || ',u=' || user_id || ']', 'all']) AS item FROM events""")
def d4_templates(spark, sf_dir):
    out = R.expand_templates(event_records(spark, sf_dir), ["events-#{type=VALUE.event_type}", "user-#{u=KEY,k=VALUE.props.k}", "all"])
    return out.select("offset", F.explode("items").alias("item"))


@query("d5_template_failure", _LINES + """SELECT o_orderkey AS "offset", CASE WHEN lines IS NULL THEN 'null_object' ELSE 'index_out_of_bounds' END AS reason FROM o WHERE lines IS NULL OR len(lines) < 3""")
def d5_template_failure(spark, sf_dir):
    out = R.expand_templates(order_records(spark, sf_dir), ["order-#{p=VALUE.lines[2].l_partkey}", "all"])
    return E.error_rows(out).select("offset", "reason")


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscription texts of customers: swapped, plain, empty and broken parameter lists."""
    c = load(spark, sf_dir, "customer")
    kind = F.col("c_custkey") % 5
    text = (F.when(kind == 0, F.format_string("cust-[seg=%s,nation=%s]", "c_mktsegment", F.col("c_nationkey").cast("string")))
            .when(kind == 1, F.format_string("cust-[nation=%s,seg=%s]", F.col("c_nationkey").cast("string"), "c_mktsegment"))
            .when(kind == 2, F.concat(F.lit("plain"), F.col("c_nationkey").cast("string"))).when(kind == 3, F.lit("cust-[]"))
            .otherwise(F.format_string("cust-[nation=%s,nation=1]", F.col("c_nationkey").cast("string"))))
    return c.select("c_custkey", "c_nationkey", "c_mktsegment", text.alias("item_text"))


_REQUESTS = """SELECT c_custkey, c_custkey % 5 AS kind, CASE c_custkey % 5 WHEN 0 THEN 'cust-[nation=' || c_nationkey || ',seg=' || c_mktsegment || ']' WHEN 1 THEN 'cust-[nation=' || c_nationkey || ',seg=' || c_mktsegment || ']'
WHEN 2 THEN 'plain' || c_nationkey WHEN 3 THEN 'cust' END AS item FROM customer"""


@query("d6_canonical", _REQUESTS.replace("c_custkey % 5 AS kind", "c_custkey % 5 < 4 AS valid"))
def d6_canonical(spark, sf_dir):
    return _requests(spark, sf_dir).select("c_custkey", R.canonical_item(F.col("item_text")).alias("c")).select("c_custkey", "c.valid", "c.item")


@query("d7_match_templates", f"SELECT c_custkey, CASE WHEN kind < 2 THEN item END AS item, CASE WHEN kind = 4 THEN 'invalid_item' WHEN kind > 1 THEN 'no_template' END AS reason FROM ({_REQUESTS})")
def d7_match_templates(spark, sf_dir):
    good, bad = R.match_templates(_requests(spark, sf_dir), ["cust-#{seg=VALUE.seg,nation=VALUE.nation}"])
    none = F.lit(None).cast("string")
    return good.select("c_custkey", "item", none.alias("reason")).unionByName(bad.select("c_custkey", none.alias("item"), "reason"))


def _event_subs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A session for each nation, on an event type or on a user."""
    n = load(spark, sf_dir, "nation")
    kind = F.element_at(F.array(*[F.lit(t) for t in ("click", "view", "purchase")]), (F.col("n_nationkey") % 3 + 1).cast("int"))
    item = F.when(F.col("n_nationkey") % 2 == 0, F.format_string("events-[type=%s]", kind)).otherwise(F.format_string("user-[u=%s]", F.col("n_nationkey").cast("string")))
    return n.select(F.concat(F.lit("s"), F.col("n_nationkey").cast("string")).alias("session"), item.alias("item"))


_SUBS = """subs AS (SELECT 's' || n_nationkey AS session, CASE WHEN n_nationkey % 2 = 0 THEN 'events-[type=' || ['click', 'view', 'purchase'][n_nationkey % 3 + 1] || ']'
ELSE 'user-[u=' || n_nationkey || ']' END AS item FROM nation),
names AS (SELECT event_id, user_id, event_type, value, unnest(['events-[type=' || event_type || ']', 'user-[u=' || user_id || ']']) AS item FROM events)
"""
EVENT_TEMPLATES = ["events-#{type=VALUE.event_type}", "user-#{u=KEY}", "events-#{type=VALUE['event_type']}"]


@query("d8_d9_route", "WITH " + _SUBS + 'SELECT event_id AS "offset", session, item FROM names JOIN subs USING (item)')
def d8_d9_route(spark, sf_dir):
    expanded = R.expand_templates(event_records(spark, sf_dir), EVENT_TEMPLATES)
    return R.route(expanded, _event_subs(spark, sf_dir)).select("offset", "session", "item")


@query("d10_unrouted", "WITH " + _SUBS + """SELECT event_id AS "offset", event_id IN (SELECT event_id FROM names JOIN subs USING (item)) AS routed FROM events""")
def d10_unrouted(spark, sf_dir):
    expanded, subs = R.expand_templates(event_records(spark, sf_dir), EVENT_TEMPLATES), _event_subs(spark, sf_dir)
    return R.with_routed(expanded, subs, most_items=len(EVENT_TEMPLATES)).select("offset", "routed")


@query("d11_evaluation_order", "WITH " + _SUBS + """SELECT 'routed' AS mode, count(DISTINCT event_id) AS n FROM names JOIN subs USING (item) WHERE event_type = 'view'
UNION ALL SELECT 'always', count(*) FROM events WHERE event_type = 'view'""")
def d11_evaluation_order(spark, sf_dir):
    body = F.when(F.col("event_type") == "view", F.to_json(F.struct("event_type"))).otherwise(F.to_json(F.struct("event_type", "value")))
    r, subs = event_records(spark, sf_dir, body), _event_subs(spark, sf_dir)
    counts = [process(r, subs, Spec(EVENT_TEMPLATES, {"v": "#{VALUE.value}"}, evaluate_fields=mode))[1].agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n")) for mode in ("routed", "always")]
    return counts[0].unionByName(counts[1])


@query("d12_split_items", """SELECT c_custkey, requested, CASE WHEN requested = 'b-[y=1,x=2]' THEN 'b-[x=2,y=1]' ELSE requested END AS item
FROM (SELECT c_custkey, unnest(['n' || c_nationkey, 'b-[y=1,x=2]']) AS requested FROM customer)""")
def d12_split_items(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("  n"), F.col("c_nationkey").cast("string"), F.lit("   b-[y=1,x=2] ")).alias("wanted"))
    return R.split_items(c, "wanted").select("c_custkey", "requested", F.col("canonical.item").alias("item"))


@query("d13_admit", """SELECT c_custkey, CASE WHEN r_regionkey IS NULL THEN 'unknown_connection' WHEN r_regionkey = 0 THEN 'connection_disabled'
WHEN r_regionkey = 1 AND c_mktsegment <> 'MACHINERY' THEN 'command_mode_required' END AS reason FROM customer LEFT JOIN region ON c_nationkey % 7 = r_regionkey""")
def d13_admit(spark, sf_dir):
    mode = F.when(F.col("c_mktsegment") == "MACHINERY", "COMMAND").otherwise("MERGE")
    subs = load(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") % 7).alias("connection"), mode.alias("mode"))
    connections = load(spark, sf_dir, "region").select(F.col("r_regionkey").alias("connection"), (F.col("r_regionkey") != 0).alias("enabled"), (F.col("r_regionkey") == 1).alias("command_mode"))
    good, bad = R.admit(subs, connections)
    return good.select("c_custkey", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("c_custkey", "reason"))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscription log of conversations: users subscribe, others unsubscribe, to one of three items."""
    t = load(spark, sf_dir, "conversations")
    return t.select(F.col("conv_id").cast("string").alias("session"), F.concat(F.lit("i"), F.floor(F.col("turn") / 2) % 3).alias("item"),
                    F.when(F.col("role") == "user", "subscribe").otherwise("unsubscribe").alias("action"), (F.col("conv_id") * 100000 + F.col("turn")).alias("seq"))


_LOG = """SELECT CAST(conv_id AS VARCHAR) AS session, 'i' || (turn // 2) % 3 AS item, CASE WHEN role = 'user' THEN 'subscribe' ELSE 'unsubscribe' END AS action, conv_id * 100000 + turn AS seq FROM conversations"""


@query("d14_active", f"SELECT session, item FROM (SELECT session, item, arg_max(action, seq) AS action FROM ({_LOG}) GROUP BY 1, 2) WHERE action = 'subscribe'")
def d14_active(spark, sf_dir):
    return R.active_subscriptions(_log(spark, sf_dir), "seq", ("session", "item")).select("session", "item")


@query("d14_in_time", "WITH " + _SUBS + """SELECT event_id AS "offset", session, item FROM names JOIN subs USING (item) JOIN (SELECT event_id, ts FROM events) USING (event_id)
WHERE ts >= TIMESTAMP '2024-01-01' + to_days(CAST(substr(session, 2) AS INTEGER)) AND (session = 's0' OR ts < TIMESTAMP '2024-01-03' + to_days(2 * CAST(substr(session, 2) AS INTEGER)))""")
def d14_in_time(spark, sf_dir):
    """Session n subscribes n days after New Year and leaves later; the first stays. Records before and after aren't for it."""
    subs = R.subscription_intervals(_event_log(spark, sf_dir), "at", ("session", "item"), ("from_time", "to_time"))
    return R.route(R.expand_templates(event_records(spark, sf_dir), EVENT_TEMPLATES), subs).select("offset", "session", "item")


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _event_subs(spark, sf_dir).withColumn("n", F.substring("session", 2, 9).cast("int"))
    day, start = 86400, 1704067200
    return asked.select("session", "item", F.lit("subscribe").alias("action"), F.timestamp_seconds(start + F.col("n") * day).alias("at")).unionByName(
        asked.where("n > 0").select("session", "item", F.lit("unsubscribe").alias("action"), F.timestamp_seconds(start + 2 * day + F.col("n") * 2 * day).alias("at")))


def _quarters(df: DataFrame, column: str) -> list[tuple]:
    """Four spans of a time column, the last one open."""
    a, b = df.agg(F.min(column).cast("timestamp"), F.max(column).cast("timestamp")).first()
    return [(a + (b - a) * k / 4, a + (b - a) * (k + 1) / 4 if k < 3 else None) for k in range(4)] if a else []


def _within(column: str, span: tuple) -> Column:
    return (F.col(column) >= F.lit(span[0])) & (F.lit(True) if span[1] is None else F.col(column) < F.lit(span[1]))


@query("d14_live", ORACLES["d14_in_time"])
def d14_live(spark, sf_dir):
    """``d14_in_time`` in four batches, the log growing before each: equal to reading all of it at once."""
    folder = scratch_folder(spark)
    records, log, live = R.expand_templates(event_records(spark, sf_dir), EVENT_TEMPLATES), _event_log(spark, sf_dir), LiveSubscriptions(f"{folder}/log", "at")
    log.limit(0).write.parquet(f"{folder}/log")
    log.limit(0).select(F.lit(0).cast("bigint").alias("offset"), "session", "item").write.parquet(f"{folder}/out")
    spans, before = _quarters(load(spark, sf_dir, "events"), "ts"), None
    for k, span in enumerate(spans):
        seen = F.lit(True) if span[1] is None else F.col("at") < F.lit(span[1])
        log.where(seen if before is None else seen & (F.col("at") >= F.lit(before))).write.mode("append").parquet(f"{folder}/log")
        before, batch = span[1], records.where(_within("timestamp", span))
        R.route(batch, live.at(batch, f"{folder}/kept", k)).select("offset", "session", "item").write.mode("append").parquet(f"{folder}/out")
    return spark.read.parquet(f"{folder}/out")


@query("d15_items_by_session", f"""SELECT session, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT session, item, arg_max(action, seq) AS action FROM ({_LOG}) GROUP BY 1, 2)
WHERE action = 'subscribe' GROUP BY 1""")
def d15_items_by_session(spark, sf_dir):
    return R.items_by_session(_log(spark, sf_dir)).select("session", F.array_join("items", ",").alias("items"))


@query("d16_union_topics", """SELECT topic, count(*) AS n FROM (SELECT 'events' AS topic FROM events UNION ALL SELECT 'orders_' || o_orderstatus FROM orders) GROUP BY 1""")
def d16_union_topics(spark, sf_dir):
    return R.union_topics(event_records(spark, sf_dir), order_records(spark, sf_dir)).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


# -- error policies ------------------------------------------------------------------------------


def _third_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_fields(order_records(spark, sf_dir), {"third": "#{VALUE.lines[2].l_partkey}"})


@query("e1_ignore", _LINES + 'SELECT o_orderkey AS "offset", CAST(lines[3].p AS VARCHAR) AS third FROM o WHERE len(lines) >= 3')
def e1_ignore(spark, sf_dir):
    return fields_as(E.ignore_errors(_third_line(spark, sf_dir)), "third")


@query("e2_force_unsubscribe", _LINES + """, bad AS (SELECT min((o_orderdate, o_custkey % 3, o_orderkey)) AS lim FROM o WHERE lines IS NULL)
SELECT o_orderkey AS "offset" FROM o, bad WHERE lines IS NOT NULL AND (lim IS NULL OR (o_orderdate, o_custkey % 3, o_orderkey) < lim)""")
def e2_force_unsubscribe(spark, sf_dir):
    first = map_fields(order_records(spark, sf_dir), {"first": "#{VALUE.lines[0].l_partkey}"})
    return E.force_unsubscribe(first, _event_subs(spark, sf_dir))[0].select("offset")


@query("e3_dead_letters", _LINES + """SELECT o_orderkey AS "offset", 'field' AS stage, CASE WHEN lines IS NULL THEN 'null_object' ELSE 'index_out_of_bounds' END AS reason,
CASE WHEN lines IS NULL THEN 'Cannot retrieve index [2] from a null object' ELSE 'Field not found at index [2]' END AS message FROM o WHERE lines IS NULL OR len(lines) < 3""")
def e3_dead_letters(spark, sf_dir):
    return E.dead_letter(_third_line(spark, sf_dir), "sink")[1].select("offset", "stage", "reason", "message")


@query("e4_terminate", """SELECT event_id AS "offset", CAST(value AS VARCHAR) AS v FROM events""")
def e4_terminate(spark, sf_dir):
    return fields_as(E.terminate_on_error(map_fields(event_records(spark, sf_dir), {"v": "#{VALUE.value}"})), "v")


@query("e4_stops", _LINES + "SELECT count(*) AS failed, TRUE AS stopped FROM o WHERE coalesce(len(lines), 0) < 3")
def e4_stops(spark, sf_dir):
    """The policy stops a run over all orders, some of which have no third line."""
    mapped = map_fields(order_records(spark, sf_dir), {"third": "#{VALUE.lines[2].l_partkey}"})
    stopped = False
    try:
        E.terminate_on_error(mapped).write.format("noop").mode("overwrite").save()
    except Exception as error:
        stopped = "USER_RAISED_EXCEPTION" in str(error) and "index [2]" in str(error)  # the policy stopped it, nothing else
    return E.error_rows(mapped).agg(F.count(F.lit(1)).alias("failed")).withColumn("stopped", F.lit(stopped))


# -- change streams ------------------------------------------------------------------------------


def _commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes: signup adds, click and view update, error deletes; every 500th event of a
    partition's item is a control record."""
    e = load(spark, sf_dir, "events")
    control = F.col("event_id") % 500
    command = (F.when(control == 250, "EOS").when(control == 499, "CS").when(F.col("event_type") == "signup", "ADD").when(F.col("event_type").isin("click", "view"), "UPDATE")
               .when(F.col("event_type") == "error", "DELETE").otherwise("OTHER"))
    key = F.when(control.isin(250, 499), "snapshot").otherwise(F.col("user_id").cast("string"))
    fields = F.map_from_arrays(F.array(F.lit("key"), F.lit("command"), F.lit("v")), F.array(key, command, F.col("value").cast("string")))
    return e.select(F.concat(F.lit("item"), (F.floor(F.col("event_id") / 2) % 3).cast("string")).alias("item"), F.lit("events").alias("topic"), F.lit(0).alias("partition"),
                    F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"), fields.alias("fields"))


_COMMANDS = """c AS (SELECT event_id, 'item' || (event_id // 2) % 3 AS item, ts, CAST(value AS VARCHAR) AS v,
CASE WHEN event_id % 500 IN (250, 499) THEN 'snapshot' ELSE CAST(user_id AS VARCHAR) END AS key,
CASE WHEN event_id % 500 = 250 THEN 'EOS' WHEN event_id % 500 = 499 THEN 'CS' WHEN event_type = 'signup' THEN 'ADD' WHEN event_type IN ('click', 'view') THEN 'UPDATE'
WHEN event_type = 'error' THEN 'DELETE' ELSE 'OTHER' END AS command FROM events)
"""


@query("f1_f2_enforce", "WITH " + _COMMANDS + """SELECT event_id AS "offset", CASE command WHEN 'CS' THEN 'clear_snapshot' WHEN 'EOS' THEN 'end_of_snapshot' ELSE 'update' END AS event_kind FROM c WHERE command <> 'OTHER'""")
def f1_f2_enforce(spark, sf_dir):
    return C.snapshot_control(C.enforce_command(_commands(spark, sf_dir))[0]).select("offset", "event_kind")


@query("f1_rejected", "WITH " + _COMMANDS + """SELECT event_id AS "offset", 'command' AS stage, 'invalid_command' AS reason FROM c WHERE command = 'OTHER'""")
def f1_rejected(spark, sf_dir):
    return C.enforce_command(_commands(spark, sf_dir))[1].select("offset", "stage", "reason")


@query("f3_tag_snapshot", "WITH " + _COMMANDS + """SELECT event_id AS "offset", item, coalesce(last_value(CASE command WHEN 'CS' THEN TRUE WHEN 'EOS' THEN FALSE END IGNORE NULLS)
OVER (PARTITION BY item ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS is_snapshot FROM c""")
def f3_tag_snapshot(spark, sf_dir):
    return C.tag_snapshot(_commands(spark, sf_dir)).select("offset", "item", "is_snapshot")


def _auto(spark: SparkSession, sf_dir: str, track: bool) -> DataFrame:
    body = F.when(F.col("event_type") != "error", F.to_json(F.struct("value")))
    out = map_fields(event_records(spark, sf_dir, body), {"key": "#{KEY}", "v": "#{VALUE.value}"}, skip_failed=True).withColumn("item", F.lit("board"))
    return C.auto_command(out, D.is_tombstone(F.col("value")), track)


@query("f4_f7_auto", """SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS key, CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'ADD' END AS command,
CASE WHEN event_type <> 'error' THEN CAST(value AS VARCHAR) END AS v FROM events""")
def f4_f7_auto(spark, sf_dir):
    return fields_as(_auto(spark, sf_dir, False), "key", "command", "v")


@query("f5_tracked", """SELECT event_id AS "offset", CASE WHEN event_type = 'error' THEN 'DELETE' WHEN coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id), 'error') = 'error' THEN 'ADD'
ELSE 'UPDATE' END AS command FROM events""")
def f5_tracked(spark, sf_dir):
    return fields_as(_auto(spark, sf_dir, True), "command")


_BOARD = "WITH " + _COMMANDS + """, cs AS (SELECT item, max((ts, event_id)) AS at FROM c WHERE command = 'CS' GROUP BY 1),
l AS (SELECT item, key, max((ts, event_id)) AS at, arg_max(command, (ts, event_id)) AS command, arg_max(v, (ts, event_id)) AS v FROM c WHERE command IN ('ADD', 'UPDATE', 'DELETE') GROUP BY 1, 2)
SELECT l.item, l.key, l.v FROM l LEFT JOIN cs ON l.item = cs.item WHERE command <> 'DELETE' AND (cs.at IS NULL OR l.at > cs.at)"""


@query("f8_board", _BOARD)
def f8_board(spark, sf_dir):
    return C.materialize_board(_commands(spark, sf_dir)).select("item", "key", F.col("fields")["v"].alias("v"))


@query("f8_kept_board", _BOARD)
def f8_kept_board(spark, sf_dir):
    """The board kept over four batches of changes: equal to the one of all changes at once."""
    board, changes = KeptBoard(scratch_folder(spark), ("item",)), _commands(spark, sf_dir)
    spans = _quarters(changes, "timestamp")
    for k, span in enumerate(spans):
        board.update(changes.where(_within("timestamp", span)), k)
    rows = board.read(spark, len(spans)) if spans else C.materialize_board(changes)
    return rows.select("item", "key", F.col("fields")["v"].alias("v"))


@query("f9_sorted_board", _BOARD)
def f9_sorted_board(spark, sf_dir):
    return C.sorted_board(C.materialize_board(_commands(spark, sf_dir)), "v").select("item", "key", F.col("fields")["v"].alias("v"))


@query("f9_board_places", "SELECT item, key, row_number() OVER (PARTITION BY item ORDER BY v NULLS FIRST, key) AS place FROM (" + _BOARD + ")")
def f9_board_places(spark, sf_dir):
    rows = C.sorted_board(C.materialize_board(_commands(spark, sf_dir)), "v").select("item", "key", F.monotonically_increasing_id().alias("at"))
    return rows.select("item", "key", _place("item").cast("long").alias("place"))


# -- order and positions -------------------------------------------------------------------------


@query("g1_partition_order", """SELECT event_id AS "offset", CAST(user_id % 4 AS INTEGER) AS "partition" FROM events""")
def g1_partition_order(spark, sf_dir):
    return G.ordered(event_records(spark, sf_dir).select("topic", "partition", "offset")).select("partition", "offset")


@query("g2_key_order", """SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS k FROM events""")
def g2_key_order(spark, sf_dir):
    return G.ordered(event_records(spark, sf_dir).select("key", "partition", "offset"), "key").select("offset", F.col("key").cast("string").alias("k"))


def _place(*lane: str) -> Column:
    """Place of a row within its lane, in the order in which it is delivered (column ``at``)."""
    return F.row_number().over(Window.partitionBy(*lane).orderBy("at"))


@query("g1_partition_places", """SELECT event_id AS "offset", row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS place FROM events""")
def g1_partition_places(spark, sf_dir):
    rows = G.ordered(event_records(spark, sf_dir).select("topic", "partition", "offset")).withColumn("at", F.monotonically_increasing_id())
    return rows.select("offset", _place("topic", "partition").cast("long").alias("place"))


@query("g2_key_places", """SELECT event_id AS "offset", row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events""")
def g2_key_places(spark, sf_dir):
    rows = G.ordered(event_records(spark, sf_dir).select("key", "partition", "offset"), "key").withColumn("at", F.monotonically_increasing_id())
    return rows.select("offset", _place("key").cast("long").alias("place"))


@query("g3_no_order", """SELECT event_id AS "offset" FROM events""")
def g3_no_order(spark, sf_dir):
    return G.ordered(event_records(spark, sf_dir).select("topic", "partition", "offset"), "none").select("offset")


@query("g4_next_offsets", """SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", max(event_id) + 1 AS next_offset FROM events GROUP BY 2""")
def g4_next_offsets(spark, sf_dir):
    return G.next_offsets(event_records(spark, sf_dir).select("topic", "partition", "offset"))


@query("g5_start_offsets", """SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", CASE WHEN user_id % 4 < 2 THEN min(event_id) + 7 ELSE min(event_id) END AS start_offset FROM events GROUP BY user_id % 4""")
def g5_start_offsets(spark, sf_dir):
    bounds = event_records(spark, sf_dir).groupBy("topic", "partition").agg(F.min("offset").alias("begin_offset"), (F.max("offset") + 1).alias("end_offset"))
    committed = bounds.where("partition < 2").select("topic", "partition", (F.col("begin_offset") + 7).alias("offset"))
    return G.start_offsets(committed, bounds, "earliest")


# -- metrics -------------------------------------------------------------------------------------


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauge samples of events: series event_type, one sample at each time."""
    e = load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy(F.col("event_type").alias("series"), "ts").agg(F.max("value").alias("value"))


_SAMPLES = "s AS (SELECT event_type AS series, ts, max(value) AS value FROM events GROUP BY 1, 2)"
_RANGES = f"""WITH {_SAMPLES}, x AS (SELECT *, lag(ts) OVER (PARTITION BY series ORDER BY ts) AS pts, lag(value) OVER (PARTITION BY series ORDER BY ts) AS pv FROM s),
r AS (SELECT *, to_timestamp(k * 3600) AT TIME ZONE 'UTC' AS t FROM (SELECT *, unnest(generate_series(CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) + 1, CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) + 6)) AS k FROM x)),
g AS (SELECT series, unnest(generate_series(min(t), max(t), INTERVAL 1 HOUR)) AS t FROM r GROUP BY 1)
"""


_RATE_SQL = "CASE WHEN count(value) >= 2 THEN regr_slope(value, epoch_us(ts) // 1000 - 1704067200000) * 1000 END"
_IRATE_SQL = "CASE WHEN arg_max(epoch_us(pts) // 1000, ts) >= epoch_ms(g.t) - 21600000 THEN (arg_max(value, ts) - arg_max(pv, ts)) / ((max(epoch_us(ts) // 1000) - arg_max(epoch_us(pts) // 1000, ts)) / 1000.0) END"


def _hours(spark: SparkSession, sf_dir: str, *functions: str) -> DataFrame:
    return plain_times(H.evaluate(_samples(spark, sf_dir), 6 * 3600, 3600, functions), "t").select("series", "t", *[F.round(n, 6).alias(n) for n in functions])


def _range_sql(**columns: str) -> str:
    return _RANGES + "SELECT g.series, g.t, " + ", ".join(f"round(coalesce({e}, 'nan'::DOUBLE), 6) AS {n}" for n, e in columns.items()) + " FROM g LEFT JOIN r ON g.series = r.series AND g.t = r.t GROUP BY 1, 2"


@query("h1_sample_counter", """WITH c AS (SELECT event_type AS series, floor(epoch_us(ts) / 3600000000) + 1 AS k, count(*) AS n FROM events GROUP BY 1, 2),
g AS (SELECT series, unnest(generate_series(CAST(min(k) AS BIGINT), CAST(max(k) AS BIGINT))) AS k FROM c GROUP BY 1)
SELECT g.series, to_timestamp(g.k * 3600) AT TIME ZONE 'UTC' AS ts, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY g.series ORDER BY g.k) AS DOUBLE) AS value FROM g LEFT JOIN c ON g.series = c.series AND g.k = c.k""")
def h1_sample_counter(spark, sf_dir):
    e = load(spark, sf_dir, "events").select(F.col("event_type").alias("series"), F.col("ts").cast("timestamp").alias("ts"))
    return plain_times(H.sample_counter(e, 3600), "ts")


@query("h2_sample_gauge", f"""WITH {_SAMPLES}, c AS (SELECT series, floor(epoch_us(ts) / 3600000000) + 1 AS k, arg_max(value, ts) AS v FROM s GROUP BY 1, 2),
g AS (SELECT series, unnest(generate_series(CAST(min(k) AS BIGINT), CAST(max(k) AS BIGINT))) AS k FROM c GROUP BY 1)
SELECT g.series, to_timestamp(g.k * 3600) AT TIME ZONE 'UTC' AS ts, last_value(v IGNORE NULLS) OVER (PARTITION BY g.series ORDER BY g.k) AS value FROM g LEFT JOIN c ON g.series = c.series AND g.k = c.k""")
def h2_sample_gauge(spark, sf_dir):
    return plain_times(H.sample_gauge(_samples(spark, sf_dir), 3600), "ts")


@query("h3_range_select", _RANGES + "SELECT series, ts, t FROM r")
def h3_range_select(spark, sf_dir):
    return plain_times(H.range_select(_samples(spark, sf_dir), 6 * 3600, 3600), "ts", "t").select("series", "ts", "t")


@query("h4_h9_aggregates", _range_sql(latest="arg_max(value, ts)", average="avg(value)", maximum="max(value)", minimum="min(value)", total="sum(value)", count="CASE WHEN count(value) > 0 THEN count(value) END"))
def h4_h9_aggregates(spark, sf_dir):
    return _hours(spark, sf_dir, "latest", "average", "maximum", "minimum", "total", "count")


@query("h10_rate", _range_sql(rate=_RATE_SQL))
def h10_rate(spark, sf_dir):
    return _hours(spark, sf_dir, "rate")


@query("h11_irate", _range_sql(irate=_IRATE_SQL))
def h11_irate(spark, sf_dir):
    return _hours(spark, sf_dir, "irate")


@query("h12_keep_last", f"WITH {_SAMPLES} SELECT series, ts, value FROM s QUALIFY row_number() OVER (PARTITION BY series ORDER BY ts DESC) <= 120")
def h12_keep_last(spark, sf_dir):
    return plain_times(H.keep_last(_samples(spark, sf_dir)), "ts")


@query("h13_time_range", f"WITH {_SAMPLES} SELECT series, min(ts) AS oldest, max(ts) AS newest FROM s GROUP BY 1")
def h13_time_range(spark, sf_dir):
    return plain_times(H.time_range(_samples(spark, sf_dir)), "oldest", "newest")


@query("h14_h16_report", _RANGES + """SELECT g.series, g.t, g.series || ' [360m]: latest=' || coalesce(printf('%.2f', arg_max(value, ts)), 'n/a') || ', minimum=' || coalesce(printf('%.2f', min(value)), 'n/a')
|| ', maximum=' || coalesce(printf('%.2f', max(value)), 'n/a') AS line FROM g LEFT JOIN r ON g.series = r.series AND g.t = r.t GROUP BY 1, 2""")
def h14_h16_report(spark, sf_dir):
    names = ("latest", "minimum", "maximum")
    return plain_times(H.report(H.evaluate(_samples(spark, sf_dir), 6 * 3600, 3600, names), 6 * 3600, names), "t")


@query("h14_h16_all_functions", _RANGES + "SELECT g.series, g.t, g.series || ' [360m]: ' || " + " || ', ' || ".join(
    f"'{n}=' || coalesce(printf('%.7f', {e}), 'n/a')" for n, e in (("latest", "arg_max(value, ts)"), ("rate", _RATE_SQL), ("irate", _IRATE_SQL), ("minimum", "min(value)"), ("maximum", "max(value)"), ("average", "avg(value)")))
    + " AS line FROM g LEFT JOIN r ON g.series = r.series AND g.t = r.t GROUP BY 1, 2")
def h14_h16_all_functions(spark, sf_dir):
    samples, range_, step = _samples(spark, sf_dir), 6 * 3600, 3600
    evaluated = H.settle_averages(H.evaluate(samples, range_, step, (*H.FUNCTIONS, "count")), samples, range_, step, 7)
    return plain_times(H.report(evaluated, range_, formatter=H.unscaled(7)), "t")


@query("j5_custom_formatter", """SELECT o_orderkey, 'price=' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || ' whole' AS shown FROM orders""")
def j5_custom_formatter(spark, sf_dir):
    shown = H.format_metric(F.col("o_totalprice"), name="price", formatter=lambda v: F.concat(F.floor(v).cast("string"), F.lit(" whole")))
    return load(spark, sf_dir, "orders").select("o_orderkey", shown.alias("shown"))


@query("h15_format", """SELECT o_orderkey, CASE WHEN o_totalprice >= 1000 THEN printf('%.5fk EUR', o_totalprice / 1000) ELSE printf('%.5f EUR', o_totalprice) END AS shown FROM orders""")
def h15_format(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", H.format_metric(F.col("o_totalprice"), 5, "EUR").alias("shown"))


_RECEIVED = """e AS (SELECT 'received' AS series, ts FROM events UNION ALL SELECT 'processed', ts FROM (""" + ORACLES["d8_d9_route"] + """) q JOIN events ON event_id = q."offset"),
c AS (SELECT series, floor(epoch_us(ts) / 3600000000) + 1 AS k, count(*) AS n FROM e GROUP BY 1, 2),
h AS (SELECT series, unnest(generate_series(CAST(min(k) AS BIGINT), CAST(max(k) AS BIGINT))) AS k FROM c GROUP BY 1),
s AS (SELECT h.series, to_timestamp(h.k * 3600) AT TIME ZONE 'UTC' AS ts, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY h.series ORDER BY h.k) AS DOUBLE) AS value FROM h LEFT JOIN c ON h.series = c.series AND h.k = c.k)"""


@query("h17_record_rates", (ORACLES["h10_rate"].replace(", 6) AS rate FROM", ", 6) AS rate, " + ORACLES["h11_irate"].split("SELECT g.series, g.t, ")[1].split(" FROM g LEFT JOIN")[0] + " FROM")).replace(_SAMPLES, _RECEIVED))
def h17_record_rates(spark, sf_dir):
    r = event_records(spark, sf_dir)
    updates, _ = process(r, _event_subs(spark, sf_dir), Spec(EVENT_TEMPLATES, {"v": "#{VALUE.value}"}))
    return plain_times(H.record_rates(r, updates, 3600, 6 * 3600, 3600), "t").select("series", "t", F.round("rate", 6).alias("rate"), F.round("irate", 6).alias("irate"))


# -- functions and hooks -------------------------------------------------------------------------


@query("i4_unsigned_64", """SELECT event_id, CAST(18446744073709551616::HUGEINT - event_id AS VARCHAR) AS below, CAST(event_id AS VARCHAR) AS above FROM events WHERE event_id > 0""")
def i4_unsigned_64(spark, sf_dir):
    e = load(spark, sf_dir, "events").where("event_id > 0")
    return e.select("event_id", X.unsigned_text(-F.col("event_id"), 64).alias("below"), X.unsigned_text(F.col("event_id"), 64).alias("above"))


@query("j4_custom_format", """SELECT event_id AS "offset", event_type AS kind, CAST(user_id AS VARCHAR) AS usr FROM events""")
def j4_custom_format(spark, sf_dir):
    """A format of the user's own: two parts between semicolons, stepped into like any other."""
    parts = lambda payload: F.split(payload.cast("string"), ";")
    D.register_format("two_parts", lambda payload: F.struct(F.get(parts(payload), 0).alias("kind"), F.get(parts(payload), 1).cast("bigint").alias("user")))
    r = event_records(spark, sf_dir, F.concat("event_type", F.lit(";"), F.col("user_id").cast("string")))
    return fields_as(map_fields(r, {"kind": "#{VALUE.kind}", "usr": "#{VALUE.user}"}, formats=Formats(value="TWO_PARTS")), "kind", "usr")


@query("i1_i8_functions", """SELECT event_id, [event_type, '', CAST(user_id AS VARCHAR)][1] || '|' || CAST(user_id AS VARCHAR) AS parts, CAST(CASE WHEN event_id % 2 = 1 THEN 4294967296 - event_id ELSE event_id END AS VARCHAR) AS unsigned,
'{t=' || event_type || ', u=' || user_id || '}' AS map_text, '[' || list_aggregate(list_transform(string_split(event_type, ''), lambda c: CAST(ascii(c) AS VARCHAR)), 'string_agg', ', ') || ']' AS bytes,
CAST(epoch_us(ts) // 1000 AS VARCHAR) AS millis, 1 AS n FROM events""")
def i1_i8_functions(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    parts = X.split_trimmed(F.concat(F.lit(" "), "event_type", F.lit(" ; ;  "), F.col("user_id").cast("string")), ";")
    number = F.when(F.col("event_id") % 2 == 1, -F.col("event_id")).otherwise(F.col("event_id")).cast("int")
    pairs = F.create_map(F.lit("t"), "event_type", F.lit("u"), F.col("user_id").cast("string"))
    return e.select("event_id", F.concat(F.get(parts, 0), F.get(parts, 1), F.lit("|"), F.get(parts, 2)).alias("parts"), X.unsigned_text(number, 32).alias("unsigned"), X.map_text(pairs, "=").alias("map_text"),
                    X.byte_list_text(F.col("event_type").cast("binary")).alias("bytes"), X.millis_text(F.col("ts").cast("timestamp")).alias("millis"), F.size(X.json_keys(F.col("props"))).alias("n"))


@query("j1_j3_hooks", """SELECT c_custkey, 'seg-' || lower(c_mktsegment) AS item, c_acctbal > 0 AS allowed FROM customer""")
def j1_j3_hooks(spark, sf_dir):
    asked = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.col("c_mktsegment").alias("items_text"))
    remapped = J.remap_items(asked, lambda df: df.withColumn("items_text", F.concat(F.lit("seg-"), F.lower("items_text")))).withColumn("item", F.col("canonical.item"))
    good, bad = J.on_subscription(remapped, F.col("c_acctbal") > 0)
    return good.select("c_custkey", "item", F.lit(True).alias("allowed")).unionByName(bad.select("c_custkey", "item", F.lit(False).alias("allowed")))


@query("j3_unsubscribed", f"SELECT item, count(*) AS n FROM ({_LOG}) WHERE action = 'unsubscribe' GROUP BY 1")
def j3_unsubscribed(spark, sf_dir):
    return J.on_unsubscription(_log(spark, sf_dir), lambda df: df.groupBy("item").agg(F.count(F.lit(1)).alias("n")))


# -- the whole pipeline --------------------------------------------------------------------------


@query("updates", "WITH " + _SUBS + """SELECT session, item, 'update' AS event_kind, event_id AS "offset", CAST(user_id AS VARCHAR) AS usr, CAST(value AS VARCHAR) AS amount FROM names JOIN subs USING (item)""")
def updates(spark, sf_dir):
    spec = Spec(EVENT_TEMPLATES, {"usr": "#{KEY}", "amount": "#{VALUE.value}"})
    out, _ = process(event_records(spark, sf_dir), _event_subs(spark, sf_dir), spec)
    return fields_as(out, "usr", "amount", keep=("session", "item", "event_kind", "offset"))
