"""Golden extractions and failures of the path functions."""

import pytest
from pyspark.sql import functions as F

from sluice.functions.paths import Formats, extract, parse
from sluice.operators.fields import discover, map_fields, select_fields
from sluice.sources.envelope import as_envelope, read_structured

JOE = """{"name":"joe","signature":"YWJjZA==","number":1.0,"like":"{\\"a\\":1}","notes":["note1","note2"],"nullArray":null,
"stringsStrings":[["ss00","ss01"]],"mapsMaps":{"map1":{"m11":"mv11","m12":"mv12"}},
"children":[{"name":"alex","signature":null},{"name":"anna","children":[{"name":"gloria"},{"name":"terence"}]},{"name":"serena"},null],
"family":[[{"name":"bro00"},{"name":"bro01"}],[{"name":"bro10"},{"name":"bro11"}]]}"""
HEADERS = "array(" + ",".join(f"struct('{k}' as key, cast('{v}' as binary) as value)" for k, v in [("name", "joe"), ("signature", "YWJjZA=="), ("accountId", "12345"), ("accountId", "67890"), ("docType", "type1"), ("docType", "type2")]) + ")"


@pytest.fixture(scope="module")
def joe(spark):
    return as_envelope(spark.createDataFrame([(JOE,)], ["v"]), "topic", "aKey", F.col("v"), 150, 120, F.timestamp_millis(F.lit(-1)), F.expr(HEADERS)).cache()


def results(df, expressions, **rest):
    row = extract(df, {f"r{k}": parse("#{" + e + "}") for k, e in enumerate(expressions)}, **rest).first()
    return {e: row[f"r{k}"] for k, e in enumerate(expressions)}


VALUES = {
    "VALUE.name": "joe", "VALUE['name']": "joe", "VALUE.signature": "YWJjZA==", "VALUE.number": "1.0", "VALUE.like": '{"a":1}', "VALUE['notes'][0]": "note1",
    "VALUE.stringsStrings[0][1]": "ss01", "VALUE.mapsMaps['map1'].m11": "mv11", "VALUE['mapsMaps']['map1']['m11']": "mv11", "VALUE.children[0].name": "alex",
    "VALUE.children[0].signature": None, "VALUE.children[3]": None, "VALUE.children[1].children[1]['name']": "terence", "VALUE.family[1][1].name": "bro11",
    "KEY": "aKey", "TOPIC": "topic", "PARTITION": "150", "OFFSET": "120", "TIMESTAMP": "-1", "HEADERS.name": "joe", "HEADERS[1]": "YWJjZA==",
    "HEADERS.accountId[1]": "67890", "HEADERS['docType'][0]": "type1", "HEADERS[5]": "type2",
}
FAILURES = {
    "VALUE": "The expression [VALUE] must evaluate to a non-complex object", "VALUE.a b": "Field [a b] not found", "VALUE['no_attrib']": "Field [no_attrib] not found",
    "VALUE[0]": "Cannot retrieve index [0] from a non-array object", "VALUE.no_children[0]": "Field [no_children] not found", "VALUE.name[0]": "Field [name] is not indexed",
    "VALUE.name['no_key']": "Cannot retrieve field [no_key] from a scalar object", "VALUE.children": "The expression [VALUE.children] must evaluate to a non-complex object",
    "VALUE.children['name']": "Cannot retrieve field [name] from an array object", "VALUE.children[3].name": "Cannot retrieve field [name] from a null object",
    "VALUE.children[4].name": "Field not found at index [4]", "VALUE.nullArray[0]": "Cannot retrieve index [0] from a null object",
    "HEADERS": "The expression [HEADERS] must evaluate to a non-complex object", "HEADERS[6]": "Field not found at index [6]", "HEADERS.no_children[0]": "Field [no_children] not found",
    "HEADERS.name[0]": "Field [name] is not indexed", "HEADERS.name['no_key']": "Cannot retrieve field [no_key] from a scalar object",
    "HEADERS.accountId": "The expression [HEADERS.accountId] must evaluate to a non-complex object", "HEADERS.accountId[2]": "Field not found at index [2]",
}


def test_values(joe):
    found = results(joe, VALUES)
    assert {e: r["text"] for e, r in found.items()} == VALUES
    assert all(r["ok"] for r in found.values())


def test_failures(joe):
    found = results(joe, FAILURES)
    assert {e: r["message"] for e, r in found.items()} == FAILURES
    assert not any(r["ok"] for r in found.values())


def test_non_scalar_text(joe):
    found = results(joe, ["VALUE.notes", "HEADERS.accountId", "VALUE.mapsMaps"], non_scalar=True)
    assert [r["text"] for r in found.values()] == ['["note1","note2"]', "[12345, 67890]", '{"map1":{"m11":"mv11","m12":"mv12"}}']


@pytest.mark.parametrize("bad", ["#{VALUE.}", "#{VALUE..a}", "#{VALUE.a[]}", "#{VALUE.a[0]xsd}", "#{VALUE.a[a]}", "#{KEY.}", "#{WHAT.a}", "#{TOPIC.x}", "#{TOPIC[0]}", "VALUE.a", "#{}", "#{VALUE.*}", "#{HEADERS.['k']}", "#{VALUE. a}"])
def test_refused(bad):
    with pytest.raises(ValueError):
        parse(bad)


def test_refused_wildcards():
    for bad in ("#{VALUE.a}", "#{OFFSET.*}"):
        with pytest.raises(ValueError):
            parse(bad, wildcard=True)


RECORD = '{"name":"joe","data":[1,2,3,null],"emptyData":[],"map":{"a":1,"b":2},"emptyMap":{},"nullValue":null,"matrix":[[1,2],[4,5]]}'


@pytest.mark.parametrize("wildcard,expected", [
    ("VALUE.*", {"name": "joe", "data": "[1,2,3,null]", "emptyData": "[]", "map": '{"a":1,"b":2}', "emptyMap": "{}", "nullValue": None, "matrix": "[[1,2],[4,5]]"}),
    ("VALUE.data.*", {"data[0]": "1", "data[1]": "2", "data[2]": "3", "data[3]": None}), ("VALUE.emptyData.*", {}), ("VALUE.map.*", {"a": "1", "b": "2"}),
    ("VALUE.emptyMap.*", {}), ("VALUE.matrix.*", {"matrix[0]": "[1,2]", "matrix[1]": "[4,5]"}), ("VALUE.matrix[1].*", {"matrix[1][0]": "4", "matrix[1][1]": "5"}),
    ("VALUE.nullValue.*", {}), ("VALUE.name.*", {}), ("KEY.*", {}), ("HEADERS.*", {"a": "1", "b[0]": "2", "b[1]": "3"}), ("HEADERS.b.*", {"b[0]": "2", "b[1]": "3"})])
def test_wildcards(spark, wildcard, expected):
    headers = F.expr("array(struct('a' as key, cast('1' as binary) as value), struct('b' as key, cast('2' as binary) as value), struct('b' as key, cast('3' as binary) as value))")
    df = as_envelope(spark.createDataFrame([(RECORD,)], ["v"]), "t", "k", F.col("v"), headers=headers)
    assert discover(df, "#{" + wildcard + "}").first()["fields"] == expected


def test_typed(spark):
    df = spark.sql("""select named_struct('name', 'joe', 'signature', cast('abcd' as binary), 'children', array(named_struct('name', 'alex'), null),
        'nullArray', cast(null as array<string>), 'm', map('k', 1)) as v""")
    env = read_structured(df, "t", F.lit("k"), F.col("v"))
    found = results(env, ["VALUE.name", "VALUE.signature", "VALUE.children[0].name", "VALUE.children[1].name", "VALUE.nullArray[0]", "VALUE.children", "VALUE.m.k", "VALUE.m.x", "VALUE.name.x", "VALUE.nope", "VALUE[0]", "VALUE.name[0]"])
    assert [r["text"] or r["reason"] for r in found.values()] == [
        "joe", "[97, 98, 99, 100]", "alex", "null_object", "null_object", "non_scalar", "1", "field_not_found", "scalar_object", "field_not_found", "non_array_object", "not_indexed"]
    with pytest.raises(ValueError):
        read_structured(spark.createDataFrame([("x",)], ["v"]), "t", F.lit("k"), F.col("v"))


def test_kvp_and_precedence(spark):
    text = "QV=9,PV=43, a = 1 ,NOVALUE,NOVALUE2=,x=y=z,=q,a=2"
    df = as_envelope(spark.createDataFrame([(text,)], ["v"]), "t", "k", F.col("v"))
    kvp = Formats(value="KVP")
    assert discover(df, "#{VALUE.*}", formats=kvp).first()["fields"] == {"QV": "9", "PV": "43", "a": "2", "NOVALUE": "", "NOVALUE2": ""}
    both = map_fields(df, {"QV": "#{KEY}"}, "#{VALUE.*}", formats=kvp)
    assert both.first()["fields"]["QV"] == "k"
    assert select_fields(both, " QV  nope ").first()["fields"] == {"QV": "k"}
    assert results(df, ["VALUE.QV", "VALUE[0]", "VALUE.zz"], formats=kvp)["VALUE.zz"]["reason"] == "field_not_found"


def test_skip_failed(joe):
    strict = map_fields(joe, {"a": "#{VALUE.name}", "b": "#{VALUE.zz}"}).first()
    assert strict["fields"] is None and strict["failure"]["expression"] == "#{VALUE.zz}"
    loose = map_fields(joe, {"a": "#{VALUE.name}", "b": "#{VALUE.zz}"}, skip_failed=True).first()
    assert loose["fields"] == {"a": "joe"} and loose["failure"] is None


def test_paths_with_a_common_start_parse_it_once(joe):
    plan = extract(joe, {"a": parse("#{VALUE.name}"), "b": parse("#{VALUE.number}"), "c": parse("#{VALUE.like}")})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(MapType(StringType,StringType,true)") + plan.count("from_json(MapType(StringType,StringType") <= 2


def test_strings_that_look_like_objects_are_scalars(spark):
    values = ['{"a":"{\\"b\\":1}","c":{"b":2}}', '{"a":"[1]","c":{"b":2}}', '{"a":"\\u007b\\"b\\":1}","c":{"b":2}}', '{"a": [ "{", {"b":3} ],"c":{"b":"[x"}}', '{ "a" : "x", "c" : { "b" : "{}" } }']
    df = as_envelope(spark.createDataFrame(list(enumerate(values)), "o long, v string"), "t", F.lit("k"), F.col("v"), offset=F.col("o"))
    rows = map_fields(df, {"a": "#{VALUE.a}"}).orderBy("offset").collect()
    assert [r["fields"]["a"] if r["fields"] else r["failure"]["reason"] for r in rows] == ['{"b":1}', "[1]", '{"b":1}', "non_scalar", "x"]
    rows = map_fields(df, {"b": "#{VALUE.c.b}"}).orderBy("offset").collect()
    assert [r["fields"]["b"] for r in rows] == ["2", "2", "2", "[x", "{}"]
    rows = map_fields(df, {"b": "#{VALUE.a.b}"}).orderBy("offset").collect()
    assert [r["failure"]["reason"] for r in rows] == ["scalar_object"] * 3 + ["array_object", "scalar_object"]
