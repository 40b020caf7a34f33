"""Change streams, order, metrics and streaming variants."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.functions import decode as D
from sluice.operators import command as C
from sluice.operators import metrics as H
from sluice.operators import ordering as G
from sluice.sources.io import read_files, stream_updates, topic_options
from sluice.streaming import state as S

VALIDITY = [("aKey", "ADD", True), ("aKey", "UPDATE", True), ("aKey", "DELETE", True), ("aKey", "UNKNOWN", False), ("aKey", "", False), ("aKey", "CS", False), ("aKey", "EOS", False),
            ("aKey", None, False), (None, "ADD", False), ("", "DELETE", False), ("snapshot", "CS", True), ("snapshot", "EOS", True), ("snapshot", "ADD", False), ("snapshot", None, False)]


def test_command_validity(spark):
    rows = [({k: v for k, v in (("key", key), ("command", command))}, want) for key, command, want in VALIDITY]
    df = spark.createDataFrame(rows, "fields map<string,string>, want boolean")
    assert df.where(C.command_validity(F.col("fields")) != F.col("want")).count() == 0
    assert spark.createDataFrame([({"x": "1"},)], "fields map<string,string>").where(C.command_validity(F.col("fields"))).count() == 0


CHANGES = [("ADD", "a"), ("ADD", "b"), ("EOS", "snapshot"), ("UPDATE", "a"), ("DELETE", "b"), ("ADD", "b"), ("CS", "snapshot"), ("ADD", "c"), ("EOS", "snapshot"), ("UPDATE", "c"), ("ADD", "d"), ("DELETE", "d")]


def changes(spark):
    rows = [("i", "t", 0, k, {"key": key, "command": c, "v": str(k)}) for k, (c, key) in enumerate(CHANGES)]
    return spark.createDataFrame(rows, "item string, topic string, partition int, offset long, fields map<string,string>").withColumn("timestamp", F.timestamp_seconds("offset"))


def test_snapshot_flags_and_board(spark):
    flags = [r["is_snapshot"] for r in C.tag_snapshot(changes(spark)).orderBy("offset").collect()]
    assert flags == [True, True, True, False, False, False, False, True, True, False, False, False]
    assert [(r["key"], r["fields"]["v"]) for r in C.materialize_board(changes(spark)).collect()] == [("c", "9")]


def test_auto_command(spark):
    rows = [(k, {"key": "a", "v": "1"}, value) for k, value in enumerate(["x", "y", None, "z"])]
    df = spark.createDataFrame(rows, "offset long, fields map<string,string>, value string").withColumns({"item": F.lit("i"), "timestamp": F.timestamp_seconds("offset"), "partition": F.lit(0)})
    gone = F.col("value").isNull()
    assert [r["fields"]["command"] for r in C.auto_command(df, gone).orderBy("offset").collect()] == ["ADD", "ADD", "DELETE", "ADD"]
    tracked = C.auto_command(df, gone, track_keys=True).orderBy("offset").collect()
    assert [r["fields"]["command"] for r in tracked] == ["ADD", "UPDATE", "DELETE", "ADD"]
    assert tracked[2]["fields"] == {"key": "a", "command": "DELETE"}
    with pytest.raises(ValueError):
        C.check_command_fields(["command"], "auto")
    assert C.command_mode(True, True) == "auto"


def streamed(spark, tmp_path, make, frame, mode):
    frame.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    name = f"out_{make.__name__}"
    q = make(stream).writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    return spark.table(name)


def test_snapshot_stream_equals_batch(spark, tmp_path):
    rows = S.changes(changes(spark))
    out = streamed(spark, tmp_path, S.tag_snapshot_stream, rows, "append")
    assert {r["at"]: r["is_snapshot"] for r in out.collect()} == {r["offset"]: r["is_snapshot"] for r in C.tag_snapshot(changes(spark)).collect()}


def test_board_stream_equals_batch(spark, tmp_path):
    out = streamed(spark, tmp_path, S.board_stream, S.changes(changes(spark)), "update")
    left = {r["key"]: json.loads(r["fields"])["v"] for r in out.collect() if r["fields"]}
    assert left == {r["key"]: r["fields"]["v"] for r in C.materialize_board(changes(spark)).collect()}


def test_key_stream(spark, tmp_path):
    out = streamed(spark, tmp_path, S.track_keys_stream, S.changes(changes(spark)).where("key in ('a', 'b')"), "append")
    assert {(r["at"], r["command"]) for r in out.collect()} == {(0, "ADD"), (1, "ADD"), (3, "UPDATE"), (4, "DELETE"), (5, "ADD")}


def test_order_and_offsets(spark):
    df = spark.range(200).select(F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"), ((F.col("id") * 37) % 200).alias("offset"), (F.col("id") % 7).cast("string").alias("key"))
    for scope, lane in (("partition", "partition"), ("key", "key")):
        seen = {}
        for part in G.ordered(df, scope, 4).rdd.glom().collect():
            for r in part:
                at = (r["partition"], r["offset"]) if scope == "key" else r["offset"]
                assert seen.get(r[lane], at) <= at
                seen[r[lane]] = at
    nexts = {r["partition"]: r["next_offset"] for r in G.next_offsets(df, spark.createDataFrame([("t", 0, 999)], "topic string, partition int, offset long")).collect()}
    assert nexts[0] == 999 and nexts[1] <= 200


def samples(spark):
    rng = np.random.default_rng(1)
    times = np.cumsum(rng.integers(1, 90, 80))
    return [("s", int(t), float(v)) for t, v in zip(times, rng.normal(10, 3, 80))]


@pytest.mark.parametrize("span,step", [(120, 60), (60, 90), (100, 30)])
def test_metrics_against_numpy(spark, span, step):
    data = samples(spark)
    df = spark.createDataFrame(data, "series string, s long, value double").withColumn("ts", F.timestamp_seconds("s"))
    for r in H.evaluate(df, span, step, (*H.FUNCTIONS, *H.MORE_FUNCTIONS)).collect():
        t = r["t"].timestamp()
        inside = [(a, v) for _, a, v in data if t - span <= a < t]
        x, v = np.array([a for a, _ in inside], float), np.array([v for _, v in inside])
        want = {"latest": v[-1], "average": v.mean(), "minimum": v.min(), "maximum": v.max(), "total": v.sum(), "count": len(v)} if len(v) else {}
        want["rate"] = np.polyfit(x - x[0], v, 1)[0] if len(v) > 1 else math.nan
        want["irate"] = (v[-1] - v[-2]) / (x[-1] - x[-2]) if len(v) > 1 else math.nan
        for name in (*H.FUNCTIONS, *H.MORE_FUNCTIONS):
            assert np.isclose(r[name], want.get(name, math.nan), equal_nan=True), (name, t)


def test_metric_limits_and_text(spark):
    df = spark.createDataFrame([("s", 1, 1.0)], "series string, s long, value double").withColumn("ts", F.timestamp_seconds("s"))
    with pytest.raises(ValueError):
        H.evaluate(df, 1000, 10, keep=10, every=2)
    shown = spark.sql("select explode(array(1234.5, 2e6, 3.5e9, 12.0, double('nan'))) v").select(H.format_metric(F.col("v"), 2, "msg/s")).collect()
    assert [r[0] for r in shown] == ["1.23k msg/s", "2.00M msg/s", "3.50G msg/s", "12.00 msg/s", "n/a"]


def test_metric_stream(spark, tmp_path):
    frame = spark.createDataFrame(samples(spark), "series string, s long, value double").withColumn("ts", F.timestamp_seconds("s"))
    frame.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    q = H.evaluate_stream(stream, 120, 60, "0 seconds").writeStream.outputMode("append").format("memory").queryName("m").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = {r["t"]: r for r in H.evaluate(frame, 120, 60).collect()}
    rows = spark.table("m").collect()
    assert rows and all(np.isclose(r[n], batch[r["t"]][n], equal_nan=True) for r in rows for n in H.FUNCTIONS)


def test_decoders(spark):
    df = spark.sql("select unhex('00000007') i, unhex('FFFFFFFE') n, unhex('3FF8000000000000') d, unhex('01') b, unhex('FFFE') s, unhex('61FF62') t")
    row = df.select(D.decode(F.col("i"), "INTEGER"), D.decode(F.col("n"), "INTEGER"), D.decode(F.col("d"), "DOUBLE"), D.decode(F.col("b"), "BOOLEAN"), D.decode(F.col("s"), "SHORT"), D.decode(F.col("t"), "STRING")).first()
    assert tuple(row) == (7, -2, 1.5, True, -2, "a�b")
    with pytest.raises(Exception, match="INTEGER"):
        df.select(D.decode(F.col("d"), "INTEGER")).collect()
    with pytest.raises(ValueError):
        D.decode(F.col("d"), "NOPE")
    D.register_format("rot", lambda c: F.reverse(c.cast("string")))
    assert df.select(D.decode(F.lit("ab").cast("binary"), "ROT")).first()[0] == "ba"


def test_raw_bytes_read_as_digits(spark):
    from sluice.functions.paths import Formats
    from sluice.operators.fields import map_fields
    from sluice.sources.envelope import as_envelope

    df = as_envelope(spark.sql("select unhex('00FF') v"), "t", F.lit(None), F.col("v"))
    row = map_fields(df, {"v": "#{VALUE}", "k": "#{KEY}"}, formats=Formats(value="BYTES")).first()
    assert row["fields"] == {"v": "00FF", "k": None}


def test_topic_options():
    assert topic_options(["a", "b", "x"], known_topics=["a", "b"])["subscribe"] == "a,b"
    assert topic_options(pattern=["a.*", "b"])["subscribePattern"] == "(?:a.*)|(?:b)"
    assert topic_options(["a"], start_from="earliest", max_records_per_batch=7)["maxOffsetsPerTrigger"] == "7"
    for bad in ({"topics": ["x"], "known_topics": ["a"]}, {}, {"topics": ["a"], "start_from": "now"}):
        with pytest.raises(ValueError):
            topic_options(**bad)


def test_stream_with_dead_letters(spark, tmp_path):
    from sluice.plans.pipeline import Spec, process
    from sluice.sources.envelope import as_envelope

    rows = spark.createDataFrame([(1, '{"t":"a","v":1}'), (2, '{"t":"a"}')], ["o", "v"])
    as_envelope(rows, "t", "k", F.col("v"), offset=F.col("o")).write.parquet(str(tmp_path / "in"))
    subs = spark.createDataFrame([("s", "i-[t=a]")], ["session", "item"])
    spec = Spec(["i-#{t=VALUE.t}"], {"v": "#{VALUE.v}"})
    q = stream_updates(read_files(spark, str(tmp_path / "in")), lambda df: process(df, subs, spec), str(tmp_path / "out"), str(tmp_path / "cp"), str(tmp_path / "dead"), "dead_letter")
    q.awaitTermination(120)
    assert q.exception() is None
    assert [r["offset"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [1]
    assert [r["reason"] for r in spark.read.parquet(str(tmp_path / "dead")).collect()] == ["field_not_found"]
    with pytest.raises(ValueError):
        stream_updates(read_files(spark, str(tmp_path / "in")), lambda df: (df, df), "x", "y", None, "dead_letter")


def envelope_of(spark, rows, path):
    from pathlib import Path

    from sluice.sources.envelope import as_envelope

    frame = as_envelope(spark.createDataFrame(rows, "o long, k string, v string"), "t", F.col("k"), F.col("v"), offset=F.col("o"), timestamp=F.timestamp_seconds("o"))
    n = len(list(Path(path).glob("*"))) if Path(path).exists() else 0
    frame.repartition(1).write.parquet(f"{path}/{n}")
    return frame


ENFORCED = [("ADD", "a"), ("EOS", "snapshot"), ("UPDATE", "a"), ("ADD", "b"), ("NOPE", "b"), ("CS", "snapshot"), ("ADD", "c"), ("EOS", "snapshot"), ("DELETE", "c")]
AUTO = [("a", "1"), ("b", "1"), ("a", "2"), ("a", None), ("b", "2"), ("a", "3")]


@pytest.mark.parametrize("mode", ["enforce", "auto"])
def test_command_mode_in_batches_equals_one_batch(spark, tmp_path, mode):
    from sluice.functions.paths import Formats
    from sluice.plans.pipeline import Changes, Spec, process

    subs = spark.createDataFrame([("s1", "i"), ("s2", "i")], "session string, item string")
    if mode == "enforce":
        rows = [(k, "x", json.dumps({"command": c, "key": key})) for k, (c, key) in enumerate(ENFORCED)]
        spec = Spec(["i"], {"key": "#{VALUE.key}", "command": "#{VALUE.command}"}, command="enforce")
    else:
        rows = [(k, key, v) for k, (key, v) in enumerate(AUTO)]
        spec = Spec(["i"], {"key": "#{KEY}", "v": "#{VALUE}"}, command="auto", track_keys=True, formats=Formats(value="STRING"))
    source, whole = str(tmp_path / "in"), None
    for some in (rows[:2], rows[2:5], rows[5:6], rows[6:]):
        if some:
            frame = envelope_of(spark, some, source)
            whole = frame if whole is None else whole.unionByName(frame)
            q = stream_updates(read_files(spark, f"{source}/*"), Changes(subs, spec), str(tmp_path / "out"), str(tmp_path / "cp"), on_error="ignore")
            q.awaitTermination(120)
            assert q.exception() is None
    shown = ["session", "offset", "event_kind", "is_snapshot", "fields"]
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.select("batch_id").distinct().count() >= 3
    key = lambda r: (r["session"], r["offset"], r["event_kind"], r["is_snapshot"], sorted(r["fields"].items(), key=str))
    assert sorted(map(key, found.select(*shown).collect())) == sorted(map(key, process(whole, subs, spec)[0].select(*shown).collect()))
    with pytest.raises(ValueError):
        process(read_files(spark, f"{source}/*"), subs, spec)


def test_stream_policies(spark, tmp_path):
    from sluice.plans.pipeline import Spec, process

    subs = spark.createDataFrame([("s", "i-[t=a]")], "session string, item string")
    envelope_of(spark, [(1, "k", '{"t":"a","v":1}'), (2, "k", '{"t":"a"}'), (3, "k", '{"t":"a","v":3}')], str(tmp_path / "in"))
    spec = Spec(["i-#{t=VALUE.t}"], {"v": "#{VALUE.v}"})
    run = lambda name, **rest: stream_updates(read_files(spark, str(tmp_path / "in" / "0")), lambda df: process(df, subs, spec), str(tmp_path / name), str(tmp_path / f"cp-{name}"), **rest)
    for bad in ({"on_error": "dead_leter"}, {"on_error": "force_unsubscribe"}, {"on_error": "dead_letter"}):
        with pytest.raises(ValueError):
            run("bad", **bad)
    for again in (1, 2):  # a replayed batch changes nothing
        q = run("gone", on_error="force_unsubscribe", subs=subs)
        with pytest.raises(Exception, match="unsubscribed"):
            q.awaitTermination(120)
        rows = spark.read.parquet(str(tmp_path / "gone")).collect()
        assert sorted((r["event_kind"], r["offset"] or 0) for r in rows) == [("unsubscribed", 0), ("update", 1)], again
    with pytest.raises(Exception, match="record failed"):
        run("stop", on_error="terminate").awaitTermination(120)
    assert not (tmp_path / "stop").exists()
    q = run("left", on_error="ignore")
    q.awaitTermination(120)
    assert sorted(r["offset"] for r in spark.read.parquet(str(tmp_path / "left")).collect()) == [1, 3]


def test_payloads_that_do_not_decode(spark, tmp_path):
    from sluice.plans.pipeline import Spec, process

    subs = spark.createDataFrame([("s", "i")], "session string, item string")
    frame = envelope_of(spark, [(1, "k", '{"v":1}'), (2, "k", '{"v":'), (3, "k", '{"w":1}')], str(tmp_path / "in"))
    with pytest.raises(Exception, match="malformed JSON"):
        process(frame, subs, Spec(["i"], {"v": "#{VALUE.v}"}))[0].collect()
    updates, errors = process(frame, subs, Spec(["i"], {"v": "#{VALUE.v}"}, on_decode_error="dead_letter"))
    assert [r["offset"] for r in updates.collect()] == [1]
    assert sorted((r["offset"], r["stage"], r["reason"]) for r in errors.collect()) == [(2, "decode", "malformed"), (3, "field", "field_not_found")]
    with pytest.raises(ValueError):
        Spec(["i"], {"v": "#{VALUE.v}"}, on_decode_error="ignore")


def test_columns_named_like_helpers_stay(spark):
    from sluice.operators.fields import map_fields
    from sluice.operators.routing import expand_templates
    from sluice.sources.envelope import as_envelope

    df = as_envelope(spark.createDataFrame([('{"v":1}',)], "v string"), "t", F.lit("k"), F.col("v")).withColumns({c: F.lit(c) for c in ("_f0", "_d0", "_t0", "_F1")})
    for out in (map_fields(df, {"v": "#{VALUE.v}"}, "#{VALUE.*}"), expand_templates(df, ["i-#{v=VALUE.v}"])):
        row = out.first()
        assert (row["_f0"], row["_d0"], row["_t0"], row["_F1"]) == ("_f0", "_d0", "_t0", "_F1")


def test_floating_payloads_are_exact(spark):
    import struct

    values = [0.0, -0.0, 1.0, -2.5, 3.141592653589793, 1e308, 5e-324, 2.2250738585072014e-308, -1e-310, float("inf"), float("-inf"), float("nan"), 0.1]
    singles = [0.0, -0.0, 1.5, -3.25, 3.4e38, 1e-45, 1.1754944e-38, float("inf"), float("nan"), 0.1]
    df = spark.createDataFrame([(struct.pack(">d", v), "d") for v in values] + [(struct.pack(">f", v), "f") for v in singles] + [(None, "d")], "b binary, k string")
    for kind, fmt, given in (("d", "DOUBLE", values), ("f", "FLOAT", singles)):
        found = [r[0] for r in df.where(F.col("k") == kind).select(D.decode(F.col("b"), fmt)).collect()]
        for x, y in zip(given, found):
            want = x if fmt == "DOUBLE" else struct.unpack(">f", struct.pack(">f", x))[0]
            assert struct.pack(">d", want) == struct.pack(">d", y) or (math.isnan(want) and math.isnan(y)), (want, y)
    assert found and df.where("b is null").select(D.decode(F.col("b"), "DOUBLE")).first()[0] is None


def test_nested_schemas(spark):
    line = {"type": "object", "required": ["p"], "properties": {"p": {"type": "integer", "minimum": 1, "exclusiveMaximum": 10}}, "additionalProperties": False}
    schema = {"properties": {"lines": {"type": "array", "minItems": 1, "maxItems": 2, "items": line}, "name": {"type": ["string", "null"], "maxLength": 3, "pattern": "^a"},
                             "sub": {"required": ["deep"], "properties": {"deep": {"properties": {"x": {"enum": [True, 2, "s", None]}}}}}}}
    cases = {
        '{"lines":[{"p":1},{"p":9}],"name":"abc","sub":{"deep":{"x":2}}}': None, '{"name":null}': None, '{"name":7}': "type: name", '{"name":"abcd"}': "maxLength: name", '{"name":"b"}': "pattern: name",
        '{"lines":{}}': "type: lines", '{"lines":[]}': "minItems: lines", '{"lines":[{"p":1},{"p":1},{"p":1}]}': "maxItems: lines", '{"lines":[{"p":1},{"p":10}]}': "exclusiveMaximum: lines[].p",
        '{"lines":[{"p":0}]}': "minimum: lines[].p", '{"lines":[{}]}': "required: lines[].p", '{"lines":[{"p":1,"q":2}]}': "additional: lines[].q", '{"lines":[3]}': "type: lines[]", '{"lines":[{"p":"1"}]}': "type: lines[].p",
        '{"sub":{}}': "required: sub.deep", '{"sub":{"deep":{"x":"t"}}}': "enum: sub.deep.x", '{"sub":{"deep":{"x":true}}}': None, '{"sub":{"deep":{"x":null}}}': None, '{"sub":{"deep":{"x":"2"}}}': "enum: sub.deep.x",
        "[1]": "not an object", '"x"': "not an object", "{": "not an object", "{}": None,
    }
    rows = spark.createDataFrame([(t,) for t in cases], ["t"]).select("t", D.json_schema_violation(F.col("t"), schema).alias("v")).collect()
    assert {r["t"]: r["v"] for r in rows} == cases
    for refused in ({"oneOf": []}, {"properties": {"a": {"not": {}}}}, {"properties": {"a": {"type": "date"}}}, {"type": "array"}, {"additionalProperties": {}}):
        with pytest.raises(ValueError):
            D.json_schema_violation(F.col("t"), refused)
