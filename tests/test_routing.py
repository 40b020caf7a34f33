"""Golden routing table, canonical names, templates and admission."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.operators import errors as E
from sluice.operators import routing as R
from sluice.plans.pipeline import Spec, process
from sluice.sources.envelope import as_envelope

JOE = '{"name":"joe","children":[{"name":"alex"},{"name":"anna","children":[{"name":"gloria"},{"name":"terence"}]}]}'
C3 = "complex-item-#{keyName=KEY,name=VALUE.name,child=VALUE.children[0].name}"
ROUTING = [
    (C3, "complex-[name=joe]", False, False), (C3, "complex-item-[name=joe]", False, False), (C3, "complex-item", False, False), (C3, "complex-item-", False, False),
    (C3, "complex-item-[keyName=joe,name=joe,child=alex]", True, True), (C3, "complex-item-[name=joe,keyName=joe,child=alex]", True, True),
    ("complex-item-#{keyName=KEY,child=VALUE.children[1].children[0].name}", "complex-item-[keyName=joe,child=gloria]", True, True),
    ("complex-item-#{keyName=KEY,child=VALUE.children[1].children[1].name}", "complex-item-[keyName=joe,child=carol]", True, False),
    ("complex-item-#{header=HEADERS.header-key1}", "complex-item-[header=header-value1]", True, True),
    ("complex-item-#{header=HEADERS['header-key1']}", "complex-item-[header=header-value1]", True, True),
    ("complex-item-#{header=HEADERS[1]}", "complex-item-[header=header-value]", True, False),
    ("item-#{ts=TIMESTAMP,partition=PARTITION}", "item-[ts=-1]", False, False), ("item-#{ts=TIMESTAMP,partition=PARTITION}", "item-[ts=-1,partition=150]", True, True),
    ("item-#{ts=TIMESTAMP,partition=PARTITION}", "item-[partition=150,ts=1]", True, False),
]


@pytest.fixture(scope="module")
def record(spark):
    headers = F.expr("array(struct('header-key1' as key, cast('header-value1' as binary) as value), struct('header-key2' as key, cast('header-value2' as binary) as value))")
    return as_envelope(spark.createDataFrame([(JOE,)], ["v"]), "topic", "joe", F.col("v"), 150, 1, F.timestamp_millis(F.lit(-1)), headers).cache()


def test_routing_table(spark, record):
    for template in dict.fromkeys(t for t, *_ in ROUTING):
        mine = [(item, s, r) for t, item, s, r in ROUTING if t == template]
        subs = spark.createDataFrame([(i,) for i, _, _ in mine], ["item_text"])
        good, bad = R.match_templates(subs, [template])
        assert {r["item_text"] for r in good.collect()} == {i for i, s, _ in mine if s}
        assert {r["item_text"] for r in bad.collect()} == {i for i, s, _ in mine if not s}
        routed = R.route(R.expand_templates(record, [template]), good)
        assert {r["item_text"] for r in routed.collect()} == {i for i, _, r in mine if r}


def test_canonical(spark):
    cases = {"item-[c=3,a=1,b=2]": "item-[a=1,b=2,c=3]", "item-[key=val=ue]": "item-[key=val=ue]", "item-[]": "item", "item-": "item-", "item-[a=1,a=2]": None, "item-[a]": None, " ": None, "i-[a1=,a=2]": "i-[a=2,a1=]"}
    rows = spark.createDataFrame([(t,) for t in cases], ["t"]).select("t", R.canonical_item(F.col("t"))["item"].alias("i")).collect()
    assert {r["t"]: r["i"] for r in rows} == cases


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.from_regex(r"[a-z][a-z0-9]{0,3}", fullmatch=True), st.from_regex(r"[a-z0-9]{0,4}", fullmatch=True), min_size=1, max_size=5), st.randoms())
def test_order_of_parameters_does_not_matter(spark, params, rnd):
    swapped = list(params.items())
    rnd.shuffle(swapped)
    text = "p-[" + ",".join(f"{k}={v}" for k, v in swapped) + "]"
    want = "p-[" + ",".join(f"{k}={params[k]}" for k in sorted(params)) + "]"
    assert spark.range(1).select(R.canonical_item(F.lit(text))["item"]).first()[0] == want


def test_templates(record):
    one = R.expand_templates(record, ["a-#{x=VALUE.children[0].name}", "a-#{x=VALUE['children'][0].name}", "plain"]).first()
    assert one["items"] == ["a-[x=alex]", "plain"]
    bad = R.expand_templates(record, ["plain", "b-#{x=VALUE.zz}"]).first()
    assert bad["items"] is None and bad["failure"]["reason"] == "field_not_found"
    for text in ("", "a-#{}", "a-#{x}", "a-#{x=KEY,x=TOPIC}", "a-#{x=VALUE.*}", "a-#{x=VALUE..b}"):
        with pytest.raises(ValueError):
            R.parse_template(text)


def test_null_parameters(spark):
    df = as_envelope(spark.createDataFrame([('{"a":null,"b":"x"}',)], ["v"]), "t", "k", F.col("v"))
    assert R.expand_templates(df, ["i-#{a=VALUE.a}"]).first()["items"] == ["i-[a=null]"]
    assert R.expand_templates(df, ["i-#{a=VALUE.a,b=VALUE.b}"]).first()["failure"]["reason"] == "null_parameter"


def test_topics(spark):
    df = spark.createDataFrame([("topic1",), ("topic2",), ("other",), ("xtopic1",)], ["topic"])
    mapping = spark.createDataFrame([("topic1", "a"), ("topic1", "b"), ("topic2", "a")], ["topic", "item_ref"])
    assert sorted(map(tuple, R.route_topics(df, mapping).collect())) == [("topic1", "a"), ("topic1", "b"), ("topic2", "a")]
    patterns = spark.createDataFrame([("topic[0-9]", "a"), ("topic1|other", "b")], ["topic", "item_ref"])
    assert sorted(map(tuple, R.route_topics(df, patterns, regex=True).collect())) == [("other", "b"), ("topic1", "a"), ("topic1", "b"), ("topic2", "a")]


def test_subscription_log(spark):
    log = spark.createDataFrame([("s1", "a", "subscribe", 1), ("s1", "a", "unsubscribe", 2), ("s1", "b", "subscribe", 3), ("s2", "a", "subscribe", 4)], ["session", "item", "action", "seq"])
    assert sorted((r["item"], r["session"]) for r in R.active_subscriptions(log).collect()) == [("a", "s2"), ("b", "s1")]
    assert {r["session"]: r["items"] for r in R.items_by_session(log).collect()} == {"s1": ["b"], "s2": ["a"]}
    assert R.subscription_intervals(log).count() == 3


def test_fields_only_for_routed_records(spark):
    df = as_envelope(spark.createDataFrame([(1, '{"t":"a","v":1}'), (2, '{"t":"b"}')], ["o", "v"]), "t", "k", F.col("v"), offset=F.col("o"))
    subs = spark.createDataFrame([("s", "i-[t=a]"), ("r", "i-[t=a]")], ["session", "item"])
    for mode, errors in (("routed", 0), ("always", 1)):
        updates, bad = process(df, subs, Spec(["i-#{t=VALUE.t}"], {"v": "#{VALUE.v}"}, evaluate_fields=mode))
        assert (updates.count(), bad.count()) == (2, errors)


def test_policies(spark, record):
    bad = R.expand_templates(record, ["b-#{x=VALUE.zz}"])
    assert E.apply_policy(bad, "ignore")[0].count() == 0
    assert E.apply_policy(bad, "dead_letter", sink="x")[1].first()["message"] == "Field [zz] not found"
    kept, ended = E.apply_policy(bad, "force_unsubscribe", subs=spark.createDataFrame([("a",), ("b",)], ["item"]))
    assert kept.count() == 0 and {r["item"] for r in ended.collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        E.apply_policy(bad, "dead_letter")
    with pytest.raises(Exception, match="zz"):
        E.apply_policy(bad, "terminate")[0].collect()


def test_subscriptions_get_the_records_of_their_time(spark):
    df = spark.createDataFrame([(k, k, ["a", "b"]) for k in range(6)], "offset int, s int, items array<string>").withColumn("timestamp", F.timestamp_seconds("s"))
    log = [("x", "a", "subscribe", 2), ("x", "a", "unsubscribe", 4), ("x", "a", "subscribe", 5), ("y", "a", "subscribe", 0), ("x", "b", "unsubscribe", 1)]
    frame = spark.createDataFrame(log, ["session", "item", "action", "at"]).withColumn("at", F.timestamp_seconds("at"))
    subs = R.subscription_intervals(frame, "at", ("session", "item"), ("from_time", "to_time"))
    routed = R.route(df, subs)
    assert routed.columns == ["item", "offset", "s", "timestamp", "session"]
    assert sorted((r["session"], r["offset"]) for r in routed.collect()) == [("x", 2), ("x", 3), ("x", 5), *[("y", k) for k in range(6)]]


def test_intervals_meet_few_records_that_are_not_theirs(spark):
    """10,000 intervals of lengths from a second to months on one item: results equal a plain comparison, candidates stay near them."""
    rnd, day = random.Random(3), 86400
    rows = [("s%d" % k, "a", begin := rnd.randrange(200 * day), begin + int(8 ** rnd.uniform(0, 7))) for k in range(10_000)]
    rows += [("open", "a", None, 5 * day), ("open", "a", 190 * day, None), ("ever", "a", None, None), ("none", "a", 7, 7), ("back", "a", 9, 8), ("other", "b", 0, 200 * day)]
    subs = spark.createDataFrame(rows, "session string, item string, f long, t long").select("session", "item", F.timestamp_seconds("f").alias("from_time"), F.timestamp_seconds("t").alias("to_time"))
    times = [rnd.randrange(200 * day) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(times)), "offset int, s long").select("offset", F.timestamp_seconds("s").alias("timestamp"), F.array(F.lit("a")).alias("items"), F.lit(1).alias("_from"))
    routed = R.route(df, subs)
    assert routed.columns == ["item", "offset", "timestamp", "_from", "session"]
    want = Counter((s, k) for s, item, f, t in rows for k, at in enumerate(times) if item == "a" and (f is None or at >= f) and (t is None or at < t) and not (f is not None and t is not None and t <= f))
    assert Counter((r["session"], r["offset"]) for r in routed.collect()) == want
    # Rows the equality join makes, before times are compared.
    levels = [R.RADIX**k for k in range(R.LEVELS)]
    met = 0
    for _, item, f, t in rows:
        if item == "a" and f is not None and t is not None and t > f:
            w = next(x for x in levels if t - f <= x)
            met += sum(f // w <= at // w <= (t - 1) // w for at in times)
    assert met < 20 * sum(want.values()) and met < 0.2 * len(rows) * len(times)


def test_wanted_records_do_not_move(spark, tmp_path):
    rows = [(k, [f"i{k % 7}", f"j{k % 5}"][: k % 3] if k % 4 else None) for k in range(60)]
    df = spark.createDataFrame(rows, "offset int, items array<string>").select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset", "items", F.lit("x").alias("_hit0"), F.lit("y").alias("_item"))
    subs = spark.createDataFrame([("i3",), ("j1",), ("i3",), (None,)], "item string")
    wanted = {k for k, items in rows if {"i3", "j1"} & set(items or [])}
    for most in (2, None):
        kept, left = R.filter_routed(df, subs, most), R.unrouted(df, subs, most)
        assert kept.columns == left.columns == df.columns
        assert {r["offset"] for r in kept.collect()} == wanted and {r["offset"] for r in left.collect()} == set(range(60)) - wanted
    plan = R.filter_routed(df, subs, 2)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and plan.count("BroadcastHashJoin") == 2
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = R.filter_routed(stream, subs, 2).writeStream.format("memory").queryName("wanted").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r["offset"] for r in spark.sql("select * from wanted").collect()} == wanted
    with pytest.raises(ValueError):
        R.filter_routed(stream, subs)
