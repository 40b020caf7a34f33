"""Kept tables, subscriptions that change while a stream runs, and the runner's single pass."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluice.functions.paths import Formats
from sluice.operators import routing as R
from sluice.plans.pipeline import Changes, Spec, process
from sluice.sources.envelope import as_envelope
from sluice.sources.io import read_files, stream_updates
from sluice.streaming.kept import KeptTable, LiveSubscriptions


def size_of(path):
    return sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))


def test_kept_table_equals_a_dict_and_writes_what_changes(spark, tmp_path):
    table, rnd, want = KeptTable(str(tmp_path / "kept"), "a string, b string", "v int"), random.Random(4), {}
    table.start(spark, spark.createDataFrame([("x", None, 0), (None, "y", 1)], "a string, b string, v int"))
    want = {("x", None): 0, (None, "y"): 1}
    states = [dict(want)]
    for state in range(1, 14):
        table.merge(spark, state - 1)
        changed = {(rnd.choice(["x", "z", None]), rnd.choice(["y", None, "q"])): (rnd.randrange(99), rnd.random() < 0.4) for _ in range(rnd.randrange(4))}
        rows = [(*k, v, gone) for k, (v, gone) in changed.items()]
        for again in range(1 + state % 2):  # written again it replaces itself
            table.write(spark.createDataFrame(rows, "a string, b string, v int, gone boolean"), state)
        for k, (v, gone) in changed.items():
            want.pop(k, None) if gone else want.__setitem__(k, v)
        states.append(dict(want))
        for back in {state, state - 1}:
            assert {(r["a"], r["b"]): r["v"] for r in table.read(spark, back).collect()} == states[back]
    assert len(list((tmp_path / "kept").iterdir())) <= 8
    with pytest.raises(ValueError):
        table.read(spark, 99)


def test_a_batch_writes_what_it_changes_not_what_is_kept(spark, tmp_path):
    table = KeptTable(str(tmp_path / "kept"), "key string")
    table.start(spark, spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("key")))
    whole, added = size_of(tmp_path / "kept"), 0
    for state in range(1, 9):
        table.merge(spark, state - 1)
        before = {f: f.stat().st_size for f in (tmp_path / "kept").rglob("*.parquet")}
        table.write(spark.createDataFrame([(f"new{state}", False)], "key string, gone boolean"), state)
        added += sum(f.stat().st_size for f in (tmp_path / "kept").rglob("*.parquet") if f not in before)
    assert added < whole / 100 and size_of(tmp_path / "kept") < 1.1 * whole
    assert table.read(spark, 8).count() == 200_008


def records(spark, rows, path=None):
    frame = as_envelope(spark.createDataFrame(rows, "o long, k string, v string"), "t", F.col("k"), F.col("v"), offset=F.col("o"), timestamp=F.timestamp_seconds("o"))
    if path:
        n = len(list(Path(path).glob("*"))) if Path(path).exists() else 0
        frame.repartition(1).write.parquet(f"{path}/{n}")
    return frame


def entries(spark, rows, path=None):
    frame = spark.createDataFrame(rows, "session string, item string, action string, s long").withColumn("ts", F.timestamp_seconds("s"))
    if path:
        frame.coalesce(1).write.mode("append").parquet(path)
    return frame


@pytest.mark.parametrize("mode", [None, "enforce", "auto"])
@pytest.mark.parametrize("lateness", [None, 0])
def test_live_subscriptions_equal_the_whole_log(spark, tmp_path, mode, lateness):
    """A late subscriber, a leaver, one who comes back, and one who re-subscribes, over several micro-batches."""
    steps = [
        ([("a", "i", "subscribe", 0), ("b", "i", "subscribe", 2)], [(1, "k", 1), (2, "k", 2), (3, "l", 3)]),
        ([("c", "i", "subscribe", 5), ("b", "i", "unsubscribe", 6)], [(5, "k", 4), (6, "m", 5), (7, "l", 6)]),
        ([], [(8, "k", 7)]),
        ([("b", "i", "subscribe", 10), ("c", "i", "subscribe", 11), ("a", "i", "unsubscribe", 11), ("d", "other", "subscribe", 1)], [(9, "k", 8), (10, "k", 9), (11, "l", 10), (12, "n", 11)]),
    ]
    if mode == "enforce":
        commands = iter(["ADD", "ADD", "EOS", "UPDATE", "DELETE", "CS", "ADD", "EOS", "UPDATE", "ADD", "ADD"])
        body = lambda k, v: json.dumps({"key": "snapshot" if (c := next(commands)) in ("EOS", "CS") else k, "command": c})
        spec = Spec(["i"], {"key": "#{VALUE.key}", "command": "#{VALUE.command}"}, command="enforce")
    elif mode == "auto":
        body = lambda k, v: None if v in (4, 7) else str(v)
        spec = Spec(["i"], {"key": "#{KEY}", "v": "#{VALUE}"}, command="auto", track_keys=True, formats=Formats(value="STRING"))
    else:
        body, spec = lambda k, v: str(v), Spec(["i"], {"v": "#{VALUE}"}, formats=Formats(value="STRING"))
    log, source, out = (str(tmp_path / n) for n in ("log", "in", "out"))
    whole_log = whole = None
    for said, rows in steps:
        if said:
            part = entries(spark, said, log)
            whole_log = part if whole_log is None else whole_log.unionByName(part)
        part = records(spark, [(o, k, body(k, v)) for o, k, v in rows], source)
        whole = part if whole is None else whole.unionByName(part)
        q = stream_updates(read_files(spark, f"{source}/*"), Changes(LiveSubscriptions(log, lateness=lateness), spec), out, str(tmp_path / "cp"), on_error="ignore")
        q.awaitTermination(120)
        assert q.exception() is None
    subs = R.subscription_intervals(whole_log.drop("s"), "ts", ("session", "item"), ("from_time", "to_time"))
    shown = ["session", "offset", "event_kind", "is_snapshot", "fields"]
    key = lambda r: str((r["session"], r["offset"], r["event_kind"], r["is_snapshot"], sorted((r["fields"] or {}).items(), key=str)))
    found = spark.read.parquet(out)
    assert found.select("batch_id").distinct().count() == len(steps)
    want = process(whole, subs, spec)[0].select(*shown).collect()
    assert sorted(map(key, found.select(*shown).collect())) == sorted(map(key, want)) and {r["session"] for r in want} == {"a", "b", "c"}
    kept = KeptTable(str(tmp_path / "cp-kept-subscriptions"), "session string, item string, from_time timestamp", "to_time timestamp").read(spark, len(steps))
    if lateness is None:
        assert sorted(map(str, kept.collect())) == sorted(map(str, subs.select("session", "item", "from_time", "to_time").collect()))
    else:  # what has ended long ago isn't kept
        assert 0 < kept.count() < subs.count()


def test_a_batch_run_again_sees_the_same_log_and_state(spark, tmp_path):
    log, kept = str(tmp_path / "log"), str(tmp_path / "kept")
    entries(spark, [("a", "i", "subscribe", 1)], log)
    batch, live = records(spark, [(1, "k", "v")]), LiveSubscriptions(log)
    first = sorted(map(str, live.at(batch, kept, 0).collect()))
    entries(spark, [("b", "i", "subscribe", 2), ("a", "i", "unsubscribe", 3)], log)
    assert sorted(map(str, live.at(batch, kept, 0).collect())) == first and len(first) == 1
    assert {(r["session"], r["to_time"] is None) for r in live.at(batch, kept, 1).collect()} == {("a", False), ("b", True)}
    assert [r["session"] for r in live.active(live.at(batch, kept, 1)).collect()] == ["b"]


def test_a_stream_with_live_subscriptions_unsubscribes_those_that_stand(spark, tmp_path):
    entries(spark, [("a", "i-[t=a]", "subscribe", 0), ("b", "i-[t=a]", "subscribe", 0), ("b", "i-[t=a]", "unsubscribe", 1)], str(tmp_path / "log"))
    records(spark, [(1, "k", '{"t":"a","v":1}'), (2, "k", '{"t":"a"}')], str(tmp_path / "in"))
    spec = Spec(["i-#{t=VALUE.t}"], {"v": "#{VALUE.v}"})
    q = stream_updates(read_files(spark, str(tmp_path / "in" / "0")), Changes(LiveSubscriptions(str(tmp_path / "log")), spec), str(tmp_path / "out"), str(tmp_path / "cp"), on_error="force_unsubscribe")
    with pytest.raises(Exception, match="unsubscribed"):
        q.awaitTermination(120)
    assert sorted((r["session"], r["event_kind"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", "unsubscribed"), ("a", "update")]


def test_what_several_sinks_read_is_decoded_once(spark):
    frame = records(spark, [(1, "k", '{"t":"a","v":1}'), (2, "k", '{"t":"a"}')])
    subs, held = spark.createDataFrame([("s", "i-[t=a]")], "session string, item string"), []

    def hold(df):
        held.append(df.persist())
        return held[-1]

    updates, errors, _ = Changes(subs, Spec(["i-#{t=VALUE.t}"], {"v": "#{VALUE.v}"}))(frame, None, hold=hold)
    for df in held:
        df.count()
    for side in (updates, errors):
        plan = side._jdf.queryExecution().executedPlan().toString()
        above = plan.split("InMemoryRelation")[0]
        assert "InMemoryTableScan" in above and "Generate" not in above
    assert [r["offset"] for r in updates.collect()] == [1] and [r["offset"] for r in errors.collect()] == [2]
    for df in held:
        df.unpersist()
