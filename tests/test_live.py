"""Boards, totals, histories and scrapes that follow a stream, against their batch operators."""

import json
import math
import random
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators import command as C
from sluice.operators import metrics as H
from sluice.plans.pipeline import Changes, Spec, process
from sluice.sources.envelope import as_envelope
from sluice.sources.io import read_files, stream_updates
from sluice.streaming import state as S
from sluice.streaming.kept import KeptBoard
from sluice.streaming.totals import RecordTotals


def add_files(df, path):
    n = len(list(Path(path).glob("*"))) if Path(path).exists() else 0
    df.coalesce(1).write.parquet(f"{path}/{n}")


def test_a_kept_board_follows_the_stream(spark, tmp_path):
    rnd, rows = random.Random(6), []
    for o in range(160):
        item, command = rnd.choice("ij"), rnd.choice(["ADD"] * 6 + ["UPDATE"] * 3 + ["DELETE"] * 3 + ["CS", "EOS"])
        rows.append((o, item, json.dumps({"key": "snapshot" if command in ("CS", "EOS") else rnd.choice("abcdefgh"), "command": command, "v": str(o)})))
    subs = spark.createDataFrame([("s1", "i"), ("s2", "i"), ("s1", "j")], "session string, item string")
    spec = Spec({"i": ["i"], "j": ["j"]}, {"key": "#{VALUE.key}", "command": "#{VALUE.command}", "v": "#{VALUE.v}"}, command="enforce")
    source, board, totals, whole = str(tmp_path / "in"), KeptBoard(str(tmp_path / "board")), RecordTotals(), None
    for step in range(4):
        part = spark.createDataFrame(rows[step * 40 : step * 40 + 40], "o long, item string, v string")
        frame = as_envelope(part, F.col("item"), F.lit("k"), F.col("v"), offset=F.col("o"), timestamp=F.timestamp_seconds("o"))
        add_files(frame, source)
        whole = frame if whole is None else whole.unionByName(frame)
        q = stream_updates(read_files(spark, f"{source}/*"), Changes(subs, spec), str(tmp_path / "out"), str(tmp_path / "cp"), on_error="ignore", board=board, totals=totals)
        q.awaitTermination(120)
        assert q.exception() is None
        updates = process(whole, subs, spec)[0]
        want = C.materialize_board(updates, ("session", "item")).collect()
        key = lambda r: (r["session"], r["item"], r["key"], sorted(r["fields"].items()))
        assert sorted(map(key, board.read(spark, step + 1).collect())) == sorted(map(key, want)) and want
    board.update(spark.read.parquet(str(tmp_path / "out/batch_id=3")), 3)  # run again
    assert sorted(map(key, board.read(spark, 4).collect())) == sorted(map(key, want))
    # The listener hears of the last batch soon after it.
    for _ in range(100):
        if totals.state[0] == 160:
            break
        time.sleep(0.1)
    assert totals.state == (160, updates.count())
    samples = totals.samples(spark)
    assert samples.groupBy("series").agg(F.count("*"), F.max("value")).count() == 2 and samples.count() == 8
    assert {(r["series"], r["value"]) for r in H.keep_last(samples, 1).collect()} == {("received", 160.0), ("processed", float(totals.state[1]))}
    spark.streams.removeListener(totals)


def test_a_clear_writes_one_row(spark, tmp_path):
    board = KeptBoard(str(tmp_path / "b"), ("item",))

    def update(rows, batch):
        df = spark.createDataFrame(rows, "o long, command string, key string").select(
            F.lit("i").alias("item"), F.timestamp_seconds("o").alias("timestamp"), F.lit(0).alias("partition"), F.col("o").alias("offset"), F.create_map(F.lit("command"), "command", F.lit("key"), "key").alias("fields"))
        board.update(df, batch)

    update([(k, "ADD", f"k{k}") for k in range(500)], 0)
    update([(1000, "CS", "snapshot")], 1)
    assert board.read(spark, 1).count() == 500 and board.read(spark, 2).count() == 0
    assert spark.read.parquet(str(tmp_path / "b/rows/run-2-2")).count() == 0 and spark.read.parquet(str(tmp_path / "b/marks/run-2-2")).count() == 1
    for k in range(2, 12):
        update([(1000 + k + j * 100, "ADD", f"new{k}-{j}") for j in range(60)], k)
    assert board.read(spark, 12).count() == 600
    assert sum(spark.read.parquet(str(p)).count() for p in (tmp_path / "b/rows").iterdir()) < 1000  # what was cleared has gone


def samples(spark, rows):
    return spark.createDataFrame(rows, "series string, s double, value double").select("series", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")).alias("ts"), "value")


def test_kept_history_equals_the_batch(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b"]), float(k) + rnd.random(), rnd.choice([None, rnd.random()])) for k in range(400)] + [("c", 5.0, 1.0)]
    rnd.shuffle(rows)
    for step in range(4):
        add_files(samples(spark, rows[step::4]), str(tmp_path / "in"))
        stream = spark.readStream.schema("series string, ts timestamp, value double").parquet(f"{tmp_path}/in/*")
        held = {}

        def hold(df, batch_id):
            for r in df.collect():
                held.setdefault(r["series"], []).append((r["ts"], r["value"]))

        q = S.keep_last_stream(stream, 12).writeStream.outputMode("update").foreachBatch(hold).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None and all(len(x) <= 12 for x in held.values())
        batch = {}
        for r in H.keep_last(samples(spark, [r for k in range(step + 1) for r in rows[k::4]]), 12).collect():
            batch.setdefault(r["series"], []).append((r["ts"], r["value"]))
        assert {s: sorted(x, key=str) for s, x in held.items()} == {s: sorted(batch[s], key=str) for s in held} and {"a", "b"} <= set(held)


@pytest.mark.parametrize("counter", [True, False])
def test_scrapes_of_a_stream(spark, tmp_path, counter):
    """Series a goes quiet while b goes on: its scrapes don't stop."""
    steps = [[("a", 0.5, 1.0), ("a", 3.1, 2.0), ("b", 1.0, 7.0)], [("a", 4.0, None), ("b", 9.0, 8.0), ("a", 3.9, 9.0)], [("b", 31.0, 1.0)], [("b", 40.0, 2.0), ("a", 38.0, 5.0)], [("b", 60.0, 2.0)], [("b", 61.0, 2.0)]]
    for rows in steps:
        add_files(samples(spark, rows), str(tmp_path / "in"))
        stream = spark.readStream.schema("series string, ts timestamp, value double").parquet(f"{tmp_path}/in/*")
        q = S.scrape_stream(stream, 2, "2 seconds", counter).writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
        q.awaitTermination(120)
        assert q.exception() is None
    found = {}
    for r in spark.read.parquet(str(tmp_path / "out")).collect():
        assert (r["series"], r["ts"]) not in found
        found[r["series"], r["ts"]] = r["value"]
    whole = samples(spark, [r for rows in steps for r in rows])
    batch = {(r["series"], r["ts"]): r["value"] for r in (H.sample_counter(whole, 2) if counter else H.sample_gauge(whole, 2)).collect()}
    last = max(t for s, t in found if s == "a")
    same = [k for k in batch if k[1] <= last]
    assert same and all((math.isnan(found[k]) and math.isnan(batch[k])) or found[k] == batch[k] for k in same)
    quiet = sorted((t, v) for (s, t), v in found.items() if s == "a" and 6 <= t.second < 38)
    assert len(quiet) == 16 and all(np.array_equal(v, quiet[0][1], equal_nan=True) for _, v in quiet)
