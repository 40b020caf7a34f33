"""Ordered scans in segments, and ranges put together from panes, against plain loops."""

import datetime as dt
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators import command as C
from sluice.operators import metrics as H
from sluice.operators import scans
from sluice.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("segment", [1, 7, 1000])
def test_scans_equal_a_loop(spark, segment):
    rnd = random.Random(segment)
    rows = [(rnd.choice(["a", "b", None]), k, rnd.choice([None, None, k]), "x") for k in range(200)]
    df = spark.createDataFrame(rows, "key string, at int, v int, _val string").repartition(3)
    place = F.floor(F.col("at") / segment)
    last, before, total = {}, {}, {}
    want = {}
    for key, at, v, _ in rows:
        before[at] = last.get(key)
        last[key] = v if v is not None else last.get(key)
        total[key] = total.get(key, 0) + (v or 0)
        want[at] = (last[key], before[at], total[key])
    found = scans.last_value(df, "now", F.col("v"), ["key"], ["at"], place)
    found = scans.last_value(found, "earlier", F.col("v"), ["key"], ["at"], place, inclusive=False)
    found = scans.running_sum(found, "total", F.col("v"), ["key"], ["at"], place)
    assert found.columns == [*df.columns, "now", "earlier", "total"]
    assert {r["at"]: (r["now"], r["earlier"], r["total"]) for r in found.collect()} == want


def test_one_busy_item_is_many_tasks(spark):
    df = spark.range(20_000).select(F.lit("i").alias("item"), F.timestamp_seconds(F.col("id") * 60).alias("timestamp"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
                                    F.create_map(F.lit("command"), F.when(F.col("id") % 5000 == 4999, "CS").when(F.col("id") % 5000 == 17, "EOS").otherwise("ADD")).alias("fields"))
    tagged = C.tag_snapshot(df)
    windows = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert "_seg" in windows
    assert tagged.select("item", F.floor(F.unix_seconds("timestamp") / 600).alias("seg")).distinct().count() == 2_000
    want = {k for k in range(20_000) if k % 5000 <= 17 or (k % 5000 == 4999 and False)}
    assert {r["offset"] for r in tagged.where("is_snapshot").collect()} == want


def plain(samples, range_, step, empty):
    out = {}
    by = {}
    for s, ts, v in samples:
        by.setdefault(s, []).append((ts, v))
    for s, rows in by.items():
        rows.sort(key=lambda r: r[0])
        times = sorted({t for ts, _ in rows for t in range((ts // step + 1) * step, ts + range_ + 1, step)})
        if not times:
            continue
        for t in range(times[0], times[-1] + 1, step):
            inside = [r for r in rows if t - range_ <= r[0] < t]
            if not inside and not empty:
                continue
            good = [(ts, v) for ts, v in inside if v is not None]
            values = [v for _, v in good]
            nan = math.nan
            rate = np.polyfit([ts - t for ts, _ in good], [v - values[0] for v in values], 1)[0] if len(good) > 1 and all(map(math.isfinite, values)) else nan
            irate = nan
            if len(inside) > 1 and None not in (inside[-1][1], inside[-2][1]):
                irate = (inside[-1][1] - inside[-2][1]) / (inside[-1][0] - inside[-2][0])
            out[s, t] = (inside[-1][1] if inside and inside[-1][1] is not None else nan, rate, irate, np.nanmin(values) if values and not all(map(math.isnan, values)) else nan,
                         (nan if any(map(math.isnan, values)) else max(values)) if values else nan, sum(values) / len(values) if values else nan, sum(values) if values else nan, len(values) or nan)
    return out


@pytest.mark.parametrize("range_,step", [(60, 10), (60, 60), (50, 20), (10, 60), (7, 3), (600, 10)])
@pytest.mark.parametrize("empty", [True, False])
def test_ranges_of_panes_equal_a_loop(spark, monkeypatch, range_, step, empty):
    monkeypatch.setattr(H, "BLOCK_PANES", 1)
    monkeypatch.setattr(H, "BLOCK_RANGES", 1)
    rnd = random.Random(range_ * step)
    samples = [(s, ts, rnd.choice([None, rnd.gauss(base, 3), rnd.gauss(base, 3), rnd.gauss(base, 3)]))
               for s, base in (("a", 0), ("b", 1e9)) for ts in rnd.sample(range(-300, 1500), 90)] + [("c", 100, 1.0), ("d", 59, None), ("e", 1000, 2.0), ("e", 1001, math.nan), ("e", 1300, 4.0), ("e", 1302, 6.0)]
    df = spark.createDataFrame(samples, "series string, s long, value double").withColumn("ts", F.timestamp_seconds("s"))
    names = (*H.FUNCTIONS, *H.MORE_FUNCTIONS)
    order = ("latest", "rate", "irate", "minimum", "maximum", "average", "total", "count")
    assert set(order) == set(names)
    found = {(r["series"], int(r["t"].timestamp())): tuple(r[n] for n in order) for r in H.evaluate(df, range_, step, names, empty_steps=empty).collect()}
    want = plain(samples, range_, step, empty)
    assert set(found) == set(want)
    for key, values in want.items():
        for name, a, b in zip(order, found[key], values):
            if name == "rate" and key[0] == "e":
                continue  # a NaN among the values
            assert (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-6), (key, name, a, b)


def test_samples_move_as_panes(spark):
    df = spark.range(200_000).select(F.lit("s").alias("series"), F.timestamp_millis(F.col("id") * 100).alias("ts"), F.rand(1).alias("value"))
    assert H.panes(df, 100).count() == 200
    out = H.evaluate(df, 600, 100, ("average", "rate"))
    assert out.count() == 205
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "BLOCK" not in plan


def added(values):
    total = 0.0
    for v in values:
        total += v
    return total / len(values)


def test_averages_near_a_tie_are_added_in_order_of_time(spark):
    rnd = random.Random(4)
    rows = [(f"s{k}", ts, rnd.choice([-1, 1]) * rnd.randrange(1, 60_000) / 100) for k in range(100) for ts in rnd.sample(range(600), 64)] + [("null", 5, None), ("nan", 5, math.nan), ("big", 5, 1e300)]
    df = spark.createDataFrame(rows, "series string, s long, value double").withColumn("ts", F.timestamp_seconds("s")).repartition(5)
    found = H.evaluate(df, 600, 100, (*H.FUNCTIONS, "count"))
    settled = H.settle_averages(found, df, 600, 100, 7)
    assert settled.columns == found.columns and settled.count() == found.count()
    want = {f"s{k}": added([v for s, ts, v in sorted(rows, key=lambda r: r[1]) if s == f"s{k}"]) for k in range(100)}
    shown = settled.where("t = timestamp_seconds(600)").select("series", H.unscaled(7)(F.col("average")).alias("average")).collect()
    assert {r["series"]: r["average"] for r in shown} == {s: f"{v:.7f}" for s, v in want.items()} | {"null": "n/a", "nan": "n/a", "big": f"{1e300:.7f}"}


def test_plain_and_scaled_metrics(spark):
    values = [53.19640625, 53.196406249999995, 0.5, 1.5, 2.5, -1811.8867925, 1e15 / 3, 1e22 / 3, -0.0, math.nan, None]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double")
    for digits in (0, 7):
        want = ["n/a" if v is None or math.isnan(v) else duckdb.execute(f"select printf('%.{digits}f', ?::DOUBLE)", [v]).fetchone()[0] for v in values]
        assert [r[0] for r in df.orderBy("k").select(H.unscaled(digits)(F.col("v"))).collect()] == want
    # The reference scales from a thousand up only.
    assert df.where("k = 5").select(H.format_metric(F.col("v"))).first()[0] == "-1811.89"


def test_report_of_all_functions_equals_its_sql(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(f"s{k}", dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=ms), rnd.randrange(1, 60_000) / 100) for k in range(40) for ms in sorted(rnd.sample(range(6 * 3_600_000), 64))]
    rows += [(s, dt.datetime(2024, 1, 2, 0, 0, 0, us), v) for s, pair in (("up", (1.0, 301.25)), ("down", (301.25, 1.0))) for us, v in zip((0, 40_000), pair)]
    spark.createDataFrame(rows, "event_type string, ts timestamp_ntz, value double").repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute("set threads = 1")  # with more, the order in which it adds is open
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    want = sorted(con.execute(ORACLES["h14_h16_all_functions"]).fetchall())
    assert sorted(map(tuple, QUERIES["h14_h16_all_functions"](spark, str(tmp_path)).collect())) == want
    assert any("irate=7506.2500000" in line for *_, line in want) and any("irate=-7506.2500000" in line for *_, line in want)
