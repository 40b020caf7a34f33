"""Change streams with state: snapshot flags, seen keys and boards by ``transformWithStateInPandas``.

State needs the RocksDB provider (``spark.sql.streaming.stateStore.providerClass``). Keys' state is cleared on DELETE or CS.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SAMPLE = "series string, ts timestamp, value double"
ROW = "item string, key string, command string, fields string, at long"


def changes(updates: DataFrame, order: str = "offset") -> DataFrame:
    """Updates as the processors take them: item, key, command, fields (JSON), at."""
    return updates.select("item", F.col("fields")["key"].alias("key"), F.col("fields")["command"].alias("command"), F.to_json("fields").alias("fields"), F.col(order).cast("long").alias("at"))


def _in_order(batches: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(batches)).sort_values("at", kind="stable")


class SnapshotTagger(StatefulProcessor):
    """Whether each row of an item belongs to its snapshot."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ended = handle.getValueState("ended", "ended boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _in_order(rows)
        ended = bool(self.ended.get()[0]) if self.ended.exists() else False
        flags = []
        for command in frame["command"]:
            flags.append(not ended)
            ended = {"EOS": True, "CS": False}.get(command, ended)
        self.ended.update((ended,))
        yield frame.assign(is_snapshot=flags)

    def close(self) -> None:
        pass


class KeyTracker(StatefulProcessor):
    """ADD for a new key of an item, UPDATE for one seen since its last DELETE."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _in_order(rows)
        seen, commands = self.seen.exists(), []
        for command in frame["command"]:
            gone = command == "DELETE"
            commands.append("DELETE" if gone else "UPDATE" if seen else "ADD")
            seen = not gone
        if seen:
            self.seen.update((True,))
        else:
            self.seen.clear()
        fields = [json.dumps({**json.loads(f), "command": c}) for f, c in zip(frame["fields"], commands)]
        yield frame.assign(command=commands, fields=fields)

    def close(self) -> None:
        pass


class Board(StatefulProcessor):
    """The current row of each key of an item: rows changed in a batch, ``fields`` null if gone."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getMapState("rows", "key string", "fields string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        changed: dict[str, str | None] = {}
        for row in _in_order(rows).itertuples():
            if row.command == "CS":
                for (name,) in list(self.rows.keys()) if self.rows.exists() else []:
                    changed[name] = None
                if self.rows.exists():
                    self.rows.clear()
            elif row.command == "DELETE":
                changed[row.key] = None
                if self.rows.exists() and self.rows.containsKey((row.key,)):
                    self.rows.removeKey((row.key,))
            elif row.command in ("ADD", "UPDATE"):
                fields = json.dumps({k: v for k, v in json.loads(row.fields).items() if k != "command"})
                changed[row.key] = fields
                self.rows.updateValue((row.key,), (fields,))
        yield pd.DataFrame({"item": [key[0]] * len(changed), "key": list(changed), "fields": list(changed.values())})

    def close(self) -> None:
        pass


def _samples(rows: list[tuple]) -> pd.DataFrame:
    """Rows of SAMPLE, typed even where there is none."""
    return pd.DataFrame(rows, columns=["series", "ts", "value"]).astype({"series": object, "ts": "datetime64[us]", "value": float})


class SampleRing(StatefulProcessor):
    """The latest ``n`` samples of a series, and no more, in list state."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", "ts timestamp, value double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = pd.DataFrame([tuple(r) for r in self.ring.get()] if self.ring.exists() else [], columns=["ts", "value"])
        for frame in rows:  # a batch of any size passes through in parts
            kept = pd.concat([kept, frame[["ts", "value"]]]).sort_values("ts", kind="stable").tail(self.n)
        self.ring.put([(ts.to_pydatetime(), None if pd.isna(v) else float(v)) for ts, v in zip(kept["ts"], kept["value"])])
        yield kept.assign(series=key[0])[["series", "ts", "value"]]

    def close(self) -> None:
        pass


class ScrapeClock(StatefulProcessor):
    """A counter or gauge of a series read at each scrape that the watermark has passed, quiet or not."""

    def __init__(self, every: int, counter: bool):
        self.every, self.counter = every * 1000, counter

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        #: What came in each scrape interval that isn't read yet: by its end, how many events, and the latest one's time and value.
        self.open = handle.getMapState("open", "tick bigint", "n bigint, ts bigint, value double")
        self.last = handle.getValueState("last", "tick bigint, value double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        done = self.last.get()[0] if self.last.exists() else None
        for frame in rows:
            micros = frame["ts"].astype("datetime64[us]").astype("int64")
            ticks = (micros // (self.every * 1000) + 1) * self.every
            if done is not None:  # what comes after its scrape was read counts at the next one
                ticks = ticks.clip(lower=done + self.every)
            values = frame["value"].astype(float) if "value" in frame else pd.Series(0.0, frame.index)
            for tick, part in pd.DataFrame({"tick": ticks, "ts": micros, "value": values}).groupby("tick"):
                top = part.sort_values("ts", kind="stable").iloc[-1]
                n, ts, value = len(part), int(top["ts"]), float(top["value"])
                if self.open.exists() and self.open.containsKey((int(tick),)):
                    n0, ts0, value0 = self.open.getValue((int(tick),))
                    n, (ts, value) = n + n0, ((ts, value) if ts >= ts0 else (ts0, value0))
                self.open.updateValue((int(tick),), (n, ts, value))
        if done is None and not list(self.handle.listTimers()):
            self.handle.registerTimer(min(tick for (tick,) in self.open.keys()))
        yield _samples([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        waiting = {tick: (n, v) for (tick,), (n, _, v) in (self.open.iterator() if self.open.exists() else [])}
        tick, value = self.last.get() if self.last.exists() else (None, 0.0)
        tick = min(waiting) if tick is None else tick + self.every
        out = []
        while tick <= now:
            n, seen = waiting.get(tick, (0, value))
            value = value + n if self.counter else seen
            if tick in waiting:
                self.open.removeKey((tick,))
            out.append((key[0], pd.Timestamp(tick, unit="ms"), value))
            tick += self.every
        if out:
            self.last.update((tick - self.every, float(value)))
        self.handle.registerTimer(tick)
        yield _samples(out)

    def close(self) -> None:
        pass


def keep_last_stream(samples: DataFrame, n: int = 120) -> DataFrame:
    """``keep_last`` of a stream of samples (series, ts, value): of each series that changes, its latest ``n``, at each batch; NaN reads null."""
    return samples.select("series", "ts", "value").groupBy("series").transformWithStateInPandas(SampleRing(n), SAMPLE, "update", "none")


def scrape_stream(events: DataFrame, every: int, lateness: str, counter: bool = False) -> DataFrame:
    """``sample_counter`` or ``sample_gauge`` of a stream of events (series, ts, value): (series, ts, value) at every scrape.

    A scrape is read once the watermark has passed it; a quiet series is read too, and repeats its
    value. From a series' first scrape to its last event they equal those of a batch.
    """
    columns = ["series", "ts"] if counter else ["series", "ts", "value"]
    rows = events.select(*columns).withWatermark("ts", lateness)
    read = rows.groupBy("series").transformWithStateInPandas(ScrapeClock(every, counter), SAMPLE, "append", "eventTime")
    return read.withColumn("value", F.coalesce("value", F.lit(float("nan"))))  # on its way from pandas NaN is null


def tag_snapshot_stream(rows: DataFrame) -> DataFrame:
    return rows.groupBy("item").transformWithStateInPandas(SnapshotTagger(), ROW + ", is_snapshot boolean", "append", "none")


def track_keys_stream(rows: DataFrame) -> DataFrame:
    return rows.groupBy("item", "key").transformWithStateInPandas(KeyTracker(), ROW, "append", "none")


def board_stream(rows: DataFrame) -> DataFrame:
    return rows.groupBy("item").transformWithStateInPandas(Board(), "item string, key string, fields string", "update", "none")
