"""What a stream keeps between micro-batches: keyed tables beside its checkpoint, and subscriptions that change.

A kept table is a row of runs, each with what changed in some batches, the last change of each key.
Reading puts them over one another, the newest first. Before a batch neighbouring runs of like size
are merged, so there are few of them, and each change is written again about log(n) times in all:
what a batch writes follows what it changed, not what is kept. Runs hold Parquet files, so a lost
executor's part is read again, and a batch that is run again finds the state before it unchanged.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.command import CHANGES, ORDER
from ..operators.routing import sized, subscription_intervals

GONE = "gone"
_RUN = re.compile(r"run-(\d+)-(\d+)$")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that all executors share: below ``spark.checkpoint.dir``; one of our own only in local mode."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/kept-{uuid.uuid4().hex}"
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError("executors can't read the driver's folders: set spark.checkpoint.dir to a shared one")
    return tempfile.mkdtemp(prefix="kept-")


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def _over(newer: DataFrame, older: DataFrame, keys: list[str]) -> DataFrame:
    """The newer rows, and those older ones whose keys they don't have."""
    seen = newer.select(*[F.col(k).alias(f"newer_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"newer_{k}")) for k in keys])
    return newer.unionByName(older.join(sized(seen), same, "left_anti"))


@dataclass(frozen=True)
class KeptTable:
    """Rows by ``keys`` (null is a key too), with ``values``: schema texts. State 0 is the initial one, state k + 1 that after batch k."""

    path: str
    keys: str
    values: str = ""

    @property
    def _names(self) -> list[str]:
        return [c.split()[0] for c in self.keys.split(", ")]

    @property
    def _schema(self) -> str:
        return ", ".join(x for x in (self.keys, self.values, f"{GONE} boolean") if x)

    def runs(self, spark: SparkSession, state: int | None = None) -> list[tuple[int, int]]:
        """The runs (first, last state) that make up a state, oldest first; complete ones alone."""
        there = {}
        fs, _ = _fs(spark, self.path)
        for name in _children(spark, self.path):
            m = _RUN.match(name)
            if m and fs.exists(_fs(spark, f"{self.path}/{name}/_SUCCESS")[1]):
                there.setdefault(int(m[1]), []).append(int(m[2]))
        found, at = [], 0
        while ends := [e for e in there.get(at, []) if state is None or e <= state]:
            found.append((at, max(ends)))
            at = max(ends) + 1
        return found

    def _read(self, spark: SparkSession, run: tuple[int, int]) -> DataFrame:
        return spark.read.schema(self._schema).parquet(f"{self.path}/run-{run[0]}-{run[1]}")

    def start(self, spark: SparkSession, initial: DataFrame | None = None) -> None:
        """Write the initial state, if there is none yet."""
        if not self.runs(spark, 0):
            rows = initial if initial is not None else spark.createDataFrame([], ", ".join(x for x in (self.keys, self.values) if x))
            self.write(rows.withColumn(GONE, F.lit(False)), 0)

    def read(self, spark: SparkSession, state: int) -> DataFrame:
        """The rows of a state: keys and values."""
        runs = self.runs(spark, state)
        if not runs or runs[-1][1] != state:
            raise ValueError(f"{self.path} has no state {state}")
        return reduce(lambda newer, run: _over(newer, self._read(spark, run), self._names), runs[-2::-1], self._read(spark, runs[-1])).where(f"not {GONE}").drop(GONE)

    def write(self, changes: DataFrame, state: int) -> None:
        """What changes at a state: keys, values and ``gone``; one row a key. Written again, it replaces what was written for it."""
        changes.select(*[c.split()[0] for c in self._schema.split(", ")]).write.mode("overwrite").parquet(f"{self.path}/run-{state}-{state}")

    def merge(self, spark: SparkSession, state: int, sieve: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Merge runs up to a state that no batch starts before any more, and delete what is merged.

        A run is merged with the one before it if it has half as many rows or more. Keys that are
        gone leave with the first run, and so do rows that ``sieve`` doesn't let through.
        """
        runs = self.runs(spark, state)
        sizes = [self._read(spark, r).count() for r in runs]
        last = len(runs)
        while last > 1 and 2 * sum(sizes[last - 1 :]) >= sizes[last - 2]:
            last -= 1
        parts = runs[last - 1 :]
        if len(parts) > 1:
            merged = reduce(lambda newer, run: _over(newer, self._read(spark, run), self._names), parts[-2::-1], self._read(spark, parts[-1]))
            if parts[0][0] == 0:
                merged = merged.where(f"not {GONE}")
                merged = sieve(merged) if sieve else merged
            merged.write.mode("overwrite").parquet(f"{self.path}/run-{parts[0][0]}-{parts[-1][1]}")
        standing = set(self.runs(spark, state))
        fs, _ = _fs(spark, self.path)
        for name in _children(spark, self.path):
            m = _RUN.match(name)
            if m and int(m[2]) <= state and (int(m[1]), int(m[2])) not in standing:
                fs.delete(_fs(spark, f"{self.path}/{name}")[1], True)


class LiveSubscriptions:
    """Subscriptions by a log that grows while a stream runs.

    ``log``: a folder of Parquet files (session, item, action, and when, in a column ``order``).
    Before each micro-batch the files that are new are read and change the intervals of the keys
    they name; a record is routed by the intervals that hold its timestamp. Which files a batch
    saw is written down, so that it sees the same ones when it is run again. An entry counts for
    records of batches that start after its file is there. With ``lateness`` (seconds) intervals
    that ended so long before a batch's first record are forgotten.
    """

    KEYS = ("session", "item")

    def __init__(self, log: str, order: str = "ts", lateness: int | None = None):
        self.log, self.order, self.lateness = log.rstrip("/"), order, lateness

    def _table(self, kept: str) -> KeptTable:
        return KeptTable(f"{kept}-subscriptions", "session string, item string, from_time timestamp", "to_time timestamp")

    def _files(self, spark: SparkSession, kept: str, batch_id: int) -> tuple[list[str], list[str]]:
        """The log's files this batch sees: all, and those that are new."""
        folder = f"{kept}-subscription-files"

        def noted(k: int) -> list[str] | None:
            fs, at = _fs(spark, f"{folder}/{k}.json")
            if not fs.exists(at):
                return None
            with_ = fs.open(at)
            try:
                return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(with_)).decode())
            finally:
                with_.close()

        before = noted(batch_id - 1) or []
        seen = noted(batch_id)
        if seen is None:
            seen = sorted(n for n in _children(spark, self.log) if n.endswith(".parquet"))
            fs, at = _fs(spark, f"{folder}/{batch_id}.json")
            out = fs.create(at, True)
            try:
                out.write(bytearray(json.dumps(seen).encode()))
            finally:
                out.close()
            fs.delete(_fs(spark, f"{folder}/{batch_id - 2}.json")[1], False)
        return seen, sorted(set(seen) - set(before))

    def at(self, batch: DataFrame, kept: str, batch_id: int) -> DataFrame:
        """The intervals (session, item, from_time, to_time) that a batch is routed by."""
        spark, table, keys = batch.sparkSession, self._table(kept), list(self.KEYS)
        table.start(spark)
        table.merge(spark, batch_id)
        before = table.read(spark, batch_id)
        _, new = self._files(spark, kept, batch_id)
        if new:
            entries = spark.read.parquet(*[f"{self.log}/{n}" for n in new]).select(*keys, "action", F.col(self.order).cast("timestamp").alias("at"))
            touched = entries.select(*keys).distinct()
            mine = before.join(sized(touched), keys, "left_semi")
            begins = mine.select(*keys, F.lit("subscribe").alias("action"), F.col("from_time").alias("at"))
            # An interval that ends where the next begins ends by that.
            ends = mine.where("to_time is not null").select(*keys, F.col("to_time").alias("at")).join(begins.select(*keys, "at"), [*keys, "at"], "left_anti")
            log = begins.unionByName(ends.withColumn("action", F.lit("unsubscribe"))).unionByName(entries)
            # Of entries of one time the last subscription counts, as in the log that is read as a whole.
            log = log.groupBy(*keys, "at").agg(F.min("action").alias("action"))
            now = subscription_intervals(log, "at", self.KEYS, ("from_time", "to_time"))
            gone = mine.select(*keys, "from_time").join(now.select(*keys, "from_time"), [*keys, "from_time"], "left_anti").withColumn("to_time", F.lit(None).cast("timestamp"))
            changes = now.withColumn(GONE, F.lit(False)).unionByName(gone.withColumn(GONE, F.lit(True)))
        else:
            changes = before.limit(0).withColumn(GONE, F.lit(False))
        if self.lateness is not None:
            first = batch.agg((F.min("timestamp") - F.expr(f"interval {self.lateness} seconds")).alias("horizon"))  # one row
            old = before.join(F.broadcast(first), F.col("to_time") < F.col("horizon")).drop("horizon").withColumn(GONE, F.lit(True))
            changes = _over(changes, old, [*keys, "from_time"])
        table.write(changes, batch_id + 1)
        return table.read(spark, batch_id + 1)

    def active(self, intervals: DataFrame) -> DataFrame:
        """The subscriptions that stand at last."""
        return intervals.where("to_time is null").select(*self.KEYS)


class KeptBoard:
    """The boards that change streams describe, kept beside a stream: after any number of batches equal to ``materialize_board`` of all updates.

    A batch writes the last change of each key it has, and one mark an item that it clears; what was
    cleared is left out when the board is read, and goes when runs are merged. Updates of a batch
    come after those of the batches before it in ``ORDER``, as an item's do in its partition.
    """

    def __init__(self, path: str, keys: tuple[str, ...] = ("session", "item")):
        self.keys, names = keys, ", ".join(f"{k} string" for k in keys)
        self.rows = KeptTable(f"{path}/rows", f"{names}, key string", "at struct<timestamp:timestamp,partition:int,offset:bigint>, fields map<string,string>")
        self.marks = KeptTable(f"{path}/marks", names, "cleared struct<timestamp:timestamp,partition:int,offset:bigint>")

    def _standing(self, rows: DataFrame, marks: DataFrame) -> DataFrame:
        """Rows after their item's mark."""
        renamed = marks.select(*[F.col(k).alias(f"mark_{k}") for k in self.keys], "cleared")
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"mark_{k}")) for k in self.keys])
        joined = rows.join(sized(renamed), same, "left").where(F.col("cleared").isNull() | (F.col("at") > F.col("cleared")))
        return joined.drop("cleared", *[f"mark_{k}" for k in self.keys])

    def update(self, updates: DataFrame, batch_id: int) -> None:
        """Apply a batch's updates; applied again it changes nothing."""
        spark = updates.sparkSession
        for table in (self.rows, self.marks):
            table.start(spark)
        self.marks.merge(spark, batch_id)
        marks = self.marks.read(spark, batch_id)
        self.rows.merge(spark, batch_id, lambda rows: self._standing(rows, marks))
        at = F.struct(F.col(ORDER[0]).cast("timestamp").alias("timestamp"), F.col(ORDER[1]).cast("int").alias("partition"), F.col(ORDER[2]).cast("bigint").alias("offset")).alias("at")
        there = updates.select(*self.keys, at, F.col("fields")["command"].alias("command"), F.col("fields")["key"].alias("key"), "fields")
        cleared = there.where("command = 'CS'").groupBy(*self.keys).agg(F.max("at").alias("cleared"))
        self.marks.write(cleared.withColumn(GONE, F.lit(False)), batch_id + 1)
        last = there.where(F.col("command").isin(*CHANGES)).groupBy(*self.keys, "key").agg(F.max_by(F.struct("at", "command", "fields"), "at").alias("last"))
        kept = F.map_filter("last.fields", lambda k, v: k != "command").alias("fields")
        self.rows.write(last.select(*self.keys, "key", "last.at", kept, (F.col("last.command") == "DELETE").alias(GONE)), batch_id + 1)

    def read(self, spark: SparkSession, state: int) -> DataFrame:
        """The boards after batch ``state - 1``: keys, key, fields."""
        standing = self._standing(self.rows.read(spark, state), self.marks.read(spark, state))
        return standing.select(*self.keys, "key", "fields")
