"""Helpers shared by the corpus operators: reading, cutting lineage, connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; only where it names none (tests) one of our own."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("executors can't read the driver's folders: set spark.checkpoint.dir to a shared one")
    return _own_folder()


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="sluice-")


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage: ``df`` written as a table in the shared folder, and read again."""
    path = f"{shared_folder(df.sparkSession)}/sluice-{uuid.uuid4().hex}"
    df.write.parquet(path)
    again = df.sparkSession.read.schema(df.schema).parquet(path)
    again._written = path
    return again


def release(df: DataFrame) -> None:
    """Delete what ``cut`` wrote for a frame that nothing reads any more."""
    remove(df.sparkSession, df._written)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediate rows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without(df: DataFrame, gone: DataFrame, same: list[Column], most: int = 400_000) -> DataFrame:
    """The rows of ``df`` that no row of ``gone`` equals by ``same``.

    ``gone`` is written first: up to ``most`` rows of it are sent to every task, so that ``df``
    isn't shuffled; more are joined by shuffle.
    """
    written = cut(gone)
    return df.join(F.broadcast(written) if written.count() <= most else written, same, "left_anti")


def slices(batch: pa.RecordBatch, column: int, size: int):
    """Runs of neighbouring rows with about so many bytes of text (or of binary) in ``column``, and their texts (null: empty).

    Only one run's texts are Python strings at a time, however many rows the batch has.
    """
    texts = batch.column(column)
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        to = min(len(ends), int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size)) + 1)
        yield batch.slice(at, to - at), [t or "" for t in texts.slice(at, to - at).to_pylist()]
        at = to


def tidy(run):
    """``run``, a function for mapInArrow, that at a task's end gives back to the system what it has freed.

    Workers serve many tasks, of this and other stages; what the allocators keep would add to the next one's.
    """

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            _give_back()

    return tidied


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library alone
    if trim:
        trim(0)


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def components(edges: DataFrame, salts: int = 8, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): ``(node, component)``, smallest id each.

    Alternating large-star and small-star rounds; each round is an aggregation and a join whose
    hot side (a hub's edges) is dealt over ``salts`` sub-keys. Nodes without edges aren't returned.
    """
    def minima(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("deg"))

    def attach(pairs: DataFrame, low: DataFrame) -> DataFrame:
        """Each pair with its left node's minimum; hubs' minima are repeated once per salt."""
        wide = low.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return pairs.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int")).join(wide, ["u", "s"])

    def print_of(pairs: DataFrame):
        row = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        return row["n"], row["h"]

    edges = cut(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = print_of(edges)
    for _ in range(max_rounds if before[0] else 0):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = minima(both).select("u", F.least("u", "m").alias("m"))
        large = attach(both, low).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.where("u <> v").distinct())
        low = minima(large).select("u", "m")
        small = attach(large, low)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        small = cut(small.where("u <> v").distinct())
        release(large)
        release(edges)
        edges, after = small, print_of(small)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
