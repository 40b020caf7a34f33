"""Delivery order within partitions or keys, and positions to go on from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered(df: DataFrame, scope: str = "partition", partitions: int | None = None) -> DataFrame:
    """Rows dealt so that each task sees its share in delivery order.

    ``partition``: by (topic, partition); ``key``: by key (null keys share one lane); ``none``: as
    they are.
    """
    if scope == "none":
        return df
    if scope == "partition":
        lanes, order = ["topic", "partition"], ["topic", "partition", "offset"]
    elif scope == "key":
        lanes, order = ["key"], ["key", "partition", "offset"]
    else:
        raise ValueError(f"unknown order scope {scope}")
    dealt = df.repartition(partitions, *lanes) if partitions else df.repartition(*lanes)
    return dealt.sortWithinPartitions(*order)


def next_offsets(df: DataFrame, committed: DataFrame | None = None) -> DataFrame:
    """Per (topic, partition) the offset to go on from, never behind a committed one."""
    seen = df.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))
    if committed is None:
        return seen
    both = seen.unionByName(committed.select("topic", "partition", F.col("offset").alias("next_offset")))
    return both.groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))


def start_offsets(committed: DataFrame, bounds: DataFrame, start_from: str = "latest") -> DataFrame:
    """Where to start each partition: at its committed offset, else at its end or begin.

    ``bounds``: topic, partition, begin_offset, end_offset; ``committed``: topic, partition, offset.
    """
    if start_from not in ("latest", "earliest"):
        raise ValueError(f"start_from {start_from!r}")
    joined = bounds.join(committed, ["topic", "partition"], "full")
    return joined.select("topic", "partition", F.coalesce("offset", "end_offset" if start_from == "latest" else "begin_offset").alias("start_offset"))
