"""Ordered scans over a key whose rows don't meet in one task.

Rows are cut into segments of the order. What a segment hands on (its last value, its sum) is
aggregated before the shuffle and carried over the segments of a key, of which there are few; the
rows themselves are only ordered within their segment.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import unused


def _join_carry(df: DataFrame, carry: DataFrame, on: Sequence[str], stem: str) -> DataFrame:
    """``df`` with the carry of its key and segment; null keys are keys too."""
    renamed = carry.withColumnsRenamed({c: f"{stem}{k}" for k, c in enumerate(on)})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{stem}{k}")) for k, c in enumerate(on)])
    return df.join(renamed, same, "left").drop(*[f"{stem}{k}" for k in range(len(on))])


def last_value(df: DataFrame, column: str, value: Column, keys: Sequence[str], order: Sequence[str], segment: Column, inclusive: bool = True) -> DataFrame:
    """``df`` with the last ``value`` that isn't null at or (not ``inclusive``) before each row of its keys, in order.

    ``segment`` never falls in that order.
    """
    seg, val, carried, stem = (unused(df, n) for n in ("_seg", "_val", "_carried", "_key"))
    rows = df.withColumn(seg, segment).withColumn(val, value)
    ends = rows.groupBy(*keys, seg).agg(F.max_by(F.col(val), F.when(F.col(val).isNotNull(), F.struct(*order))).alias(val))
    before = Window.partitionBy(*keys).orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*keys, seg, F.last(val, ignorenulls=True).over(before).alias(carried))
    inside = Window.partitionBy(*keys, seg).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    joined = _join_carry(rows, carry, [*keys, seg], stem)
    return joined.withColumn(column, F.coalesce(F.last(val, ignorenulls=True).over(inside), F.col(carried))).drop(seg, val, carried)


def running_sum(df: DataFrame, column: str, value: Column, keys: Sequence[str], order: Sequence[str], segment: Column) -> DataFrame:
    """``df`` with the sum of ``value`` up to each row of its keys, in order; null counts as nothing."""
    seg, val, carried, stem = (unused(df, n) for n in ("_seg", "_val", "_carried", "_key"))
    rows = df.withColumn(seg, segment).withColumn(val, F.coalesce(value, F.lit(0)))
    sums = rows.groupBy(*keys, seg).agg(F.sum(val).alias(val))
    before = Window.partitionBy(*keys).orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(*keys, seg, F.sum(val).over(before).alias(carried))
    inside = Window.partitionBy(*keys, seg).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = _join_carry(rows, carry, [*keys, seg], stem)
    return joined.withColumn(column, F.sum(val).over(inside) + F.coalesce(carried, F.lit(0))).drop(seg, val, carried)
