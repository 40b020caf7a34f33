"""Labelled rows for fitting the classifiers: all of them, or a bounded, reproducible sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out() -> Column:
    """Rows whose labels no model learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % 5 == 0, F.lit(False))


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """All (doc_id, label) pairs outside the held-out part.

    A doc_id labelled more than once counts by its largest label; null labels and null ids are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    return known.groupBy("doc_id").agg(F.max("label").alias("label"))


def chosen_labels(labels: DataFrame, label: str, rows: int, share: float) -> DataFrame:
    """About ``rows`` of the ``known_labels`` at most, by a hash of doc_id; up to ``share`` of them have label 1."""
    known = known_labels(labels, label)
    there = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    ones = min(there.get(1, 0), int(rows * share))
    take = {1: ones, 0: min(there.get(0, 0), rows - ones)}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1e6
    part = {k: take[k] / max(1, there.get(k, 0)) for k in (0, 1)}
    return known.where(draw < F.when(F.col("label") == 1, part[1]).otherwise(part[0]))
