"""What happens to records whose extraction failed (column ``failure``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

POLICIES = ("ignore", "force_unsubscribe", "dead_letter", "terminate")


def error_rows(df: DataFrame) -> DataFrame:
    """Failed records with stage, reason, expression and message."""
    kept = [c for c in df.columns if c not in ("failure", "fields", "items")]
    return df.where("failure is not null").select(*kept, "failure.*")


def succeeded(df: DataFrame) -> DataFrame:
    return df.where("failure is null").drop("failure")


def ignore_errors(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Drop failed records; ``observation`` counts them as ``failed`` of ``records``."""
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("records"), F.count("failure").alias("failed"))
    return succeeded(df)


def terminate_on_error(df: DataFrame) -> DataFrame:
    """Fail the query at a failed record."""
    stop = F.when(F.col("failure").isNotNull(), F.raise_error(F.col("failure.message")).cast("boolean")).otherwise(F.lit(True))
    return df.where(stop).drop("failure")


def dead_letter(df: DataFrame, sink) -> tuple[DataFrame, DataFrame]:
    """Good records and those for the dead-letter sink; having no sink is an error."""
    if sink is None:
        raise ValueError("dead_letter needs a sink")
    return succeeded(df), error_rows(df)


def force_unsubscribe(df: DataFrame, subs: DataFrame, order: tuple[str, ...] = ("timestamp", "partition", "offset")) -> tuple[DataFrame, DataFrame]:
    """Records before the first failed one, and one row per active item to unsubscribe if any failed."""
    position = F.struct(*order)
    first = df.where("failure is not null").agg(F.min(position).alias("_first"))  # one row
    before = df.join(F.broadcast(first), F.col("_first").isNull() | (position < F.col("_first"))).where("failure is null").drop("_first", "failure")
    ended = subs.select("item").distinct().join(F.broadcast(first.where("_first is not null").select(F.lit("unsubscribed").alias("event_kind"))))
    return before, ended


def apply_policy(df: DataFrame, on_error: str = "terminate", sink=None, subs: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Good records by policy, and the other side: dead letters or unsubscriptions (else null)."""
    if on_error == "ignore":
        return ignore_errors(df), None
    if on_error == "dead_letter":
        return dead_letter(df, sink)
    if on_error == "force_unsubscribe":
        if subs is None:
            raise ValueError("force_unsubscribe needs the subscriptions")
        return force_unsubscribe(df, subs)
    if on_error == "terminate":
        return terminate_on_error(df), None
    raise ValueError(f"unknown policy {on_error}")
