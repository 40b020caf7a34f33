"""Where users put logic of their own: item remapping, vetoes, and reactions to unsubscribing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import unused
from .routing import split_items


def remap_items(requests: DataFrame, remap: Callable[[DataFrame], DataFrame], column: str = "items_text") -> DataFrame:
    """The user's rewriting of requested item lists, then each item in canonical form."""
    return split_items(requests.transform(remap), column)


def on_subscription(subs: DataFrame, allowed: Column) -> tuple[DataFrame, DataFrame]:
    """Subscriptions the user's predicate lets through, and vetoed ones with ``reason``."""
    name = unused(subs, "_allowed")
    marked = subs.withColumn(name, F.coalesce(allowed, F.lit(False)))
    return marked.where(name).drop(name), marked.where(~F.col(name)).drop(name).withColumn("reason", F.lit("vetoed"))


def on_unsubscription(log: DataFrame, react: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What the user's function makes of a log's unsubscriptions."""
    return log.where("action = 'unsubscribe'").transform(react)
