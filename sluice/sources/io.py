"""Reading topics and writing updates and dead letters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.command import ORDER
from ..operators.errors import POLICIES
from ..streaming.kept import GONE, KeptBoard, KeptTable, LiveSubscriptions
from ..streaming.totals import RecordTotals
from .envelope import ENVELOPE

UPDATE_COLUMNS = ["session", "item", "event_kind", "is_snapshot", "fields", "topic", "partition", "offset", "timestamp"]


def topic_options(topics: list[str] | None = None, pattern: str | list[str] | None = None, start_from: str = "latest",
                  max_records_per_batch: int | None = 500, stream: bool = True, known_topics: list[str] | None = None, **kafka) -> dict[str, str]:
    """Options of the Kafka source for a literal topic list or for patterns (OR-ed, full match).

    With ``known_topics`` (the cluster's), missing literal topics are dropped; none left is an error.
    ``start_from`` counts only where no checkpoint has a position.
    """
    if (topics is None) == (pattern is None):
        raise ValueError("give topics or a pattern")
    if start_from not in ("latest", "earliest"):
        raise ValueError(f"start_from {start_from!r}")
    options = {"includeHeaders": "true", "startingOffsets": start_from if stream or start_from == "earliest" else "earliest"}
    if topics is not None:
        there = list(dict.fromkeys(t for t in topics if known_topics is None or t in known_topics))
        if not there:
            raise ValueError("none of the topics exists")
        options["subscribe"] = ",".join(there)
    else:
        patterns = [pattern] if isinstance(pattern, str) else pattern
        options["subscribePattern"] = "|".join(f"(?:{p})" for p in patterns)
    if stream and max_records_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_records_per_batch)
    return options | {k if k.startswith("kafka.") else f"kafka.{k}": v for k, v in kafka.items()}


def read_topics(spark: SparkSession, topics: list[str] | None = None, pattern: str | list[str] | None = None, stream: bool = True, **rest) -> DataFrame:
    """The envelope of Kafka topics, as a stream or a batch (needs the Kafka source's jar)."""
    reader = spark.readStream if stream else spark.read
    df = reader.format("kafka").options(**topic_options(topics, pattern, stream=stream, **rest)).load()
    return df.select(*ENVELOPE.names)


def read_files(spark: SparkSession, path: str, stream: bool = True, max_files_per_batch: int | None = None, fmt: str = "parquet") -> DataFrame:
    """The envelope of files that hold its columns."""
    reader = (spark.readStream if stream else spark.read).schema(ENVELOPE).format(fmt)
    if stream and max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(path)


def _write(df: DataFrame, path: str, fmt: str, mode: str, batch_id: int | None) -> None:
    """Append, or with ``batch_id`` fill that batch's own folder anew, so that a replayed batch changes nothing."""
    if batch_id is None:
        df.write.format(fmt).mode(mode).save(path)
    else:
        df.write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/batch_id={batch_id}")


def write_updates(updates: DataFrame, path: str, fmt: str = "parquet", mode: str = "append", batch_id: int | None = None) -> None:
    """Write a batch's update events, one row per record and subscriber."""
    _write(updates.select(*[c for c in UPDATE_COLUMNS if c in updates.columns]), path, fmt, mode, batch_id)


def write_dead_letters(errors: DataFrame, path: str, fmt: str = "parquet", mode: str = "append", batch_id: int | None = None) -> None:
    """Write a batch's bad records with what was wrong with them."""
    _write(errors, path, fmt, mode, batch_id)


def _first_error(errors: DataFrame):
    """Position and message of the first bad record; null if there is none."""
    row = errors.agg(F.min(F.struct(F.struct(*ORDER).alias("at"), "message")).alias("first")).first()
    return row["first"]


def stream_updates(records: DataFrame, process: Callable, updates_path: str, checkpoint: str, dead_letter_path: str | None = None,
                   on_error: str = "terminate", subs: DataFrame | None = None, board: KeptBoard | None = None, totals: RecordTotals | None = None, **trigger):
    """Run ``process`` on each micro-batch and write both sides, by batch id: a replayed batch changes nothing.

    ``process`` maps records to (updates, errors), or with an attribute ``KEPT`` (``Changes``) what was
    kept too, to what changes of it; that is a ``KeptTable`` beside the checkpoint, and so are the
    intervals of subscriptions that change. Each batch is decoded, routed and mapped once: what
    several sinks read is held until the batch is done. ``board`` follows the updates; ``totals``
    counts received records and processed updates.
    ``terminate`` stops the query at a batch with errors before anything of it is written; ``ignore``
    leaves bad records out; ``dead_letter`` needs a path; ``force_unsubscribe`` needs ``subs``: it
    writes the updates before the first bad record and one unsubscription an item, then stops.
    """
    if on_error not in POLICIES:
        raise ValueError(f"unknown policy {on_error!r}")
    if on_error == "dead_letter" and not dead_letter_path:
        raise ValueError("dead_letter needs a sink")
    if on_error == "force_unsubscribe" and subs is None and not isinstance(getattr(process, "subs", None), LiveSubscriptions):
        raise ValueError("force_unsubscribe needs the subscriptions")
    stateful = hasattr(process, "KEPT")
    kept = f"{checkpoint.rstrip('/')}-kept"
    state = KeptTable(kept, process.KEPT) if stateful else None
    live = stateful and isinstance(process.subs, LiveSubscriptions)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, held = batch.sparkSession, []

        def hold(df: DataFrame) -> DataFrame:
            held.append(df.persist())
            return held[-1]

        batch = hold(batch)
        try:
            after, wanted = None, subs
            if stateful:
                state.start(spark, process.initial)
                state.merge(spark, batch_id)
                now = process.subs.at(batch, kept, batch_id) if live else None
                wanted = process.subs.active(now) if live else subs
                updates, errors, after = process(batch, state.read(spark, batch_id), now, hold)
            else:
                updates, errors = process(batch)
            first = _first_error(errors) if on_error in ("terminate", "force_unsubscribe") else None
            if first and on_error == "terminate":
                raise RuntimeError(f"record failed: {first['message']}")
            if first:
                at = first["at"]
                updates = updates.where(F.struct(*ORDER) < F.struct(*[F.lit(at[c]).cast(updates.schema[c].dataType).alias(c) for c in ORDER]))
                gone = wanted.select(*[c for c in ("session", "item") if c in wanted.columns]).distinct().withColumn("event_kind", F.lit("unsubscribed"))
                updates = updates.select(*[c for c in UPDATE_COLUMNS if c in updates.columns]).unionByName(gone, allowMissingColumns=True)
            if on_error == "dead_letter":
                write_dead_letters(errors, dead_letter_path, batch_id=batch_id)
            counted = Observation() if totals is not None else None
            written = updates.observe(counted, F.count(F.lit(1)).alias("n")) if counted is not None else updates
            write_updates(written, updates_path, batch_id=batch_id)
            if counted is not None:
                totals.processed(batch_id, counted.get["n"])
            if board is not None:
                board.update(updates, batch_id)
            if stateful:
                state.write(after if after is not None else spark.createDataFrame([], f"{process.KEPT}, {GONE} boolean"), batch_id + 1)
            if first:
                raise RuntimeError(f"record failed, items were unsubscribed: {first['message']}")
        finally:
            for df in reversed(held):
                df.unpersist()

    if totals is not None:
        records = totals.watch(records)
    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
