"""Totals of received records and processed updates while a stream runs."""

from __future__ import annotations

import datetime as dt
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

SERIES = "series string, ts timestamp, value double"


class RecordTotals(StreamingQueryListener):
    """Two series, ``received`` and ``processed``, with one sample a micro-batch.

    Records are counted by an observation on the source, reported with the query's progress; updates
    by one on what is written. Both are told by batch, so that a batch that is run again counts once.
    Samples never fall; after a restart they go on from ``before``, which ``state`` has given.
    """

    def __init__(self, name: str = "received", before: tuple[int, int] = (0, 0)):
        self.name, self.before = name, before
        self.counts: dict[str, dict[int, tuple[dt.datetime, int]]] = {"received": {}, "processed": {}}
        self.lock = Lock()

    def watch(self, records: DataFrame) -> DataFrame:
        """The stream with its observation; this listener hears of it."""
        records.sparkSession.streams.addListener(self)
        return records.observe(self.name, F.count(F.lit(1)).alias("n"))

    def _count(self, series: str, batch_id: int, n: int, at: dt.datetime | None = None) -> None:
        with self.lock:
            self.counts[series][batch_id] = (at or dt.datetime.now(dt.timezone.utc), n)

    def processed(self, batch_id: int, n: int) -> None:
        self._count("processed", batch_id, n)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None and event.progress.numInputRows:
            self._count("received", event.progress.batchId, seen["n"], dt.datetime.fromisoformat(event.progress.timestamp.replace("Z", "+00:00")))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    @property
    def state(self) -> tuple[int, int]:
        """Received and processed so far."""
        with self.lock:
            return tuple(b + sum(n for _, n in self.counts[s].values()) for b, s in zip(self.before, ("received", "processed")))

    def samples(self, spark) -> DataFrame:
        """(series, ts, value): the running totals, for ``rate`` and the other range functions. One row a batch and series."""
        rows = []
        with self.lock:
            for base, (series, counts) in zip(self.before, self.counts.items()):
                total = base
                for _, (at, n) in sorted(counts.items()):
                    total += n
                    rows.append((series, at, float(total)))
        return spark.createDataFrame(rows, SERIES)
