"""Counters of streams, batch by batch, instead of a log line per record (K6)."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from riskflow.operators.review import audit_counters
from riskflow.schema import ID

_MERGE = {"min_id": min, "max_id": max}


def observed(stream: DataFrame, name: str, key: str = ID, positive: str | None = None) -> DataFrame:
    """The stream with counters that each of its micro-batches reports under ``name``."""
    return stream.observe(name, *audit_counters(key, positive))


class StreamAudit(StreamingQueryListener):
    """Collects the counters that streams report; a batch that is run again counts once."""

    def __init__(self):
        self._batches: dict[str, dict[tuple[str, int], dict]] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._changed:
            for name, row in progress.observedMetrics.items():
                self._batches.setdefault(name, {})[str(progress.id), progress.batchId] = row.asDict()

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the last report of a query that has ended is here; events come a little later than the data."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end of query {query.runId} was reported")

    def batches(self, name: str) -> list[dict]:
        """The counters of each batch, in order."""
        with self._changed:
            return [row for _, row in sorted(self._batches.get(name, {}).items(), key=lambda item: item[0][1])]

    def totals(self, name: str) -> dict[str, int | None]:
        """The counters over all batches."""
        total: dict[str, int | None] = {}
        for row in self.batches(name):
            for counter, value in row.items():
                known = total.get(counter)
                if value is None or known is None:
                    total[counter] = known if value is None else value
                else:
                    total[counter] = _MERGE.get(counter, lambda a, b: a + b)(known, value)
        return total


def listen(spark: SparkSession) -> StreamAudit:
    """A listener on all streams of the session, until it is removed from ``spark.streams``."""
    listener = StreamAudit()
    spark.streams.addListener(listener)
    return listener
