"""Progress reporting for the streaming load (the source's "every 50,000 rows" log).

A ``StreamingQueryListener`` receives each micro-batch's progress on the driver; the
row counters come from ``observe`` on the stream (computed by the executors as part of
the batch), so reporting adds no extra job.
"""

from __future__ import annotations

import logging
import threading

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger("tidemart.streaming")


class ProgressLogger(StreamingQueryListener):
    """Logs rows per micro-batch and a line each time another ``every`` rows are done."""

    def __init__(self, metric: str = "transactions_in", every: int = 50_000):
        self.metric = metric
        self.every = every
        self.total = 0
        self.corrupt = 0
        self.batches = 0
        self._next = every
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:  # noqa: N802 (Spark callback name)
        log.info("stream %s started", event.id)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        m = p.observedMetrics.get(self.metric) if p.observedMetrics else None
        if m is None:
            return
        rows = int(m["rows"])
        self.total += rows
        self.corrupt += int(m["corrupt_rows"]) if "corrupt_rows" in m else 0
        self.batches += 1
        log.info("batch %d: %d rows (total %d)", p.batchId, rows, self.total)
        while self.total >= self._next:
            log.info("processed %d rows", self._next)
            self._next += self.every

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        log.info("stream %s finished: %d rows in %d batches (%d corrupt)", event.id,
                 self.total, self.batches, self.corrupt)
        self.ended.set()

    def totals(self, wait: float = 30.0) -> dict[str, int]:
        """The run's totals; events arrive a little after the query has ended."""
        self.ended.wait(wait)
        return {"rows": self.total, "corrupt_rows": self.corrupt, "batches": self.batches}
