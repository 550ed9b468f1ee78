"""Rows that a running query dropped because their windows were closed."""

from __future__ import annotations

import logging

from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)


class LateRowsError(RuntimeError):
    """A query dropped rows, and was told not to."""


class LateRows:
    """Counts ``numRowsDroppedByWatermark`` of a query, micro-batch by micro-batch.

    Call ``update`` now and then: Spark keeps the progress of the last hundred
    micro-batches.
    """

    def __init__(self, query: StreamingQuery, *, fail: bool = False):
        self._query, self._fail, self._seen = query, fail, -1
        self.dropped = 0

    def update(self) -> int:
        new = 0
        for progress in self._query.recentProgress:
            if progress["batchId"] > self._seen:
                self._seen = progress["batchId"]
                new += sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])
        self.dropped += new
        if new:
            log.warning("%d late rows dropped, %d since the start", new, self.dropped)
            if self._fail:
                raise LateRowsError(f"{self.dropped} late rows dropped")
        return self.dropped
