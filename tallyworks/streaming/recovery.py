"""Failures between output and commit, on purpose, and going on after any failure."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallyworks.streaming.runtime import BatchHandler

log = logging.getLogger(__name__)


class Interruption(RuntimeError):
    """A failure made on purpose."""


def interrupted_after(number: int, times: int = 1) -> Callable[[BatchHandler], BatchHandler]:
    """Wrap a handler so that batch ``number`` fails after its output, ``times`` times, before Spark commits it.

    Give it to ``start_batches`` as ``wrap`` to see what a replay does to a sink.
    """
    left = times

    def wrap(handle: BatchHandler) -> BatchHandler:
        def run(batch: DataFrame, at: int) -> None:
            nonlocal left
            handle(batch, at)
            if at == number and left > 0:
                left -= 1
                raise Interruption(f"batch {at} interrupted after its output")

        return run

    return wrap


def run_through(start: Callable[[], StreamingQuery], restarts: int = 3) -> int:
    """Run a query to the end of its input, starting it again from its checkpoint when it fails.

    Returns how often that was needed; the failure after the last restart is raised.
    """
    for failed in range(restarts + 1):
        try:
            start().awaitTermination()
            return failed
        except StreamingQueryException:
            if failed == restarts:
                raise
            log.warning("query failed, going on from its checkpoint", exc_info=True)
    raise ValueError("restarts must not be negative")
