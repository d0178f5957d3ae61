"""What a running stream reports: its progress to a log, and a stop where memory runs out."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQueryListener

from textloom.sources import host


class Progress(StreamingQueryListener):
    """Writes a line for every start, batch and end of a stream to ``log``; every ``every`` batches ``check`` may ask for a stop, which is then called."""

    def __init__(self, log: logging.Logger, every: int = 10, check: Callable[[], bool] | None = None, stop: Callable[[], None] | None = None):
        super().__init__()
        self.log, self.every, self.check, self.stop = log, every, check, stop
        self.batches = self.rows = 0

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.log.info("stream %s started", event.name or event.id)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.batches += 1
        self.rows += p.numInputRows
        self.log.info("stream %s batch %d: %d rows", p.name or p.id, p.batchId, p.numInputRows)
        if self.check and self.batches % self.every == 0 and self.check():
            self.log.warning("stream %s is stopped", p.name or p.id)
            if self.stop:
                self.stop()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.log.info("stream %s ended%s", event.id, f": {event.exception}" if event.exception else "")


def memory_is_low(folder: str = ".", least_gib: float = 4.0) -> bool:
    """Whether the driver's host has less memory left than ``least_gib``."""
    return host.facts(folder)["memory_available_gib"] < least_gib
