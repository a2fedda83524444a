"""What a running stream tells about itself."""

from __future__ import annotations

import threading
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql.streaming import StreamingQueryListener

from ..operators import control


@dataclass
class Snapshot:
    started_at: datetime
    last_batch_at: datetime | None = None
    last_records_at: datetime | None = None
    batches: int = 0
    records: int = 0
    failed: str | None = None


class Health(StreamingQueryListener):
    """Collects progress events; ``report`` rolls them up."""

    def __init__(self, clock=lambda: datetime.now(timezone.utc)):
        self.clock, self._lock = clock, threading.Lock()
        self.state = Snapshot(clock())

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self.state = Snapshot(self.clock())

    def onQueryProgress(self, event) -> None:
        self.seen(event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self.state.failed = event.exception

    def seen(self, records: int) -> None:
        with self._lock:
            now = self.clock()
            self.state.batches += 1
            self.state.records += records
            self.state.last_batch_at = now
            if records:
                self.state.last_records_at = now

    def report(self, unsettled_for: timedelta = timedelta(0), bound: timedelta = timedelta(minutes=25), refresh_failed: bool = False) -> dict:
        """starting, healthy or unhealthy, and what the stream is doing."""
        with self._lock:
            s, now = self.state, self.clock()
        since = now - (s.last_records_at or s.started_at)
        settled = now - (s.last_batch_at or s.started_at)
        if s.failed or refresh_failed or control.stalled(unsettled_for, settled, bound):
            status = "unhealthy"
        else:
            status = "healthy" if s.batches else "starting"
        return {"status": status, "progress": control.progress(bool(s.records), since), "batches": s.batches, "records": s.records, "failed": s.failed}
