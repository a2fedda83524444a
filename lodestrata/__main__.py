"""``python -m lodestrata``: follow the catalog's events and keep its tables; exits with 1 if it can't start."""

from __future__ import annotations

import sys
import time
from datetime import datetime, timezone

from . import config
from .session import session
from .sources.snapshots import SnapshotStore
from .streaming.health import Health
from .streaming.ingest import Ingest, Options, start
from .streaming.refresh import refresh

SCAN_S = 15


def main() -> int:
    try:
        c = config.from_env()
        spark = session()
        store = SnapshotStore(spark, c.store)
        health = Health()
        spark.streams.addListener(health)
        ingest = Ingest(store, c.prefix, Options(strict_hash=c.strict_hash, limits=c.limits))
        query = start(spark, c.source, c.checkpoint, ingest, c.files_per_trigger, available_now=False, interval=f"{c.batch_interval_s} seconds")
    except Exception as e:
        print(f"cannot start: {e}", file=sys.stderr)
        return 1
    clock = lambda: datetime.now(timezone.utc)
    while query.isActive:
        try:
            refresh(store, f"worker-{id(query)}", clock)
        except Exception as e:  # the job waits for its next attempt
            print(f"refresh failed: {e}", file=sys.stderr)
        time.sleep(SCAN_S)
    return 0 if query.exception() is None else 1


if __name__ == "__main__":
    sys.exit(main())
