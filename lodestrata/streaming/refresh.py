"""Running the derived refresh: reconcile, recompute, re-check the fence, publish, all in one commit.

The worker's lease is renewed from a thread of its own while the tables are
recomputed. Ingest goes on meanwhile: what it has committed stays, and the
relations of the refresh are put on top. Only a newer load, or a lease that was
lost, keeps a refresh from being published.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from datetime import datetime

from ..operators import control as C
from ..operators import counters, derive, merge
from ..sources.snapshots import Conflict, Manifest, SnapshotStore
from .ingest import EDGE_TABLES, ENTITY_TABLE, VERTEX_TABLES, dump_state, load_state

log = logging.getLogger(__name__)
ATTEMPTS = 5


class Lost(RuntimeError):
    """The lease is another worker's by now, or a newer load has come."""


def _control(change: Callable[[C.Control], C.Control]) -> Callable[[dict], dict]:
    return lambda saved: dump_state(change(load_state(saved)))


class Heartbeat:
    """Renews the lease of a job every ``every`` seconds until it is stopped or the lease is lost."""

    def __init__(self, store: SnapshotStore, job: C.Job, clock: Callable[[], datetime], every: float):
        self.store, self.job, self.clock, self.every = store, job, clock, every
        self.lost, self._stop = threading.Event(), threading.Event()
        self._thread = threading.Thread(target=self._run, name="refresh-heartbeat", daemon=True)

    def _run(self) -> None:
        while not self._stop.wait(self.every):
            try:
                now = self.clock()
                base = self.store.manifest()
                if not C.holds(load_state(base.control), self.job, now):
                    break
                self.store.publish(base, {}, _control(lambda state, now=now: C.heartbeat(state, self.job, now)))
            except Exception:  # an outage lets the lease run out, and the fence refuses the commit
                log.exception("heartbeat of %s failed", self.job.version)
                break
        else:
            return
        self.lost.set()

    def __enter__(self) -> Heartbeat:
        self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._stop.set()
        self._thread.join()


def _reconciled(store: SnapshotStore, base: Manifest, relation: str, entity: str) -> str | None:
    """A snapshot of an additive relation as all documents assert it; None if there are no documents, which changes nothing."""
    documents = store.read(entity, ENTITY_TABLE, base)
    if not documents.limit(1).count():
        return None
    current = store.read(relation, EDGE_TABLES[relation], base)
    wanted, _, _ = merge.reconcile(current, derive.derive(entity, derive.candidates(entity, documents))[relation], False)
    return store.write(relation, wanted)


RECONCILED = {"member_of": "artists", "same_as": "releases"}


def refresh(store: SnapshotStore, owner: str, clock: Callable[[], datetime], before_commit: Callable[[], None] = lambda: None, heartbeat_s: float = C.HEARTBEAT.total_seconds()) -> dict[str, int] | None:
    """Claim the due job and carry it out. Rows by relation; None if there is nothing to do or the job was lost.

    A failure before the commit leaves nothing behind but a job to try again.
    """
    base = store.manifest()
    state, job = C.claim(load_state(base.control), owner, clock())
    if job is None:
        return None
    try:
        base = store.commit(base, {}, control=dump_state(state))
    except Conflict:  # claimed from a state that is out of date: the next scan looks again
        return None
    try:
        with Heartbeat(store, job, clock, heartbeat_s) as beat:
            paths = {r: p for r, e in RECONCILED.items() if (p := _reconciled(store, base, r, e)) is not None}
            now = Manifest(base.number, base.paths | paths)
            edges = {r: store.read(r, s, now) for r, s in EDGE_TABLES.items()}
            vertices = {r: store.read(r, s, now) for r, s in VERTEX_TABLES.items()}
            vertices["label"] = derive.labels_vertex(store.read("labels", ENTITY_TABLE, now))
            years = derive.release_years(store.read("releases", ENTITY_TABLE, now))
            counts = {}
            for relation, df in counters.refresh(edges, vertices, years).items():
                if beat.lost.is_set():
                    return None
                paths[relation] = store.write(relation, df)
                counts[relation] = store.spark.read.parquet(paths[relation]).count()
            before_commit()
    except Exception:
        store.publish(store.manifest(), {}, _control(lambda state: C.finish(state, job, clock(), failed=True)))
        raise
    return counts if _publish(store, base, paths, job, clock) else None


def _publish(store: SnapshotStore, base: Manifest, paths: dict[str, str], job: C.Job, clock: Callable[[], datetime]) -> bool:
    """Put the refresh on top of the newest manifest, if the job is still held there."""

    def finished(saved: dict) -> dict:
        state, now = load_state(saved), clock()
        if not C.holds(state, job, now):
            raise Lost(job.version)
        return dump_state(C.finish(state, job, now))

    for _ in range(ATTEMPTS):
        try:
            store.publish(base, paths, finished)
            return True
        except Lost:
            return False
        except Conflict:  # ingest has changed an additive relation: reconcile it with its newer documents
            newest = store.manifest()
            for r in RECONCILED.keys() & paths.keys():
                if newest.paths.get(r) != base.paths.get(r):
                    again = _reconciled(store, newest, r, RECONCILED[r])
                    paths = {k: p for k, p in paths.items() if k != r} | ({r: again} if again else {})
            base = newest
    # Ingest is faster than reconciling: publish the counts, and leave the additive relations to the next load.
    try:
        store.publish(store.manifest(), {r: p for r, p in paths.items() if r not in RECONCILED}, finished)
    except Lost:
        return False
    return True
