"""Loads: when one is complete, when its derived relations are recomputed, and by whom.

State is a few rows, kept by the driver. Transitions are pure functions over
immutable values; the store that keeps them swaps one version for the next.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .derive import ENTITIES

LEASE, HEARTBEAT = timedelta(seconds=120), timedelta(seconds=30)
ALERT_RUN = 2


# Over tables of signals.


def completeness(signals: DataFrame) -> DataFrame:
    """(version, signals, complete) from ``signals(version, signal)``: complete once all four entities have signalled."""
    grouped = signals.groupBy("version").agg(F.array_sort(F.collect_set("signal")).alias("signals"))
    missing = F.array_except(F.array(*map(F.lit, ENTITIES)), "signals")
    return grouped.withColumn("complete", F.size(missing) == 0)


def superseded(latches: DataFrame) -> DataFrame:
    """``latches(version, created_at)`` with ``superseded``: another was created later."""
    last = latches.agg(F.max("created_at").alias("last"))
    return latches.join(F.broadcast(last)).withColumn("superseded", F.col("created_at") < F.col("last")).drop("last")


def veto_runs(latches: DataFrame) -> DataFrame:
    """(entity, run) from ``latches(entity, version, signalled, vetoed)``: vetoes in a row, newest version first.

    A version that signalled without a veto ends the run; one that did neither
    is passed over.
    """
    newest = Window.partitionBy("entity").orderBy(F.col("version").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = F.sum(F.when(F.col("signalled") & ~F.col("vetoed"), 1).otherwise(0)).over(newest)
    return latches.withColumn("ended", ended).groupBy("entity").agg(F.count_if((F.col("ended") == 0) & F.col("vetoed")).alias("run"))


def vetoes(loads: DataFrame) -> DataFrame:
    """``loads(entity, version, marker, rejected)`` with ``waiting`` and ``veto``: dead letters that nobody has settled by a load's marker."""
    so_far = Window.partitionBy("entity").orderBy("marker").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return loads.withColumn("waiting", F.sum("rejected").over(so_far)).withColumn("veto", F.when(F.col("waiting") > 0, "dead_letters"))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("entity", "outcome").agg(F.count("*").alias("n"))


def due_job(jobs: DataFrame, now) -> DataFrame:
    """The waiting or expired job of the highest generation that is due, as one row or none."""
    waiting = F.col("state").isin("pending", "retry") & (F.coalesce("due_at", now) <= now)
    expired = (F.col("state") == "leased") & (F.col("lease_until") < now)
    return jobs.where(waiting | expired).orderBy(F.col("generation").desc(), "version").limit(1)


def job_health(jobs: DataFrame, now) -> DataFrame:
    """One row: newest completed version, the number waiting, leased and superseded, and the age of the oldest waiting."""
    waiting = F.col("state").isin("pending", "retry")
    return jobs.agg(
        F.max_by(F.when(F.col("state") == "completed", F.col("version")), F.when(F.col("state") == "completed", F.col("generation"))).alias("completed"),
        F.count_if(waiting).alias("waiting"),
        F.count_if(F.col("state") == "leased").alias("active"),
        F.count_if(F.col("state") == "superseded").alias("superseded"),
        F.max(F.when(waiting, F.timestamp_diff("SECOND", F.col("created_at"), now))).alias("oldest_waiting_s"),
    )


# State of the driver.


def extraction_key(version: str | None, started_at: str | None) -> str | None:
    """What names a load: its version, else its start; None means that it is refused."""
    for x in (version, started_at):
        if x and x.strip():
            return x.strip()
    return None


def is_ordered(version: str) -> bool:
    if not re.fullmatch(r"[0-9]{8}", version):
        return False
    try:
        date(int(version[:4]), int(version[4:6]), int(version[6:]))
    except ValueError:
        return False
    return True


@dataclass(frozen=True)
class Latch:
    version: str
    created_at: datetime
    signals: frozenset[str] = frozenset()
    vetoed: frozenset[str] = frozenset()
    refreshed_at: datetime | None = None
    generation: int | None = None


@dataclass(frozen=True)
class Job:
    version: str
    generation: int
    state: str = "pending"  # pending, leased, retry, completed, superseded
    attempts: int = 0
    owner: str | None = None
    lease_until: datetime | None = None
    due_at: datetime | None = None


@dataclass(frozen=True)
class Control:
    latches: dict[str, Latch] = field(default_factory=dict)
    jobs: dict[str, Job] = field(default_factory=dict)
    generation: int = 0
    version: str | None = None
    #: Batches with dead letters of each entity that nobody has replayed or cleared yet, and how many.
    dead_letters: dict[str, dict[str, int]] = field(default_factory=dict)
    #: When the list of seen keys of each entity was last started.
    seen_opened: dict[str, datetime] = field(default_factory=dict)
    #: The last comparison of both ways to purge, by entity.
    shadows: dict[str, dict] = field(default_factory=dict)


def add_dead_letters(state: Control, entity: str, batch: str, n: int) -> Control:
    of = state.dead_letters.get(entity, {}) | {batch: n}
    return replace(state, dead_letters=state.dead_letters | {entity: of})


def settle_dead_letters(state: Control, entity: str) -> Control:
    """The entity's dead letters have been replayed or given up; they veto no purge from here on."""
    return replace(state, dead_letters={e: of for e, of in state.dead_letters.items() if e != entity})


def waiting_dead_letters(state: Control, entity: str) -> int:
    return sum(state.dead_letters.get(entity, {}).values())


def open_list(state: Control, entity: str, at: datetime) -> Control:
    return replace(state, seen_opened=state.seen_opened | {entity: at})


def consecutive_vetoes(state: Control, entity: str) -> int:
    """Loads in a row, newest first, whose purge of the entity was vetoed; loads without its signal are passed over."""
    run = 0
    for version in sorted(state.latches, reverse=True):
        latch = state.latches[version]
        if entity in latch.vetoed:
            run += 1
        elif entity in latch.signals:
            break
    return run


def record_signal(state: Control, version: str, entity: str, now: datetime, vetoed: bool = False) -> tuple[Control, bool]:
    """(state, whether this signal completes the load and is to fire a refresh).

    Signals are a set, so redelivery adds nothing; after a failed refresh it
    fires again, after a finished one it doesn't. A latch that isn't the newest
    never fires.
    """
    old = state.latches.get(version) or Latch(version, now)
    latch = replace(old, signals=old.signals | {entity}, vetoed=old.vetoed | ({entity} if vetoed else frozenset()))
    state = replace(state, latches=state.latches | {version: latch})
    newer = any(x.created_at > latch.created_at for x in state.latches.values())
    return state, latch.signals >= set(ENTITIES) and latch.refreshed_at is None and not newer


def advance(state: Control, version: str) -> Control:
    """A job for a load; a newer version takes the next generation and supersedes the older jobs."""
    if not is_ordered(version) or version in state.jobs:
        return state
    if state.version is not None and version < state.version:
        return replace(state, jobs=state.jobs | {version: Job(version, 0, "superseded")})
    generation = state.generation + 1
    older = {v: replace(j, state="superseded") if j.state in ("pending", "retry", "leased") else j for v, j in state.jobs.items()}
    return replace(state, jobs=older | {version: Job(version, generation)}, generation=generation, version=version)


def adopt(state: Control) -> Control:
    """Jobs, in order of version, for complete latches from before there were generations."""
    for v in sorted(v for v, x in state.latches.items() if x.generation is None and is_ordered(v) and x.signals >= set(ENTITIES) and x.refreshed_at is None):
        state = advance(state, v)
    return state


def delay(attempts: int) -> timedelta:
    return timedelta(seconds=min(300, 2 ** min(attempts, 8)))


def claim(state: Control, owner: str, now: datetime) -> tuple[Control, Job | None]:
    """Lease the job of the highest generation that waits and is due, or whose lease ran out."""
    ready = [j for j in state.jobs.values() if j.state in ("pending", "retry") and (j.due_at or now) <= now or j.state == "leased" and j.lease_until < now]
    if not ready:
        return state, None
    best = max(ready, key=lambda j: j.generation)
    job = replace(best, state="leased", owner=owner, attempts=best.attempts + 1, lease_until=now + LEASE)
    return replace(state, jobs=state.jobs | {job.version: job}), job


def holds(state: Control, job: Job, now: datetime) -> bool:
    """The fence: the lease is still this owner's, and no newer load has come."""
    current = state.jobs.get(job.version)
    return current is not None and current.state == "leased" and current.owner == job.owner and current.attempts == job.attempts and current.lease_until >= now and state.generation == job.generation


def heartbeat(state: Control, job: Job, now: datetime) -> Control:
    if not holds(state, job, now):
        return state
    return replace(state, jobs=state.jobs | {job.version: replace(state.jobs[job.version], lease_until=now + LEASE)})


def finish(state: Control, job: Job, now: datetime, failed: bool = False) -> Control:
    """Complete a held job, or set it down for another attempt; one that isn't held is left alone."""
    if not holds(state, job, now):
        return state
    current = state.jobs[job.version]
    done = replace(current, state="retry", owner=None, lease_until=None, due_at=now + delay(current.attempts)) if failed else replace(current, state="completed", owner=None, lease_until=None)
    latches = state.latches
    if not failed and job.version in latches:
        latches = latches | {job.version: replace(latches[job.version], refreshed_at=now, generation=job.generation)}
    return replace(state, jobs=state.jobs | {job.version: done}, latches=latches)


def veto(rejected: int, dead_letters: int | None, recorded: bool, guard: str | None) -> str | None:
    """Why a load isn't to be purged: rejects of this run, dead letters (None: unreadable), an earlier veto, or the list's guard."""
    if rejected:
        return "rejected"
    if dead_letters is None:
        return "dead_letters_unreadable"
    if dead_letters:
        return "dead_letters"
    return "recorded" if recorded else guard


def stalled(oldest_unsettled: timedelta, since_settled: timedelta, bound: timedelta) -> bool:
    return oldest_unsettled > bound and since_settled > bound


def progress(had_records: bool, since_last: timedelta) -> str:
    """idle, active, slow or stalled, by the time since the last record."""
    s = since_last.total_seconds()
    if not had_records:
        return "idle" if s >= 30 else "starting"
    return "stalled" if s > 120 else "slow" if s > 5 else "active"
