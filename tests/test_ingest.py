import json
import os
import time
from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows

import catalog
from lodestrata.operators import control as C
from lodestrata.operators import purge
from lodestrata.sources.snapshots import Conflict, SnapshotStore
from lodestrata.streaming.ingest import EDGE_TABLES, ENTITY_TABLE, Ingest, Options, dead_letters, load_state, settle_dead_letters, start
from lodestrata.streaming.refresh import refresh

T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)
ENTITIES = {"artists": catalog.ARTISTS, "labels": catalog.LABELS, "masters": catalog.MASTERS, "releases": catalog.RELEASES}


class Clock:
    def __init__(self):
        self.now = T0

    def __call__(self):
        self.now += timedelta(seconds=1)
        return self.now


def lines(*items, seq=0):
    return "\n".join(json.dumps({"entity": e, "value": v if isinstance(v, str) else json.dumps(v), "seq": seq + i}) for i, (e, v) in enumerate(items))


def done(entity, version="20260101", started="2025-12-31T00:00:00", n=5):
    return entity, {"type": "extraction_complete", "version": version, "started_at": started, "record_counts": {entity: n}}


def edge(store, name):
    return rows(store.read(name, EDGE_TABLES[name]))


def test_stream_to_refresh(spark, tmp_path):
    source, store, clock = tmp_path / "in", SnapshotStore(spark, str(tmp_path / "store")), Clock()
    source.mkdir()
    everything = [(e, d) for e, ds in ENTITIES.items() for d in ds]
    (source / "1.json").write_text(lines(*everything, ("releases", "{broken"), ("planets", {"id": "1"}), ("artists", {"id": ""})))
    ingest = Ingest(store, clock=clock)
    run = lambda: start(spark, str(source), str(tmp_path / "cp"), ingest).awaitTermination()
    run()
    m = store.manifest()
    assert m.number == 1
    assert rows(spark.read.parquet(m.paths["dead_letters/0"]).select("reason")) == [("no_id",), ("undecodable",), ("unknown_entity",)]
    assert len(rows(store.read("releases", ENTITY_TABLE))) == 4
    assert edge(store, "member_of") == [("A11", "A10"), ("A12", "A10"), ("A13", "A10")]
    # The whole batch again, as after a crash before the checkpoint: nothing changes.
    ingest.apply(spark.createDataFrame([("artists", '{"id":"zzz"}', 9)], "entity string, value string, seq long"), 0)
    assert store.manifest().number == 1

    # A changed release, an unchanged one, and terminal markers in the same batch as their records.
    changed = dict(catalog.RELEASES[1], genres=["Folk"], styles=[])
    (source / "2.json").write_text(lines(("releases", changed), ("releases", catalog.RELEASES[0]), *map(done, ENTITIES), seq=100))
    run()
    assert ("X2", "Folk") in edge(store, "in_genre") and ("X2", "Electronic") not in edge(store, "in_genre")
    assert edge(store, "in_style") == [("X1", "Dub"), ("X4", "Ambient")]
    state = load_state(store.manifest().control)
    assert state.latches["20260101"].signals == frozenset(ENTITIES) and state.jobs["20260101"].state == "pending"

    with pytest.raises(ZeroDivisionError):
        refresh(store, "w", clock, before_commit=lambda: 1 / 0)
    assert "genre_stats" not in store.manifest().paths
    assert refresh(store, "w", clock) is None  # not due yet
    clock.now += timedelta(minutes=10)
    counts = refresh(store, "w", clock)
    assert counts["genre_stats"] == 2 and load_state(store.manifest().control).jobs["20260101"].state == "completed"
    assert refresh(store, "w", clock) is None


def test_purge_on_completion(spark, tmp_path):
    store, clock = SnapshotStore(spark, str(tmp_path / "store")), Clock()
    ingest = Ingest(store, clock=clock)
    frame = lambda *items: spark.createDataFrame([(e, json.dumps(v), i) for i, (e, v) in enumerate(items)], "entity string, value string, seq long")
    ingest.apply(frame(*(("releases", d) for d in catalog.RELEASES)), 0)
    began = (clock.now + timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S+00:00")
    clock.now += timedelta(hours=1)
    ingest.apply(frame(("releases", catalog.RELEASES[0]), ("releases", catalog.RELEASES[1]), done("releases", started=began, n=2)), 1)
    assert [r[0] for r in rows(store.read("releases", ENTITY_TABLE))] == ["X1", "X2"]
    assert {r[0] for r in edge(store, "by_artist")} == {"X1", "X2"}
    # Two of four gone is allowed; a load without records would take all and is refused.
    clock.now += timedelta(hours=1)
    ingest.apply(frame(done("releases", version="20260201", started=clock.now.strftime("%Y-%m-%dT%H:%M:%SZ"), n=9)), 2)
    assert len(rows(store.read("releases", ENTITY_TABLE))) == 2
    assert load_state(store.manifest().control).latches["20260201"].vetoed == {"releases"}


def frame(spark, *items):
    return spark.createDataFrame([(e, v if isinstance(v, str) else json.dumps(v), i) for i, (e, v) in enumerate(items)], "entity string, value string, seq long")


def label(i, **more):
    return "labels", {"id": f"L{i}", **more}


def ids(store):
    return [r[0] for r in rows(store.read("labels", ENTITY_TABLE))]


def spelled(at):
    return at.strftime("%Y-%m-%dT%H:%M:%S+00:00")


def seen_ingest(spark, path, mode="seen"):
    clock = Clock()
    store = SnapshotStore(spark, str(path))
    return store, clock, Ingest(store, options=Options(limits=purge.Limits(mode=mode)), clock=clock)


def test_seen_mode_purges_by_its_list(spark, tmp_path):
    store, clock, ingest = seen_ingest(spark, tmp_path)
    ingest.apply(frame(spark, *(label(i) for i in range(6))), 0)
    clock.now += timedelta(minutes=10)
    # The list was opened within the margin of this load's start; its four keys come in two batches, unchanged.
    began = clock.now
    clock.now += timedelta(hours=1)
    ingest.apply(frame(spark, label(0), label(1)), 1)
    ingest.apply(frame(spark, label(2), label(3), done("labels", started=spelled(began), n=4)), 2)
    assert ids(store) == ["L0", "L1", "L2", "L3"]
    state = load_state(store.manifest().control)
    assert not state.latches["20260101"].vetoed and state.seen_opened["labels"] > began.replace(tzinfo=None)
    assert not [p for p in store.manifest().paths if p.startswith("seen/")]
    # The marker again: the list has been restarted and is empty, so there is nothing left to do.
    ingest.apply(frame(spark, done("labels", started=spelled(began), n=4)), 3)
    assert ids(store) == ["L0", "L1", "L2", "L3"] and not load_state(store.manifest().control).latches["20260101"].vetoed


def test_seen_mode_refuses_a_short_or_late_list(spark, tmp_path):
    store, clock, ingest = seen_ingest(spark, tmp_path)
    began = clock.now - timedelta(hours=2)  # before the list was opened: records may be missing from it
    ingest.apply(frame(spark, label(0), label(1), label(2)), 0)
    ingest.apply(frame(spark, done("labels", started=spelled(began), n=3)), 1)
    assert load_state(store.manifest().control).latches["20260101"].vetoed == {"labels"}
    clock.now += timedelta(hours=1)
    began = clock.now
    clock.now += timedelta(hours=1)
    ingest.apply(frame(spark, label(0), done("labels", version="20260201", started=spelled(began), n=3)), 2)
    assert ids(store) == ["L0", "L1", "L2"] and load_state(store.manifest().control).latches["20260201"].vetoed == {"labels"}
    assert C.consecutive_vetoes(load_state(store.manifest().control), "labels") == 2


def test_shadow_mode_compares_and_purges_by_time(spark, tmp_path):
    store, clock, ingest = seen_ingest(spark, tmp_path, "shadow")
    ingest.apply(frame(spark, *(label(i) for i in range(5))), 0)
    began = clock.now + timedelta(minutes=1)
    clock.now += timedelta(hours=1)
    ingest.apply(frame(spark, label(0), label(1), label(2), done("labels", started=spelled(began), n=3)), 1)
    shadow = load_state(store.manifest().control).shadows["labels"]
    assert (shadow["touch_stale"], shadow["seen_stale"], shadow["refreshed_not_seen"], shadow["guard"]) == (2, 2, 0, None)
    assert ids(store) == ["L0", "L1", "L2"]


def test_a_rejected_record_vetoes_the_purge_in_a_later_batch(spark, tmp_path):
    store, clock = SnapshotStore(spark, str(tmp_path)), Clock()
    ingest = Ingest(store, clock=clock)
    ingest.apply(frame(spark, *(label(i) for i in range(4))), 0)
    clock.now += timedelta(hours=1)
    began = clock.now
    clock.now += timedelta(minutes=1)
    ingest.apply(frame(spark, label(0), label(1), label(2), ("labels", '{"id": "L3", broken')), 1)
    ingest.apply(frame(spark, done("labels", started=spelled(began), n=4)), 2)
    assert ids(store) == ["L0", "L1", "L2", "L3"]
    assert load_state(store.manifest().control).latches["20260101"].vetoed == {"labels"}
    assert [r[3] for r in rows(dead_letters(store, "labels"))] == ["undecodable"] and not rows(dead_letters(store, "artists"))
    # Not replayed: it vetoes the next load as well. Then an operator gives it up.
    clock.now += timedelta(hours=1)
    ingest.apply(frame(spark, done("labels", version="20260201", started=spelled(began), n=4)), 3)
    assert len(ids(store)) == 4
    settle_dead_letters(store, "labels")
    assert not rows(dead_letters(store, "labels"))
    ingest.apply(frame(spark, done("labels", version="20260301", started=spelled(began), n=4)), 4)
    assert ids(store) == ["L0", "L1", "L2"]


def loaded(spark, path):
    """A store with the whole catalog and a job that is due."""
    store, clock = SnapshotStore(spark, str(path)), Clock()
    ingest = Ingest(store, clock=clock)
    ingest.apply(frame(spark, *((e, d) for e, ds in ENTITIES.items() for d in ds), *map(done, ENTITIES)), 0)
    return store, clock, ingest


def test_refresh_outlives_its_first_lease_and_a_commit_beside_it(spark, tmp_path):
    store, clock, ingest = loaded(spark, tmp_path)

    def long_work():
        for _ in range(6):  # 150 s by the clock, in steps that a heartbeat follows
            clock.now += timedelta(seconds=25)
            wanted = clock.now.isoformat()
            for _ in range(200):
                job = load_state(store.manifest().control).jobs["20260101"]
                if job.lease_until.isoformat() >= wanted and job.lease_until - clock.now > timedelta(seconds=100):
                    break
                time.sleep(0.05)
        ingest.apply(frame(spark, ("artists", {"id": "A20", "members": [{"id": "A11"}]})), 1)

    counts = refresh(store, "w", clock, before_commit=long_work, heartbeat_s=0.05)
    assert counts["genre_stats"] == 2 and counts["artist_degree"] == 5
    state = load_state(store.manifest().control)
    assert state.jobs["20260101"].state == "completed" and state.latches["20260101"].refreshed_at
    # What was ingested meanwhile is there, in the reconciled relation as well.
    assert ("A11", "A20") in edge(store, "member_of") and "A20" in [r[0] for r in rows(store.read("artists", ENTITY_TABLE))]
    assert store.manifest().batches == {"catalog": 1}


def test_refresh_of_a_superseded_load_is_not_published(spark, tmp_path):
    store, clock, ingest = loaded(spark, tmp_path)
    newer = lambda: ingest.apply(frame(spark, *(done(e, version="20260301") for e in ENTITIES)), 1)
    assert refresh(store, "w", clock, before_commit=newer) is None
    assert "genre_stats" not in store.manifest().paths


def test_ingest_beside_other_commits(spark, tmp_path):
    store, clock = SnapshotStore(spark, str(tmp_path)), Clock()
    ingest = Ingest(store, clock=clock)
    ingest.apply(frame(spark, label(1)), 0)
    publish, others = store.publish, iter([lambda: {}, lambda: {"labels": store.manifest().paths["labels"] + "/"}])

    def disturbed(base, *args, **kwargs):
        for paths in others:  # another writer is faster: first with its control state only, then with a table
            store.commit(store.manifest(), paths())
            break
        return publish(base, *args, **kwargs)

    store.publish = disturbed
    ingest.apply(frame(spark, label(2)), 1)
    ingest.apply(frame(spark, label(3)), 2)
    assert ids(store) == ["L1", "L2", "L3"] and store.manifest().batches == {"catalog": 2}


def test_first_spelling_is_by_arrival(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    release = lambda i, *names: ("releases", {"id": str(i), "companies": {"items": [{"name": n, "role": "r"} for n in names]}})
    Ingest(store).apply(frame(spark, release(1, "zed"), release(2, "Zed", "alpha"), release(3, "ALPHA")), 0)
    assert rows(store.read("company", "company_id string, name string")) == [("name:alpha", "alpha"), ("name:zed", "zed")]


def test_vacuum_keeps_what_is_named(spark, tmp_path):
    store, ingest = SnapshotStore(spark, str(tmp_path)), None
    ingest = Ingest(store)
    for k in range(3):
        ingest.apply(frame(spark, label(k)), k)
    store.write("labels", store.read("labels", ENTITY_TABLE))  # of a batch that failed
    assert store.vacuum(keep=1) > 0 and store.vacuum(keep=1) == 0
    assert ids(store) == ["L0", "L1", "L2"] and len(os.listdir(tmp_path / "labels")) == len([f for f in os.listdir(tmp_path / "labels") if f.startswith(("v=", ".v="))]) == 1


def test_commits_are_exclusive(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    base = store.manifest()
    store.commit(base, {}, control={"a": 1})
    with pytest.raises(Conflict):
        store.commit(base, {}, control={"a": 2})
    assert store.manifest().control == {"a": 1}


def test_latch():
    state, fired = C.Control(), []
    for e in ("artists", "labels", "masters", "releases"):
        state, f = C.record_signal(state, "20260101", e, T0)
        fired.append(f)
    assert fired == [False, False, False, True]
    assert C.record_signal(state, "20260101", "releases", T0)[1]  # redelivered after a failure
    state = C.advance(state, "20260101")
    state, job = C.claim(state, "w1", T0)
    assert C.claim(state, "w2", T0)[1] is None
    expired = T0 + timedelta(seconds=121)
    state2, job2 = C.claim(state, "w2", expired)
    assert job2.attempts == 2 and not C.holds(state2, job, expired)
    newer = C.advance(state2, "20260201")
    assert newer.jobs["20260101"].state == "superseded" and not C.holds(newer, job2, expired)
    assert C.advance(newer, "20251201").jobs["20251201"].state == "superseded"
    finished = C.finish(state2, job2, expired)
    assert finished.jobs["20260101"].state == "completed"
    assert not C.record_signal(finished, "20260101", "releases", expired)[1]
    late = finished
    late, _ = C.record_signal(late, "20260301", "artists", expired)
    assert not C.record_signal(late, "20260101", "labels", expired)[1]


def test_small_rules():
    assert C.extraction_key(" ", "2026") == "2026" and C.extraction_key(None, "") is None
    assert C.is_ordered("20240229") and not C.is_ordered("20230229") and not C.is_ordered("2023-1-1")
    assert [C.delay(n).total_seconds() for n in (0, 3, 8, 99)] == [1, 8, 256, 256]
    assert C.veto(1, 0, False, None) == "rejected" and C.veto(0, None, False, None) == "dead_letters_unreadable" and C.veto(0, 0, True, None) == "recorded" and C.veto(0, 0, False, "g") == "g"
    assert C.stalled(timedelta(60), timedelta(60), timedelta(1)) and not C.stalled(timedelta(60), timedelta(0), timedelta(1))
    assert [C.progress(True, timedelta(seconds=s)) for s in (1, 6, 121)] == ["active", "slow", "stalled"]
