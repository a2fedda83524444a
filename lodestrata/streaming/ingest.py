"""From a stream of catalog events to committed tables, edges and dead letters.

Each micro-batch is applied as one commit of the snapshot store: dead letters
are split off row by row, the documents of each entity are merged, the edges
of changed documents are replaced, and only then the batch's control rows are
honoured, so a terminal marker never overtakes the records before it. A batch
whose id has been committed is passed over, so replays after a crash change
nothing.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import documents as D
from ..operators import control as C
from ..operators import derive, identity, merge, purge
from ..sources.snapshots import Conflict, Manifest, SnapshotStore

log = logging.getLogger(__name__)

EVENTS = "entity string, value string, seq long"
ENTITY_TABLE = "data_id string, hash string, data string, media string, gm_item_id string, updated_at timestamp"
EDGE_TABLES = {
    "by_artist": "release_id string, artist_id string",
    "on_label": "release_id string, label_id string",
    "derived_from": "release_id string, master_id string",
    "in_genre": "release_id string, genre_name string",
    "in_style": "release_id string, style_name string",
    "master_by_artist": "master_id string, artist_id string",
    "master_in_genre": "master_id string, genre_name string",
    "master_in_style": "master_id string, style_name string",
    "member_of": "member_artist_id string, group_artist_id string",
    "alias_of": "alias_artist_id string, artist_id string",
    "credited_on": "person_name string, release_id string, role string",
    "same_as": "person_name string, artist_id string",
    "credited_to": "release_id string, company_id string, role string, role_category string, source string",
    "issued_on": "release_id string, medium_id string, source string, qty long",
    "track_credited_on": "person_name string, release_id string, track_ordinal long, sub_track_ordinal long, track_position string, role string",
    "track_by_artist": "release_id string, track_ordinal long, sub_track_ordinal long, track_position string, artist_id string",
}
VERTEX_TABLES = {"genre": "name string", "style": "name string", "person": "name string", "media_family": "name string", "medium": "medium_id string, family string, label string", "company": "company_id string, name string, discogs_label_id string"}
ALIASES = "provider string, entity_kind string, external_id string, native_id string"


@dataclass
class Options:
    """What may differ between deployments; ``limits.mode`` says how stale rows are told: by touching, by the list of seen keys, or by both to compare."""

    strict_hash: bool = False
    limits: purge.Limits = field(default_factory=purge.Limits)


def decode(events: DataFrame) -> DataFrame:
    """Adds ``v``, ``type`` (null for a record), ``data_id`` and ``reason`` (why a row is a dead letter, or null)."""
    rows = events.withColumn("v", F.try_parse_json("value"))
    v = F.col("v")
    raw = D.at(v, "id")
    number = D.whole(raw)
    rows = rows.withColumn("type", D.string(D.at(v, "type"))).withColumn("data_id", F.coalesce(F.nullif(D.string(raw), F.lit("")), F.when(number != "0", number)))
    known = F.coalesce(F.col("entity").isin(*derive.ENTITIES), F.lit(False))
    reason = (
        F.when(~D.is_object(v), "undecodable")
        .when(~known, "unknown_entity")
        .when(F.col("type").isNull() & F.col("data_id").isNull(), "no_id")
        .when(F.col("type").isNotNull() & ~F.col("type").isin("file_complete", "extraction_complete"), "unknown_type")
        .when(F.col("type").isNull() & F.exists(derive.media_items(v), lambda m: m["qty"].isNull()), "quantity_out_of_range")
    )
    return rows.withColumn("reason", reason)


def records(decoded: DataFrame, entity: str, strict_hash: bool = False) -> DataFrame:
    """The valid records of an entity as a batch to merge."""
    v = F.col("v")
    rows = decoded.where(F.col("reason").isNull() & F.col("type").isNull() & (F.col("entity") == entity))
    media = F.to_json(F.struct(derive.media_items(v).alias("items"))) if entity == "releases" else F.lit(None).cast("string")
    given = D.string(D.at(v, "sha256"))
    return rows.select(
        "data_id",
        "seq",
        (F.coalesce(given, F.lit("")) if strict_hash else F.coalesce(given, F.sha2(F.col("value").cast("binary"), 256))).alias("hash"),
        F.col("value").alias("data"),
        media.alias("media"),
        merge.native_id(F.lit(identity.PROVIDER), F.lit(entity), F.col("data_id")).alias("gm_item_id"),
    )


Change = Callable[[C.Control], C.Control]
SEEN = "data_id string, seen_at timestamp"
ATTEMPTS = 5


def naive_utc(text: str | None) -> datetime | None:
    """A time as sent, in UTC; without an offset it is taken for UTC."""
    if not text or not text.strip():
        return None
    at = datetime.fromisoformat(text.strip().replace("Z", "+00:00"))
    return at.astimezone(timezone.utc).replace(tzinfo=None) if at.tzinfo else at


class Batch:
    """What a micro-batch is going to commit: snapshots, relations that go, and changes of the control state in order."""

    def __init__(self, store: SnapshotStore, base: Manifest, batch_id: int, now: datetime):
        self.store, self.base, self.batch_id, self.now = store, base, batch_id, now
        self.paths: dict[str, str] = {}
        self.removed: list[str] = []
        self.changes: list[Change] = []
        self.state = load_state(base.control)

    def change(self, f: Change) -> None:
        self.changes.append(f)
        self.state = f(self.state)

    def read(self, relation: str, schema: str) -> DataFrame:
        return self.store.read(relation, schema, Manifest(self.base.number, self.base.paths | self.paths))

    def write(self, relation: str, df: DataFrame) -> None:
        self.paths[relation] = self.store.write(relation, df)

    def control(self, saved: dict) -> dict:
        """The changes, applied to the state as it is by now."""
        return dump_state(reduce(lambda state, f: f(state), self.changes, load_state(saved)))

    def seen_paths(self, entity: str) -> list[str]:
        return [r for r in sorted((self.base.paths | self.paths).keys() - set(self.removed)) if r.startswith(f"seen/{entity}/")]

    def seen_is_whole(self, entity: str) -> bool:
        """Whether every part of the list is still there."""
        paths = self.base.paths | self.paths
        return all(self.store.exists(paths[r]) for r in self.seen_paths(entity))

    def seen(self, entity: str, since: datetime) -> DataFrame:
        """The list's keys, those from before the load left out."""
        paths = self.base.paths | self.paths
        found = [paths[r] for r in self.seen_paths(entity)]
        listed = self.store.spark.read.schema(SEEN).parquet(*found) if found else self.store.spark.createDataFrame([], SEEN)
        return listed.where(F.col("seen_at") >= F.lit(since)).select("data_id")

    def restart(self, entity: str, started: datetime) -> None:
        """A fresh list for the next load, unless the present one is of a later load already."""
        opened, now = self.state.seen_opened.get(entity), self.now
        if purge.restart(purge.SeenList(opened, 0), started, now).opened_at == opened:
            return
        gone = self.seen_paths(entity)
        self.removed += gone
        for r in gone:
            self.paths.pop(r, None)
        self.change(lambda state: C.open_list(state, entity, now))


class Ingest:
    def __init__(self, store: SnapshotStore, name: str = "catalog", options: Options | None = None, clock=lambda: datetime.now(timezone.utc)):
        self.store, self.name, self.options, self.clock = store, name, options or Options(), clock

    @property
    def mode(self) -> str:
        return self.options.limits.mode

    def apply(self, events: DataFrame, batch_id: int) -> None:
        """One micro-batch, for ``foreachBatch``; done anew if another writer has changed a table meanwhile."""
        for attempt in range(ATTEMPTS):
            try:
                return self._apply(events, batch_id)
            except Conflict:
                if attempt == ATTEMPTS - 1:
                    raise

    def _apply(self, events: DataFrame, batch_id: int) -> None:
        base = self.store.manifest()
        if base.batches.get(self.name, -1) >= batch_id:
            return
        batch = Batch(self.store, base, batch_id, self.clock().replace(tzinfo=None))
        decoded = decode(events).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            kinds = {(r.entity, r.type) for r in decoded.where("reason is null").select("entity", "type").distinct().collect()}
            rejected = {r.entity: r["count"] for r in decoded.where("reason is not null").groupBy("entity").count().collect()}
            if rejected:
                batch.write(f"dead_letters/{batch_id}", decoded.where("reason is not null").select("entity", "value", "seq", "reason"))
            for entity, n in rejected.items():
                if entity in derive.ENTITIES:
                    batch.change(partial(C.add_dead_letters, entity=entity, batch=str(batch_id), n=n))
            for entity in derive.ENTITIES:
                if (entity, None) in kinds:
                    self._merge(batch, decoded, entity)
            for row in decoded.where("reason is null and type = 'extraction_complete'").orderBy("seq").select("entity", D.string(D.at(F.col("v"), "version")).alias("version"), D.string(D.at(F.col("v"), "started_at")).alias("started_at"), F.try_variant_get("v", "$.record_counts", "map<string,long>").alias("counts")).collect():
                self._terminal(batch, row, rejected.get(row.entity, 0))
            self.store.publish(base, batch.paths, batch.control, {self.name: batch_id}, batch.removed)
        finally:
            decoded.unpersist()

    def _merge(self, out: Batch, decoded: DataFrame, entity: str) -> None:
        current = out.read(entity, ENTITY_TABLE)
        batch = records(decoded, entity, self.options.strict_hash)
        merged = merge.apply_batch(current, batch, F.lit(out.now), self.mode != "seen")
        whole = self.store.spark.read.parquet(self.store.write(f"{entity}_outcomes", merged))
        out.write(entity, whole.drop("outcome"))
        if self.mode != "touch":
            if entity not in out.state.seen_opened:
                out.change(partial(C.open_list, entity=entity, at=out.now))
            out.write(f"seen/{entity}/{out.batch_id}", batch.select("data_id", F.lit(out.now).alias("seen_at")).distinct())
        order = merge.latest(batch.select("data_id", "seq"))
        changed = whole.where("outcome = 'processed'").select("data_id", "data").join(F.broadcast(order), "data_id")
        for relation, new in derive.derive(entity, changed).items():
            if relation in VERTEX_TABLES:
                have = out.read(relation, VERTEX_TABLES[relation])
                out.write(relation, merge.insert_vertices(have, new if "seq" in new.columns else new.withColumn("seq", F.lit(0)), have.columns[0]))
                continue
            have = out.read(relation, EDGE_TABLES[relation])
            if relation in derive.ADDITIVE:
                table = merge.insert_edges(have, new)
            else:
                scope = derive.has_companies_block(changed) if relation == derive.CONDITIONAL else changed
                table = merge.replace_for_documents(have, new, scope.select("data_id"), derive.DOCUMENT_COLUMN[relation], derive.SOURCE if relation in derive.SOURCE_SCOPED else None)
            out.write(relation, table)
        if entity == "releases":
            targets = identity.release_aliases(batch.select("data_id", "data")).join(batch.select("data_id", "seq", F.col("gm_item_id").alias("native_id")), "data_id")
            aliases, conflicts = merge.attach_aliases(out.read("provider_aliases", ALIASES), targets)
            out.write("provider_aliases", aliases)
            refused = self.store.write("alias_conflicts", conflicts)
            if self.store.spark.read.parquet(refused).limit(1).count():
                out.paths[f"alias_conflicts/{out.batch_id}"] = refused

    def _terminal(self, out: Batch, row, rejected: int) -> None:
        """Purge what a completed load no longer has, unless something speaks against it; then its signal."""
        key, entity, now = C.extraction_key(row.version, row.started_at), row.entity, out.now
        if key is None:
            return
        started, produced = naive_utc(row.started_at), (row.counts or {}).get(entity)
        recorded = key in out.state.latches and entity in out.state.latches[key].vetoed
        why = C.veto(rejected, C.waiting_dead_letters(out.state, entity), recorded, None)
        if why is None and purge.skip_reason(started, produced) is None:
            why = self._purge(out, entity, started, produced)
        if self.mode != "touch" and started is not None:
            out.restart(entity, started)

        def signalled(state: C.Control) -> C.Control:
            state, complete = C.record_signal(state, key, entity, now, vetoed=why is not None)
            return C.advance(state, key) if complete else state

        out.change(signalled)
        run = C.consecutive_vetoes(out.state, entity)
        if run >= C.ALERT_RUN:
            log.error("purge of %s vetoed on %d loads in a row (%s); its stale rows are not clearing", entity, run, why)
        elif why is not None:
            log.warning("purge of %s vetoed: %s", entity, why)

    def _purge(self, out: Batch, entity: str, started: datetime, produced: int | None) -> str | None:
        """Delete the stale rows and their edges; or the reason why not."""
        limits = self.options.limits
        table = out.read(entity, ENTITY_TABLE)
        by_time = purge.stale_by_time(table, F.lit(started))
        if self.mode == "touch":
            stale = by_time
        else:
            whole = out.seen_is_whole(entity)
            keys = out.seen(entity, started) if whole else self.store.spark.createDataFrame([], "data_id string")
            listed = purge.SeenList(out.state.seen_opened.get(entity) if whole else None, keys.distinct().count())
            guard = purge.seen_guard(listed, started, produced, limits)
            by_list = purge.stale_by_list(table, keys, F.lit(started)) if whole else table.limit(0)
            if self.mode == "shadow":
                compared = purge.shadow_compare(by_time, by_list).first().asDict() | {"guard": guard, "started_at": started.isoformat()}
                out.change(lambda state: replace(state, shadows=state.shadows | {entity: compared}))
                stale = by_time
            elif guard is not None:
                return None if purge.already_settled(listed, started, limits) else guard
            else:
                stale = by_list
        n = purge.counts(table, stale).first()
        if purge.too_many(n.total, n.stale, limits):
            return "purge_refused"
        if n.stale:
            edges = {r: out.read(r, EDGE_TABLES[r]) for r in purge.OWNED[entity]}
            left, edges = purge.purge(table, edges, entity, stale)
            new = {entity: left.select(*table.columns)} | edges
            for r, path in {r: self.store.write(r, df) for r, df in new.items()}.items():
                out.paths[r] = path
        return None


def dead_letters(store: SnapshotStore, entity: str) -> DataFrame:
    """The entity's dead letters that wait to be replayed or given up: ``(entity, value, seq, reason)``."""
    m = store.manifest()
    waiting = [store.read(f"dead_letters/{b}", "entity string, value string, seq long, reason string", m).where(F.col("entity") == entity) for b in load_state(m.control).dead_letters.get(entity, {})]
    return reduce(DataFrame.unionByName, waiting) if waiting else store.spark.createDataFrame([], "entity string, value string, seq long, reason string")


def settle_dead_letters(store: SnapshotStore, entity: str) -> None:
    """An operator has replayed them, or gives them up: they veto no purge from here on."""
    store.publish(store.manifest(), {}, lambda saved: dump_state(C.settle_dead_letters(load_state(saved), entity)))


def dump_state(state: C.Control) -> dict:
    def plain(x):
        if isinstance(x, datetime):
            return x.isoformat()
        if isinstance(x, frozenset):
            return sorted(x)
        if isinstance(x, dict):
            return {k: plain(y) for k, y in x.items()}
        return x

    return plain(asdict(state))


def load_state(saved: dict) -> C.Control:
    if not saved:
        return C.Control()
    when = lambda x: datetime.fromisoformat(x) if x else None
    latches = {k: C.Latch(x["version"], when(x["created_at"]), frozenset(x["signals"]), frozenset(x["vetoed"]), when(x["refreshed_at"]), x["generation"]) for k, x in saved["latches"].items()}
    jobs = {k: C.Job(x["version"], x["generation"], x["state"], x["attempts"], x["owner"], when(x["lease_until"]), when(x["due_at"])) for k, x in saved["jobs"].items()}
    opened = {e: when(x) for e, x in saved.get("seen_opened", {}).items()}
    return C.Control(latches, jobs, saved["generation"], saved["version"], saved.get("dead_letters", {}), opened, saved.get("shadows", {}))


def start(spark: SparkSession, source: str, checkpoint: str, ingest: Ingest, files_per_trigger: int = 100, available_now: bool = True, interval: str = "5 seconds") -> StreamingQuery:
    """Follow a folder of JSON lines with columns entity, value and seq."""
    events = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).json(source)
    writer = events.writeStream.foreachBatch(ingest.apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()
