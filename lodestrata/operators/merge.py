"""Keeping tables of documents and edges up to date, as rewrites of immutable snapshots.

An entity table has ``data_id, hash, data, media, gm_item_id, updated_at``; a
batch the same without ``updated_at``, but with ``seq``, its order of arrival.
The time is always handed in, so that a replay gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("hash", "data", "media", "gm_item_id")


def content_hash(data: str = "data", given: str = "hash", strict: bool = False) -> Column:
    """The producer's hash, or one of the content where it is missing; ``strict`` takes the empty string instead."""
    return F.coalesce(given, F.lit("") if strict else F.sha2(F.col(data), 256))


def latest(batch: DataFrame, key: str = "data_id", seq: str = "seq") -> DataFrame:
    """The last row of each key by order of arrival."""
    rest = [c for c in batch.columns if c != key]
    return batch.groupBy(key).agg(F.max_by(F.struct(*rest), seq).alias("row")).select(key, "row.*").select(*batch.columns)


def classify(batch: DataFrame, current: DataFrame) -> DataFrame:
    """The latest rows of a batch with ``outcome``: unchanged if the stored hash is equal, else changed."""
    stored = current.select("data_id", F.col("hash").alias("stored_hash"))
    joined = latest(batch).join(stored, "data_id", "left")
    return joined.withColumn("outcome", F.when(F.col("stored_hash").isNotNull() & F.col("hash").eqNullSafe(F.col("stored_hash")), "unchanged").otherwise("changed")).drop("stored_hash")


def native_id(provider: Column, kind: Column, external_id: Column) -> Column:
    """An id that always is the same for a (provider, kind, external id), in the shape of a uuid."""
    h = F.sha2(F.concat_ws("\x1f", provider, kind, external_id), 256)
    return F.concat_ws("-", h.substr(1, 8), h.substr(9, 4), h.substr(13, 4), h.substr(17, 4), h.substr(21, 12))


def apply_batch(current: DataFrame, batch: DataFrame, now: Column, touch: bool = True) -> DataFrame:
    """The table after a batch, with what happened to each row.

    ``outcome``: ``processed`` (new or changed: every field replaced),
    ``media_backfilled`` and ``identity_backfilled`` (unchanged, but a null field
    is filled in), ``skipped`` (unchanged) or null (not in the batch). Touching
    sets ``updated_at`` of skipped rows too; a backfill leaves it alone.
    """
    incoming = classify(batch, current).select("data_id", "outcome", *(F.col(c).alias(f"new_{c}") for c in FIELDS))
    both = current.join(incoming, "data_id", "full")
    changed, unchanged = F.col("outcome") == "changed", F.col("outcome") == "unchanged"
    fills_media = unchanged & F.col("media").isNull() & F.col("new_media").isNotNull()
    fills_identity = unchanged & F.col("gm_item_id").isNull() & F.col("new_gm_item_id").isNotNull()
    filled = {"media": F.when(fills_media, F.col("new_media")).otherwise(F.col("media")), "gm_item_id": F.when(fills_identity, F.col("new_gm_item_id")).otherwise(F.col("gm_item_id"))}
    renewed = changed | (unchanged & ~fills_media & ~fills_identity if touch else F.lit(False))
    outcome = F.when(changed, "processed").when(fills_media, "media_backfilled").when(fills_identity, "identity_backfilled").when(unchanged, "skipped")
    return both.select(
        "data_id",
        *(F.when(changed, F.col(f"new_{c}")).otherwise(filled.get(c, F.col(c))).alias(c) for c in FIELDS),
        F.when(renewed, now).otherwise(F.col("updated_at")).alias("updated_at"),
        outcome.alias("outcome"),
    )


def insert_vertices(current: DataFrame, new: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Vertices that aren't there yet, each in its first spelling, come in; others stay as they are."""
    rest = [c for c in current.columns if c != key]
    row = F.struct(*rest) if rest else F.struct(F.lit(1).alias("one"))
    first = new.groupBy(key).agg(F.min_by(row, seq).alias("row")).join(current, key, "left_anti")
    return current.unionByName(first.select(key, *(F.col(f"row.{c}").alias(c) for c in rest)))


def replace_for_documents(current: DataFrame, new: DataFrame, changed: DataFrame, document: str, source: str | None = None) -> DataFrame:
    """Rows of the changed documents (``changed(data_id)``) give way to their new ones.

    With ``source`` only rows of that source go; rows of other sources stay.
    A changed document that asserts nothing loses its rows.
    """
    ids = changed.select(F.col("data_id").alias(document)).distinct()
    if source is None:
        kept = current.join(ids, document, "left_anti")
    else:
        kept = current.join(ids.withColumn("source", F.lit(source)), [document, "source"], "left_anti")
    return kept.select(*current.columns).unionByName(new.select(*current.columns)).distinct()


def insert_edges(current: DataFrame, new: DataFrame) -> DataFrame:
    return current.unionByName(new.select(*current.columns)).distinct()


def reconcile(current: DataFrame, asserted: DataFrame, entities_are_empty: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(table, inserted, deleted) that make an additive relation what all documents assert; an empty entity table changes nothing."""
    keys = current.columns
    if entities_are_empty:
        nothing = current.limit(0)
        return current, nothing, nothing
    wanted = asserted.select(*keys).distinct()
    return wanted, wanted.join(current, keys, "left_anti"), current.join(wanted, keys, "left_anti")


def attach_aliases(current: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(aliases, conflicts): new references come in, a present one is never overwritten.

    ``current(provider, entity_kind, external_id, native_id)``; ``targets`` the
    same with ``seq``, of which the first of each reference counts.
    """
    key = ["provider", "entity_kind", "external_id"]
    first = targets.groupBy(*key).agg(F.min_by("native_id", "seq").alias("native_id"))
    added = first.join(current, key, "left_anti").select(*current.columns)
    conflicts = first.alias("n").join(current.alias("c"), key).where("n.native_id <> c.native_id").select(*key, F.col("c.native_id").alias("native_id"), F.col("n.native_id").alias("refused_id"))
    return current.unionByName(added), conflicts


def apply_record(current: DataFrame, record: DataFrame, now: Column) -> DataFrame:
    """The table after one record, outside of any batch.

    As ``apply_batch``, except that the native id and ``updated_at`` are always
    overwritten and an unchanged row counts as processed.
    """
    incoming = latest(record).select("data_id", *(F.col(c).alias(f"new_{c}") for c in FIELDS), F.lit(True).alias("written"))
    both = current.withColumn("is_old", F.lit(True)).join(incoming, "data_id", "full")
    same = F.col("is_old") & F.col("written") & F.col("hash").eqNullSafe(F.col("new_hash"))
    keeps = {"hash": same, "data": same, "media": same & F.col("media").isNotNull()}
    return both.select(
        "data_id",
        *(F.when(F.col("written") & ~F.coalesce(keeps.get(c, F.lit(False)), F.lit(False)), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in FIELDS),
        F.when(F.col("written"), now).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(F.col("written"), "processed").alias("outcome"),
    )
