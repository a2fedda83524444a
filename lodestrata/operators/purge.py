"""Finding and removing rows that a completed load no longer has."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .derive import DOCUMENT_COLUMN

#: Relations that belong to a purged document; vertices and additive edges are never purged.
OWNED = {
    "artists": ("alias_of",),
    "labels": (),
    "masters": ("master_by_artist", "master_in_genre", "master_in_style"),
    "releases": ("by_artist", "on_label", "derived_from", "in_genre", "in_style", "credited_on", "credited_to", "issued_on", "track_credited_on", "track_by_artist"),
}


@dataclass(frozen=True)
class Limits:
    """The knobs of a purge."""

    most_deleted: float = 0.90
    least_seen: float = 0.95
    margin: timedelta = timedelta(minutes=15)
    mode: str = "touch"

    def __post_init__(self):
        if self.mode not in ("touch", "shadow", "seen"):
            raise ValueError(f"unknown mode {self.mode!r}")


def stale_by_time(table: DataFrame, started_at: Column) -> DataFrame:
    """Rows that weren't written since the load began."""
    return table.where(F.col("updated_at") < started_at)


def stale_by_list(table: DataFrame, seen: DataFrame, started_at: Column) -> DataFrame:
    """Rows older than the load that aren't on its list of seen keys."""
    return stale_by_time(table, started_at).join(seen.select("data_id").distinct(), "data_id", "left_anti")


def counts(table: DataFrame, stale: DataFrame) -> DataFrame:
    """One row: total, stale, and the stale share."""
    both = table.select("data_id").join(stale.select("data_id").distinct().withColumn("stale", F.lit(1)), "data_id", "left")
    return both.agg(F.count("*").alias("total"), F.count("stale").alias("stale")).withColumn("fraction", F.when(F.col("total") > 0, F.col("stale") / F.col("total")).otherwise(F.lit(0.0)))


def skip_reason(started_at: datetime | None, produced: int | None) -> str | None:
    """Why a load isn't purged at all: it has no start, or its producer resumed and counted nothing."""
    if started_at is None:
        return "no_started_at"
    return "resumed" if produced == 0 else None


def too_many(total: int, stale: int, limits: Limits = Limits()) -> bool:
    """Whether a purge is refused; it deletes nothing either way if nothing is stale."""
    return bool(total and stale) and stale / total >= limits.most_deleted


def shadow_compare(by_time: DataFrame, by_list: DataFrame, sample: int = 20) -> DataFrame:
    """One row on how two purges differ: rows in both and in one only, and up to ``sample`` ids of either difference."""
    joined = by_time.select("data_id", F.lit(1).alias("t")).join(by_list.select("data_id", F.lit(1).alias("s")), "data_id", "full")
    only_time, only_list = F.col("t").isNotNull() & F.col("s").isNull(), F.col("t").isNull() & F.col("s").isNotNull()
    totals = joined.agg(F.count_if(F.col("t").isNotNull()).alias("touch_stale"), F.count_if(F.col("s").isNotNull()).alias("seen_stale"), F.count_if(only_list).alias("refreshed_not_seen"), F.count_if(only_time).alias("seen_not_refreshed")).first()
    ids = {name: [r[0] for r in joined.where(cond).select("data_id").orderBy("data_id").limit(sample).collect()] for name, cond in (("refreshed_not_seen_ids", only_list), ("seen_not_refreshed_ids", only_time))}
    row = (*totals, ",".join(map(str, ids["refreshed_not_seen_ids"])), ",".join(map(str, ids["seen_not_refreshed_ids"])))
    return by_time.sparkSession.createDataFrame([row], "touch_stale long, seen_stale long, refreshed_not_seen long, seen_not_refreshed long, refreshed_not_seen_ids string, seen_not_refreshed_ids string")


def seen_counts(seen: DataFrame, produced: int) -> DataFrame:
    """One row: distinct seen keys, and their share of what the producer counted, to six places."""
    return seen.agg(F.count_distinct("data_id").alias("seen_keys")).withColumn("seen_ratio", F.round(F.col("seen_keys") / F.lit(produced), 6))


@dataclass(frozen=True)
class SeenList:
    """The registry row of a load's list of seen keys."""

    opened_at: datetime | None
    keys: int

    def intact(self, started_at: datetime, limits: Limits = Limits()) -> bool:
        """Open since before the load, with a margin for clocks: nothing of it can have been lost."""
        return self.opened_at is not None and self.opened_at <= started_at + limits.margin


def seen_guard(listed: SeenList, started_at: datetime, produced: int | None, limits: Limits = Limits()) -> str | None:
    """Why a list can't be trusted for a purge, or None."""
    if not listed.intact(started_at, limits):
        return "list_not_intact"
    if not produced:
        return "no_producer_count"
    return "below_fraction" if listed.keys < limits.least_seen * produced else None


def already_settled(listed: SeenList, started_at: datetime, limits: Limits = Limits()) -> bool:
    """A list restarted since the load and empty: the purge has been done before."""
    return listed.opened_at is not None and not listed.intact(started_at, limits) and listed.keys == 0


def restart(listed: SeenList, started_at: datetime, now: datetime) -> SeenList:
    """A fresh list, unless the present one was opened for a later load."""
    if listed.opened_at is not None and listed.opened_at > started_at:
        return listed
    return SeenList(now, 0)


def mode_for(wanted: str, has_list_tables: bool) -> str:
    """The wanted mode; without the tables of the list all fall back to touch. An unknown one is an error."""
    return Limits(mode=wanted).mode if has_list_tables else Limits(mode=wanted) and "touch"


def purge(table: DataFrame, edges: dict[str, DataFrame], entity: str, stale: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(table, edges) without the stale documents and the edges they own."""
    ids = stale.select("data_id").distinct()
    left = {r: df.join(ids.select(F.col("data_id").alias(DOCUMENT_COLUMN[r])), DOCUMENT_COLUMN[r], "left_anti").select(*df.columns) if r in OWNED[entity] else df for r, df in edges.items()}
    return table.join(ids, "data_id", "left_anti"), left
