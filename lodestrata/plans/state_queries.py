"""Snapshots brought up to date: gates, merges, replacement, reconciliation, purges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import merge, purge
from ..sources.tables import table
from . import adaptor
from .adaptor import EDGES_SQL, LOAD_SQL, VERSIONS_SQL, Edges, shown
from .base import query

LOAD_START = datetime(2024, 1, 1)
COLUMNS = ("data_id", "hash", "data", "media", "gm_item_id")


def _tables(spark, folder):
    v = adaptor.versions(spark, folder)
    current = merge.latest(v.where("stored and user_id % 7 <> 0").select(*COLUMNS, "updated_at", "seq")).drop("seq")
    return current, v.where("not stored and user_id % 5 <> 0").select(*COLUMNS, "seq")


def _merged(spark, folder, touch=True):
    current, batch = _tables(spark, folder)
    return merge.apply_batch(current, batch, adaptor.now(), touch)


@query(VERSIONS_SQL + "select data_id, hash, data, seq from batch")
def dedup_latest(spark, folder):
    return merge.latest(_tables(spark, folder)[1]).select("data_id", "hash", "data", "seq")


@query(VERSIONS_SQL + "select data_id, class as outcome from merged where class is not null")
def hash_gate_classify(spark, folder):
    current, batch = _tables(spark, folder)
    return merge.classify(batch, current).select("data_id", "outcome")


@query(VERSIONS_SQL + "select data_id, hash, data, media, gm_item_id, strftime(updated_at, '%Y-%m-%d %H:%M:%S') as updated_at from merged_table")
def upsert_merge(spark, folder):
    return _merged(spark, folder).select(*COLUMNS, shown("updated_at").alias("updated_at"))


@query(VERSIONS_SQL + "select data_id, strftime(updated_at, '%Y-%m-%d %H:%M:%S') as updated_at from merged_table where outcome = 'skipped'")
def touch_unchanged(spark, folder):
    return _merged(spark, folder).where("outcome = 'skipped'").select("data_id", shown("updated_at").alias("updated_at"))


@query(VERSIONS_SQL + "select data_id, strftime(o.updated_at, '%Y-%m-%d %H:%M:%S') as updated_at from outcomes o where outcome = 'skipped'")
def seen_mode_keeps_times(spark, folder):
    return _merged(spark, folder, touch=False).where("outcome = 'skipped'").select("data_id", shown("updated_at").alias("updated_at"))


@query(VERSIONS_SQL + "select data_id, media, strftime(updated_at, '%Y-%m-%d %H:%M:%S') as updated_at from merged_table where outcome = 'media_backfilled'")
def media_backfill(spark, folder):
    return _merged(spark, folder).where("outcome = 'media_backfilled'").select("data_id", "media", shown("updated_at").alias("updated_at"))


@query(VERSIONS_SQL + "select data_id, gm_item_id from merged_table where outcome in ('identity_backfilled', 'media_backfilled') and gm_item_id is not null")
def identity_backfill(spark, folder):
    return _merged(spark, folder).where("outcome in ('identity_backfilled', 'media_backfilled') and gm_item_id is not null").select("data_id", "gm_item_id")


@query(
    """
with spelled as (select p_name as company_id, p_brand || ':' || p_partkey as name, p_partkey as seq from part),
held as (select company_id, min_by(name, seq) as name from spelled where seq % 4 = 0 group by company_id),
new as (select company_id, min_by(name, seq) as name from spelled where seq % 4 <> 0 group by company_id)
select * from held union all select * from new where company_id not in (select company_id from held)"""
)
def vertex_first_spelling(spark, folder):
    spelled = table(spark, folder, "part").select(F.col("p_name").alias("company_id"), F.concat_ws(":", "p_brand", F.col("p_partkey").cast("string")).alias("name"), F.col("p_partkey").alias("seq"))
    held = spelled.where("seq % 4 = 0").groupBy("company_id").agg(F.min_by("name", "seq").alias("name"))
    return merge.insert_vertices(held, spelled.where("seq % 4 <> 0"), "company_id")


@query(
    EDGES_SQL
    + """
select * from by_artist where release_id::bigint % 5 <> 0
union select release_id, artist_id from by_artist where release_id::bigint % 5 = 0 and artist_id::bigint % 2 = 0 and release_id::bigint % 10 = 0"""
)
def doc_scoped_replace(spark, folder):
    e = Edges(spark, folder)
    changed = e["derived_from"].where("cast(release_id as bigint) % 5 = 0").select(F.col("release_id").alias("data_id"))
    new = e["by_artist"].where("cast(release_id as bigint) % 10 = 0 and cast(artist_id as bigint) % 2 = 0")
    return merge.replace_for_documents(e["by_artist"], new, changed, "release_id")


ISSUED_SQL = EDGES_SQL + ", issued as (select release_id, medium_id, qty, case medium_id when 'O' then 'discogs' else 'other' end as source from issued_on)"


def _issued(spark, folder):
    return Edges(spark, folder)["issued_on"].withColumn("source", F.when(F.col("medium_id") == "O", "discogs").otherwise("other"))


@query(ISSUED_SQL + "select * from issued where not (source = 'discogs' and release_id::bigint % 3 = 0) union select release_id, 'new', 1, 'discogs' from issued where release_id::bigint % 6 = 0")
def source_scoped_replace(spark, folder):
    current = _issued(spark, folder)
    changed = current.where("cast(release_id as bigint) % 3 = 0").select(F.col("release_id").alias("data_id"))
    new = current.where("cast(release_id as bigint) % 6 = 0").select("release_id", F.lit("new").alias("medium_id"), F.lit(1).cast("long").alias("qty"), F.lit("discogs").alias("source")).distinct()
    return merge.replace_for_documents(current, new, changed, "release_id", "discogs")


@query(EDGES_SQL + "select * from credited_to where release_id::bigint % 4 <> 0 or release_id::bigint % 8 = 0")
def conditional_replace(spark, folder):
    """Changed releases (every fourth) without a block (every eighth) keep their rows; those with an empty block lose them."""
    current = Edges(spark, folder)["credited_to"]
    with_block = current.where("cast(release_id as bigint) % 4 = 0 and cast(release_id as bigint) % 8 <> 0").select(F.col("release_id").alias("data_id"))
    return merge.replace_for_documents(current, current.limit(0), with_block, "release_id", "discogs")


RECONCILE_SQL = EDGES_SQL + ", held as (select * from same_as where artist_id::bigint % 3 <> 0 union select person_name, 'gone' || artist_id from same_as where artist_id::bigint % 7 = 0)"


def _reconciled(spark, folder):
    asserted = Edges(spark, folder)["same_as"]
    gone = asserted.where("cast(artist_id as bigint) % 7 = 0").select("person_name", F.concat(F.lit("gone"), F.col("artist_id")).alias("artist_id"))
    return merge.reconcile(asserted.where("cast(artist_id as bigint) % 3 <> 0").unionByName(gone), asserted, False)


@query(RECONCILE_SQL + "select * from same_as except select * from held")
def additive_reconcile_inserted(spark, folder):
    return _reconciled(spark, folder)[1]


@query(RECONCILE_SQL + "select * from held except select * from same_as")
def additive_reconcile_deleted(spark, folder):
    return _reconciled(spark, folder)[2]


@query(LOAD_SQL + "select data_id from stale_time")
def stale_touch(spark, folder):
    return purge.stale_by_time(adaptor.pages_of_load(spark, folder)[0], adaptor.started()).select("data_id")


@query(LOAD_SQL + "select data_id from stale_list")
def stale_seen(spark, folder):
    rows, seen = adaptor.pages_of_load(spark, folder)
    return purge.stale_by_list(rows, seen, adaptor.started()).select("data_id")


@query(
    LOAD_SQL
    + """
, n as (select (select count(distinct data_id) from seen) as keys, (select count(distinct data_id) from seen) as produced)
select data_id from load_table where not ((select keys >= 0.95 * produced from n) and data_id in (select data_id from stale_list))"""
)
def seen_purge(spark, folder):
    """What a purge by the list of seen keys leaves: its guard holds, and the rows that are old and not listed go."""
    rows, seen = adaptor.pages_of_load(spark, folder)
    keys = seen.distinct().count()
    guard = purge.seen_guard(purge.SeenList(LOAD_START, keys), LOAD_START, keys)
    left, _ = purge.purge(rows, {}, "labels", purge.stale_by_list(rows, seen, adaptor.started()) if guard is None else rows.limit(0))
    return left.select("data_id")


@query(LOAD_SQL + ", n as (select count(*) as total, (select count(*) from stale_time) as stale from load_table) select total, stale, round(stale / total, 6) as fraction, stale > 0 and stale / total >= 0.9 as refused from n")
def purge_fraction_guard(spark, folder):
    rows, _ = adaptor.pages_of_load(spark, folder)
    counted = purge.counts(rows, purge.stale_by_time(rows, adaptor.started()))
    limit = purge.Limits().most_deleted
    return counted.select("total", "stale", F.round("fraction", 6).alias("fraction"), ((F.col("stale") > 0) & (F.col("fraction") >= limit)).alias("refused"))


@query(
    LOAD_SQL
    + """
, by_seen as (select data_id from load_table where data_id not in (select data_id from seen))
select (select count(*) from stale_time) as touch_stale, (select count(*) from by_seen) as seen_stale,
  (select count(*) from by_seen where data_id not in (select data_id from stale_time)) as refreshed_not_seen,
  (select count(*) from stale_time where data_id not in (select data_id from by_seen)) as seen_not_refreshed,
  coalesce((select string_agg(data_id, ',' order by data_id) from (select data_id from by_seen where data_id not in (select data_id from stale_time) order by data_id limit 20)), '') as refreshed_not_seen_ids,
  coalesce((select string_agg(data_id, ',' order by data_id) from (select data_id from stale_time where data_id not in (select data_id from by_seen) order by data_id limit 20)), '') as seen_not_refreshed_ids"""
)
def shadow_compare(spark, folder):
    rows, seen = adaptor.pages_of_load(spark, folder)
    by_list = rows.join(seen.distinct(), "data_id", "left_anti")
    return purge.shadow_compare(purge.stale_by_time(rows, adaptor.started()), by_list)


@query(LOAD_SQL + ", n as (select count(distinct data_id) as seen_keys, (select count(*) from load_table) as produced from seen) select seen_keys, round(seen_keys / produced, 6) as seen_ratio, case when seen_keys < 0.95 * produced then 'below_fraction' else 'ok' end as guard from n")
def seen_guard(spark, folder):
    rows, seen = adaptor.pages_of_load(spark, folder)
    produced = rows.count()
    counted = purge.seen_counts(seen, produced)
    return counted.select("seen_keys", "seen_ratio", F.when(F.col("seen_keys") < purge.Limits().least_seen * produced, "below_fraction").otherwise("ok").alias("guard"))


@query(
    EDGES_SQL
    + """
, stale as (select o_orderkey::varchar as release_id from orders where o_orderdate < timestamp '1994-01-01')
"""
    + " union all ".join(f"select '{r}' as relation, count(*) as n from {r}" + (" where release_id not in (select release_id from stale)" if r != "same_as" else "") for r in ("by_artist", "on_label", "derived_from", "in_genre", "in_style", "credited_on", "credited_to", "issued_on", "same_as"))
)
def graph_purge(spark, folder):
    from functools import reduce

    e = Edges(spark, folder)
    docs = table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("data_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("updated_at"))
    stale = purge.stale_by_time(docs, F.lit("1994-01-01").cast("timestamp_ntz"))
    names = ("by_artist", "on_label", "derived_from", "in_genre", "in_style", "credited_on", "credited_to", "issued_on", "same_as")
    _, left = purge.purge(docs, {r: e[r] for r in names}, "releases", stale)
    return reduce(lambda a, b: a.unionByName(b), (left[r].agg(F.count("*").alias("n")).select(F.lit(r).alias("relation"), "n") for r in names))


RECORD_SQL = VERSIONS_SQL + """
, record as (select * from batch where user_id % 11 = 0)
select coalesce(c.data_id, r.data_id) as data_id,
  case when r.data_id is null or c.hash = r.hash then c.hash else r.hash end as hash,
  case when r.data_id is null or (c.hash = r.hash and c.media is not null) then c.media else r.media end as media,
  case when r.data_id is null then c.gm_item_id else r.gm_item_id end as gm_item_id,
  strftime(case when r.data_id is null then c.updated_at else timestamp '2024-02-01 00:00:00' end, '%Y-%m-%d %H:%M:%S') as updated_at,
  case when r.data_id is not null then 'processed' end as outcome
from current c full join record r on c.data_id = r.data_id"""


@query(RECORD_SQL)
def single_record_upsert(spark, folder):
    v = adaptor.versions(spark, folder)
    record = v.where("not stored and user_id % 5 <> 0 and user_id % 11 = 0").select(*COLUMNS, "seq")
    done = merge.apply_record(_tables(spark, folder)[0], record, adaptor.now())
    return done.select("data_id", "hash", "media", "gm_item_id", shown("updated_at").alias("updated_at"), "outcome")


@query(VERSIONS_SQL + "select coalesce(outcome, 'absent') as outcome, count(*) as n from merged_table group by 1")
def merge_outcomes(spark, folder):
    return _merged(spark, folder).groupBy(F.coalesce("outcome", F.lit("absent")).alias("outcome")).agg(F.count("*").alias("n"))


@query(EDGES_SQL + "select * from member_of union select member_artist_id, '99' from member_of where member_artist_id::bigint % 4 = 0")
def additive_insert(spark, folder):
    e = Edges(spark, folder)
    new = e["member_of"].where("cast(member_artist_id as bigint) % 4 = 0").select("member_artist_id", F.lit("99").alias("group_artist_id"))
    return merge.insert_edges(e["member_of"], new)


@query(
    """
select p_partkey::varchar as external_id,
  substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) as native_id
from (select p_partkey, sha256('discogs' || chr(31) || 'release' || chr(31) || p_partkey::varchar) as h from part)"""
)
def native_ids(spark, folder):
    external = F.col("p_partkey").cast("string")
    return table(spark, folder, "part").select(external.alias("external_id"), merge.native_id(F.lit("discogs"), F.lit("release"), external).alias("native_id"))
