"""Catalog relations and documents over the star-schema tables.

Orders stand for releases, suppliers for artists, brands for labels, part
types and names for genres and styles, customers for masters, events for
versions of documents. Each relation is here once as DataFrame code and once
as SQL, so that queries can be held against an independent engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

EXTRA_GENRE, EXTRA_STYLE, EXTRA_LABEL = "Unheard", "no style", "Brand#none"


def _s(name: str):
    return F.col(name).cast("string")


class Edges:
    """The relations, each built when it is asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.read = lambda name: table(spark, folder, name)
        self.spark = spark

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def lines(self) -> DataFrame:
        part = self.read("part").select("p_partkey", F.col("p_brand").alias("label_id"), F.col("p_type").alias("genre_name"), F.col("p_name").alias("style_name"))
        line = self.read("lineitem").select("l_partkey", _s("l_orderkey").alias("release_id"), _s("l_suppkey").alias("artist_id"), "l_linenumber", "l_returnflag")
        return line.join(part, F.col("l_partkey") == F.col("p_partkey"))

    def by_artist(self):
        return self.read("lineitem").select(_s("l_orderkey").alias("release_id"), _s("l_suppkey").alias("artist_id")).distinct()

    def on_label(self):
        return self.lines().select("release_id", "label_id").distinct()

    def in_genre(self):
        return self.lines().select("release_id", "genre_name").distinct()

    def in_style(self):
        return self.lines().select("release_id", "style_name").distinct()

    def derived_from(self):
        return self.read("orders").select(_s("o_orderkey").alias("release_id"), _s("o_custkey").alias("master_id"))

    def years(self):
        return self.read("orders").select(_s("o_orderkey").alias("release_id"), F.year("o_orderdate").alias("year"))

    def credited_on(self):
        return self.lines().select(F.col("style_name").alias("person_name"), "release_id", F.col("l_returnflag").alias("role")).distinct()

    def same_as(self):
        return self.lines().where("l_linenumber = 1").select(F.col("style_name").alias("person_name"), "artist_id").distinct()

    def issued_on(self):
        rows = self.read("lineitem").groupBy(_s("l_orderkey").alias("release_id"), F.col("l_linestatus").alias("medium_id"))
        return rows.agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("long").alias("qty")).withColumn("source", F.lit("discogs"))

    def credited_to(self):
        return self.lines().where("l_linenumber = 1").select("release_id", F.col("label_id").alias("company_id"), F.col("l_returnflag").alias("role"), F.lit("discogs").alias("source")).distinct()

    def _of_master(self, *names: str):
        return self.lines().join(self.derived_from(), "release_id").select("master_id", *names).distinct()

    def master_by_artist(self):
        return self._of_master("artist_id")

    def master_in_genre(self):
        return self._of_master("genre_name")

    def master_in_style(self):
        return self._of_master("style_name")

    def member_of(self):
        pair = [_s("s_suppkey").alias("member_artist_id"), _s("s_nationkey").alias("group_artist_id")]
        s = self.read("supplier")
        return s.where("s_acctbal > 0").select(*pair).union(s.where("s_suppkey % 2 = 0").select(*pair)).distinct()

    artist_member_of = member_of

    def alias_of(self):
        return self.read("supplier").where("s_suppkey % 10 = 3").select(_s("s_suppkey").alias("alias_artist_id"), F.expr("cast(s_suppkey div 10 as string)").alias("artist_id"))

    def _vertex(self, column: str, name: str, extra: str):
        return self.read("part").select(F.col(column).alias(name)).union(self.spark.createDataFrame([(extra,)], f"{name} string")).distinct()

    def genre(self):
        return self._vertex("p_type", "genre_name", EXTRA_GENRE)

    def style(self):
        return self._vertex("p_name", "style_name", EXTRA_STYLE)

    def label(self):
        return self._vertex("p_brand", "label_id", EXTRA_LABEL)


EDGES_SQL = """
with lines as (
  select l_orderkey::varchar as release_id, l_suppkey::varchar as artist_id, p_brand as label_id, p_type as genre_name, p_name as style_name, l_linenumber, l_returnflag
  from lineitem join part on l_partkey = p_partkey
),
by_artist as (select distinct l_orderkey::varchar as release_id, l_suppkey::varchar as artist_id from lineitem),
on_label as (select distinct release_id, label_id from lines),
in_genre as (select distinct release_id, genre_name from lines),
in_style as (select distinct release_id, style_name from lines),
derived_from as (select o_orderkey::varchar as release_id, o_custkey::varchar as master_id from orders),
years as (select o_orderkey::varchar as release_id, year(o_orderdate)::int as year from orders),
credited_on as (select distinct style_name as person_name, release_id, l_returnflag as role from lines),
same_as as (select distinct style_name as person_name, artist_id from lines where l_linenumber = 1),
issued_on as (select l_orderkey::varchar as release_id, l_linestatus as medium_id, sum(l_quantity)::bigint as qty, 'discogs' as source from lineitem group by all),
credited_to as (select distinct release_id, label_id as company_id, l_returnflag as role, 'discogs' as source from lines where l_linenumber = 1),
master_by_artist as (select distinct master_id, artist_id from lines join derived_from using (release_id)),
master_in_genre as (select distinct master_id, genre_name from lines join derived_from using (release_id)),
master_in_style as (select distinct master_id, style_name from lines join derived_from using (release_id)),
member_of as (
  select s_suppkey::varchar as member_artist_id, s_nationkey::varchar as group_artist_id from supplier where s_acctbal > 0
  union select s_suppkey::varchar, s_nationkey::varchar from supplier where s_suppkey % 2 = 0
),
alias_of as (select s_suppkey::varchar as alias_artist_id, (s_suppkey // 10)::varchar as artist_id from supplier where s_suppkey % 10 = 3),
genre as (select distinct p_type as genre_name from part union select 'Unheard'),
style as (select distinct p_name as style_name from part union select 'no style'),
label as (select distinct p_brand as label_id from part union select 'Brand#none')
"""

# Documents.

LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_discount", "l_tax")


def release_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A JSON document for each order that has lines, ``(data_id, data)``; lines in a settled order.

    One line makes a single-object wrapper, several make an array. Supplier 0
    is the id that means no entity; names are padded; some roles are empty; two
    of three orders have a companies block.
    """
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    line = table(spark, folder, "lineitem").select("l_orderkey", *LINE).join(part, F.col("l_partkey") == F.col("p_partkey"))
    orders = line.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*LINE, "p_name", "p_brand", "p_type", "p_size"))).alias("i"))

    def each(f: Callable):
        return F.transform("i", f)

    role = lambda x: F.when(x["l_linestatus"] == "F", "").otherwise(x["l_returnflag"])
    credit = lambda x: F.struct(F.concat(F.lit("‏ "), x["p_name"], F.lit(" ﻿")).alias("name"), role(x).alias("role"), x["l_suppkey"].alias("id"))
    company = lambda x: F.struct(F.when(x["l_linenumber"] % 2 == 0, x["l_suppkey"]).alias("discogs_id"), F.concat(F.lit("  "), F.initcap(F.replace(x["p_name"], F.lit(" "), F.lit("   ")))).alias("name"), x["l_returnflag"].alias("role"), F.when(x["l_linestatus"] == "O", x["p_brand"]).alias("role_category"))
    medium = lambda x: F.struct(F.when(x["l_linestatus"] == "O", "vinyl_12").otherwise("wax").alias("medium"), F.concat(F.lit("family "), x["l_linenumber"].cast("string")).alias("family"), x["l_quantity"].cast("long").alias("qty"))
    track = lambda x: F.struct(x["l_linenumber"].cast("string").alias("position"), F.struct(F.struct(x["l_suppkey"].alias("id")).alias("artist")).alias("artists"), F.struct(F.array(credit(x)).alias("artist")).alias("extraartists"))
    barcode = lambda x: F.struct(F.lit("barcode").alias("type"), F.concat(F.lit("P-"), x["l_partkey"].cast("string")).alias("value"))
    base = F.to_json(
        F.struct(
            F.col("l_orderkey").cast("string").alias("id"),
            each(lambda x: F.struct(x["l_suppkey"].alias("id"))).alias("artists"),
            F.concat(each(lambda x: x["p_type"]), F.array(F.lit(""))).alias("genres"),
            each(credit).alias("extraartists"),
            F.when(F.col("l_orderkey") % 3 != 0, F.struct(each(company).alias("items"))).alias("companies"),
            F.struct(each(medium).alias("items")).alias("media"),
            F.struct(each(barcode).alias("items")).alias("identifiers"),
        )
    )
    tracks = F.when(F.size("i") == 1, F.to_json(each(track)[0])).otherwise(F.to_json(each(track)))
    data = F.concat(F.substring(base, F.lit(1), F.length(base) - 1), F.lit(',"tracklist":{"track":'), tracks, F.lit("}}"))
    return orders.select(F.col("l_orderkey").cast("string").alias("data_id"), data.alias("data"))


NUMBERED_SQL = """
with numbered as (
  select l.*, p.*, l_orderkey::varchar as release_id, row_number() over (
    partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_discount, l_tax, p_name, p_brand, p_type, p_size
  ) as pos
  from lineitem l join part p on l_partkey = p_partkey
)
"""

# Versions of documents.

NOW, STARTED = "2024-02-01 00:00:00", "2024-01-29 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def started():
    return F.lit(STARTED).cast("timestamp_ntz")


def shown(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as versions of the documents of users: (data_id, hash, data, media, gm_item_id, updated_at, seq, stored)."""
    e = table(spark, folder, "events")
    middle = e.agg(F.expr("(max(event_id) + 1) div 2")).first()[0] or 0
    return e.select(
        F.col("user_id").cast("string").alias("data_id"),
        F.col("event_type").alias("hash"),
        F.col("props").alias("data"),
        F.when(F.col("event_id") % 4 != 0, F.col("event_type")).alias("media"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("n"), F.col("user_id").cast("string"))).alias("gm_item_id"),
        F.col("ts").cast("timestamp_ntz").alias("updated_at"),
        F.col("event_id").alias("seq"),
        (F.col("event_id") < middle).alias("stored"),
        "user_id",
    )


VERSIONS_SQL = """
with versions as (
  select user_id::varchar as data_id, event_type as hash, props as data, case when event_id % 4 <> 0 then event_type end as media,
    case when event_id % 3 <> 0 then 'n' || user_id::varchar end as gm_item_id, ts as updated_at, event_id as seq,
    event_id < (select (max(event_id) + 1) // 2 from events) as stored, user_id
  from events
),
current as (
  select * exclude (rn) from (select *, row_number() over (partition by data_id order by seq desc) as rn from versions where stored and user_id % 7 <> 0) where rn = 1
),
batch as (
  select * exclude (rn) from (select *, row_number() over (partition by data_id order by seq desc) as rn from versions where not stored and user_id % 5 <> 0) where rn = 1
),
merged as (
  select coalesce(c.data_id, b.data_id) as data_id, c.hash as old_hash, b.hash as new_hash, c.media as old_media, b.media as new_media, c.gm_item_id as old_id, b.gm_item_id as new_id,
    c.data as old_data, b.data as new_data, c.updated_at,
    case when b.data_id is null then null when c.hash is not null and c.hash = b.hash then 'unchanged' else 'changed' end as class
  from current c full join batch b on c.data_id = b.data_id
),
outcomes as (
  select *, case when class = 'changed' then 'processed' when class = 'unchanged' and old_media is null and new_media is not null then 'media_backfilled'
    when class = 'unchanged' and old_id is null and new_id is not null then 'identity_backfilled' when class = 'unchanged' then 'skipped' end as outcome,
    case when class = 'unchanged' and old_id is null and new_id is not null then true else false end as fills_id
  from merged
),
merged_table as (
  select data_id, outcome,
    case when class = 'changed' then new_hash else old_hash end as hash,
    case when class = 'changed' then new_data else old_data end as data,
    case when class = 'changed' then new_media when outcome = 'media_backfilled' then new_media else old_media end as media,
    case when class = 'changed' then new_id when fills_id then new_id else old_id end as gm_item_id,
    case when class = 'changed' or outcome = 'skipped' then timestamp '2024-02-01 00:00:00' else updated_at end as updated_at
  from outcomes
)
"""


def pages_of_load(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(table, seen): a document for each user and type of event, last written by its last event; half of the load's events, and a few earlier ones, are on its list."""
    e = table(spark, folder, "events").select(F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("data_id"), F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id")
    listed = (F.col("ts") >= started()) & (F.col("event_id") % 2 == 0) | (F.col("event_id") % 50 == 0)
    listed = (F.col("ts") >= started()) & (F.col("event_id") % 2 == 0) | (F.col("event_id") % 50 == 0)
    return e.groupBy("data_id").agg(F.max("ts").alias("updated_at")), e.where(listed).select("data_id")


LOAD_SQL = """
with load_table as (select user_id::varchar || ':' || event_type as data_id, max(ts) as updated_at from events group by 1),
seen as (select user_id::varchar || ':' || event_type as data_id from events where ts >= timestamp '2024-01-29' and event_id % 2 = 0 or event_id % 50 = 0),
stale_time as (select data_id from load_table where updated_at < timestamp '2024-01-29'),
stale_list as (select data_id from stale_time where data_id not in (select data_id from seen))
"""

SIGNAL = {"view": "artists", "click": "labels", "purchase": "masters", "signup": "releases"}


def signals(spark: SparkSession, folder: str) -> DataFrame:
    """(version, signal, event_id, ts): days as versions, types of events as entities."""
    e = table(spark, folder, "events")
    named = F.create_map(*(F.lit(x) for pair in SIGNAL.items() for x in pair))[F.col("event_type")]
    rows = e.select(F.date_format("ts", "yyyyMMdd").alias("version"), named.alias("signal"), "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")
    return rows.where("signal is not null")


SIGNALS_SQL = """
with signals as (
  select * from (
    select strftime(ts, '%Y%m%d') as version, case event_type when 'view' then 'artists' when 'click' then 'labels' when 'purchase' then 'masters' when 'signup' then 'releases' end as signal, event_id, ts, value
    from events) where signal is not null
)
"""
