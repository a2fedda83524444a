"""Aggregates and views over the edges of the catalog graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import counters, derive
from .adaptor import EDGES_SQL, Edges
from .base import query


def _tag_sql(vertex: str, key: str, edges: str, other_edges: str, other: str, count: str) -> str:
    return f"""{EDGES_SQL}
select {key},
  (select count(*) from {edges} e where e.{key} = v.{key}) as release_count,
  (select count(distinct artist_id) from {edges} e join by_artist using (release_id) where e.{key} = v.{key}) as artist_count,
  (select count(distinct label_id) from {edges} e join on_label using (release_id) where e.{key} = v.{key}) as label_count,
  (select count(distinct {other}) from {edges} e join {other_edges} using (release_id) where e.{key} = v.{key}) as {count},
  (select min(year) from {edges} e join years using (release_id) where e.{key} = v.{key} and year > 0) as first_year
from {vertex} v"""


@query(_tag_sql("genre", "genre_name", "in_genre", "in_style", "style_name", "style_count"))
def genre_stats(spark, folder):
    e = Edges(spark, folder)
    return counters.genre_stats(e["genre"], e["in_genre"], e["in_style"], e["by_artist"], e["on_label"], e["years"])


@query(_tag_sql("style", "style_name", "in_style", "in_genre", "genre_name", "genre_count"))
def style_stats(spark, folder):
    e = Edges(spark, folder)
    return counters.style_stats(e["style"], e["in_genre"], e["in_style"], e["by_artist"], e["on_label"], e["years"])


@query(
    EDGES_SQL
    + """
select label_id,
  (select count(*) from on_label e where e.label_id = v.label_id) as release_count,
  (select count(distinct artist_id) from on_label e join by_artist using (release_id) where e.label_id = v.label_id) as artist_count,
  (select count(distinct genre_name) from on_label e join in_genre using (release_id) where e.label_id = v.label_id) as genre_count
from label v"""
)
def label_stats(spark, folder):
    e = Edges(spark, folder)
    return counters.label_stats(e["label"], e["on_label"], e["by_artist"], e["in_genre"])


@query(
    EDGES_SQL
    + """
select artist_id, count(*) as degree from (
  select artist_id from by_artist union all select artist_id from master_by_artist union all select artist_id from same_as
  union all select member_artist_id from member_of union all select group_artist_id from member_of
  union all select alias_artist_id from alias_of union all select artist_id from alias_of
) group by artist_id"""
)
def artist_degree(spark, folder):
    return counters.artist_degree(Edges(spark, folder))


@query(
    EDGES_SQL
    + "select release_id, count(*) as degree from ("
    + " union all ".join(f"select release_id from {r}" for r in counters.RELEASE_EDGES)
    + ") group by release_id"
)
def release_degree_base(spark, folder):
    return counters.release_degree_base(Edges(spark, folder))


@query(EDGES_SQL + "select artist_id, genre_name, count(distinct release_id) as release_count from by_artist join in_genre using (release_id) group by all")
def artist_genre(spark, folder):
    e = Edges(spark, folder)
    return counters.artist_genre(e["by_artist"], e["in_genre"])


@query(EDGES_SQL + "select label_id, genre_name, count(distinct release_id) as release_count from on_label join in_genre using (release_id) group by all")
def label_genre(spark, folder):
    e = Edges(spark, folder)
    return counters.label_genre(e["on_label"], e["in_genre"])


class _WithSources(Edges):
    def __contains__(self, name):
        return hasattr(self, name)


@query(
    EDGES_SQL
    + "select kind, key, count(*) as degree from ("
    + " union all ".join(f"select '{k}' as kind, {c} as key from {'member_of' if r == 'artist_member_of' else r}" for r, c, k in counters.VERTEX_ENDS)
    + ") group by all"
)
def vertex_degree(spark, folder):
    return counters.vertex_degree(_WithSources(spark, folder))


@query(EDGES_SQL + "select distinct member_artist_id, group_artist_id, 'discogs' as source from member_of")
def artist_member_of(spark, folder):
    return counters.artist_member_of(Edges(spark, folder)["member_of"])


@query(
    EDGES_SQL
    + """
, single as (select release_id, min(genre_name) as genre_name from in_genre group by release_id having count(*) = 1)
select distinct style_name, genre_name from in_style join single using (release_id)"""
)
def part_of(spark, folder):
    e = Edges(spark, folder)
    return derive.part_of(e["in_genre"], e["in_style"])


@query(EDGES_SQL + "select distinct l_linestatus as medium_id, case l_linestatus when 'O' then 'open' else 'filled' end as family_name from lineitem")
def in_family(spark, folder):
    medium = Edges(spark, folder)["issued_on"].select("medium_id", F.when(F.col("medium_id") == "O", "open").otherwise("filled").alias("family"))
    return derive.in_family(medium)


@query(EDGES_SQL + "select genre_name, min(year)::int as first_year from in_genre join years using (release_id) where year > 0 group by genre_name")
def first_year(spark, folder):
    e = Edges(spark, folder)
    return counters.first_year(e["in_genre"], "genre_name", e["years"])


@query("select o_orderkey::varchar as release_id, (select count(distinct l_suppkey) from lineitem where l_orderkey = o_orderkey) as artist_count from orders where o_orderkey not in (select l_orderkey from lineitem)")
def zero_count_vertices(spark, folder):
    e = Edges(spark, folder)
    artists = e["by_artist"].groupBy("release_id").agg(F.count("*").alias("artist_count"))
    counted = e["derived_from"].select("release_id").join(artists, "release_id", "left")
    return counted.where("artist_count is null").select("release_id", F.lit(0).cast("long").alias("artist_count"))


@query(
    """
select s_suppkey::varchar as member_artist_id, s_nationkey::varchar as group_artist_id from supplier where s_acctbal > 0
union select s_suppkey::varchar, s_nationkey::varchar from supplier where s_suppkey % 2 = 0"""
)
def member_union_dedup(spark, folder):
    return Edges(spark, folder)["member_of"]


@query(EDGES_SQL + "select style_name as person_name, artist_id from lines where l_linenumber = 1 union select style_name, artist_id from lines where l_returnflag = 'R'")
def same_as_union(spark, folder):
    e = Edges(spark, folder)
    on_tracks = e["lines"].where("l_returnflag = 'R'").select(F.col("style_name").alias("person_name"), "artist_id")
    return e["same_as"].unionByName(on_tracks).distinct()


@query(EDGES_SQL + "select person_name, release_id, role, case role when 'R' then 'other' else 'production' end as role_category from credited_on")
def role_category(spark, folder):
    words = F.create_map(F.lit("R"), F.lit("Vocals"), F.lit("A"), F.lit("Producer"), F.lit("N"), F.lit("Co-producer"))
    edges = Edges(spark, folder)["credited_on"].withColumnRenamed("role", "flag").withColumn("role", words[F.col("flag")])
    return derive.with_role_category(edges).select("person_name", "release_id", F.col("flag").alias("role"), "role_category")


@query(EDGES_SQL + ", a as (select release_id, artist_id from by_artist), b as (select release_id, artist_id from lines where l_linenumber <> 2) (select 'only_left' as side, * from (select * from a except select * from b)) union all (select 'only_right' as side, * from (select * from b except select * from a))")
def store_set_difference(spark, folder):
    e = Edges(spark, folder)
    a, b = e["by_artist"], e["lines"].where("l_linenumber <> 2").select("release_id", "artist_id")
    return a.subtract(b).withColumn("side", F.lit("only_left")).unionByName(b.subtract(a).withColumn("side", F.lit("only_right")))
