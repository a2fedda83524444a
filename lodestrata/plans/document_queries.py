"""From JSON documents to rows: guards, nesting, ordinals, media, companies, identifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import documents as D
from ..functions import text, vocabulary
from ..operators import derive, identity, merge
from ..sources.tables import table
from .adaptor import NUMBERED_SQL, release_documents
from .base import query


def _releases(spark, folder):
    return derive.releases(release_documents(spark, folder))


@query(NUMBERED_SQL + "select release_id, pos as track_ordinal, 0::bigint as sub_track_ordinal, l_linenumber::varchar as track_position, l_suppkey::varchar as artist_id from numbered where l_suppkey <> 0")
def explode_ordinality(spark, folder):
    return _releases(spark, folder)["track_by_artist"]


@query(NUMBERED_SQL + "select release_id, count(*) as tracks, case when count(*) = 1 then 'object' else 'array' end as shape from numbered group by release_id")
def unwrap_object_or_array(spark, folder):
    docs = derive.parsed(release_documents(spark, folder))
    wrapper = D.at(F.col("v"), "tracklist")
    shape = F.when(D.is_object(D.at(wrapper, "track")), "object").otherwise("array")
    return docs.select(F.col("data_id").alias("release_id"), F.size(D.unwrap(wrapper, "track")).cast("long").alias("tracks"), shape.alias("shape"))


@query(NUMBERED_SQL + "select distinct release_id, l_suppkey::varchar as artist_id from numbered where l_suppkey <> 0")
def usable_ids(spark, folder):
    return _releases(spark, folder)["by_artist"]


@query(NUMBERED_SQL + "select distinct release_id, p_type as genre_name from numbered")
def tag_names(spark, folder):
    return _releases(spark, folder)["in_genre"]


@query(NUMBERED_SQL + "select distinct p_name as person_name, release_id, l_returnflag as role from numbered where l_linestatus <> 'F'")
def credit_filter(spark, folder):
    return _releases(spark, folder)["credited_on"]


@query(NUMBERED_SQL + "select p_name as person_name, l_suppkey::varchar as artist_id from numbered where l_linestatus <> 'F' and l_suppkey <> 0 group by all")
def person_strip(spark, folder):
    return _releases(spark, folder)["same_as"]


@query(NUMBERED_SQL + "select distinct p_name as person_name, release_id, pos as track_ordinal, 0::bigint as sub_track_ordinal, l_linenumber::varchar as track_position, l_returnflag as role from numbered where l_linestatus <> 'F'")
def track_credits(spark, folder):
    return _releases(spark, folder)["track_credited_on"]


COMPANIES_SQL = (
    NUMBERED_SQL
    + """
, companies as (
  select release_id, pos, l_returnflag as role,
    case when l_linenumber % 2 = 0 and l_suppkey >= 1 then l_suppkey::varchar else 'name:' || lower(p_name) end as company_id,
    array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), '   ') as name,
    case when l_linestatus = 'O' then p_brand else 'other' end as role_category
  from numbered where l_orderkey % 3 <> 0
),
first_company as (select * exclude (rn) from (select *, row_number() over (partition by release_id, company_id, role order by pos) as rn from companies) where rn = 1)
"""
)


@query(COMPANIES_SQL + "select distinct company_id, case when regexp_full_match(company_id, '[0-9]+') then company_id end as discogs_label_id from companies")
def company_identity(spark, folder):
    return _releases(spark, folder)["company"].select("company_id", "discogs_label_id").distinct()


@query(COMPANIES_SQL + "select release_id, company_id, name, role, role_category from first_company")
def company_first_wins(spark, folder):
    return derive.release_companies(derive.parsed(release_documents(spark, folder)))


@query(
    NUMBERED_SQL
    + """
select release_id, case l_linestatus when 'O' then 'vinyl_12' else 'wax' end as medium_id, 'family ' || min_by(l_linenumber, pos)::varchar as family, sum(greatest(1, l_quantity::bigint))::bigint as qty
from numbered group by release_id, l_linestatus"""
)
def media_qty_sum(spark, folder):
    return derive.release_media(derive.parsed(release_documents(spark, folder))).drop("label")


@query("select distinct case l_linestatus when 'O' then 'vinyl_12' else 'wax' end as medium_id, case l_linestatus when 'O' then '12-inch vinyl' else 'wax' end as label from lineitem")
def media_label_fallback(spark, folder):
    return _releases(spark, folder)["medium"].select("medium_id", "label").distinct()


@query(
    """
with f as (select l_orderkey, l_linenumber, case l_returnflag when 'R' then 'Vinyl' when 'A' then 'CD' else 'Box Set' end as name, l_linestatus as d from lineitem)
select name, d as description, case name when 'Vinyl' then case d when 'O' then 'vinyl_12' else 'vinyl' end when 'CD' then 'optical_cd' end as medium, case name when 'Vinyl' then 'vinyl' when 'CD' then 'optical' end as family, count(*) as n
from f group by all"""
)
def format_mapping(spark, folder):
    name = F.when(F.col("l_returnflag") == "R", "Vinyl").when(F.col("l_returnflag") == "A", "CD").otherwise("Box Set")
    rows = table(spark, folder, "lineitem").groupBy(name.alias("name"), F.col("l_linestatus").alias("description")).agg(F.count("*").alias("n"))
    found = vocabulary.medium_of(F.col("name"), F.array(F.when(F.col("description") == "O", "LP").otherwise("Album")))
    return rows.select("name", "description", found["medium"].alias("medium"), found["family"].alias("family"), "n")


ALIASES_SQL = NUMBERED_SQL + ", minted as (select l_partkey::varchar as external_id, release_id, 'n' || release_id as native_id, l_orderkey as seq from numbered)"


def _targets(spark, folder):
    docs = release_documents(spark, folder)
    return identity.release_aliases(docs).select("provider", "entity_kind", "external_id", F.concat(F.lit("n"), F.col("data_id")).alias("native_id"), F.col("data_id").cast("long").alias("seq"))


@query(ALIASES_SQL + "select 'barcode' as provider, external_id, min_by(native_id, seq) as native_id from minted group by external_id")
def alias_first_wins(spark, folder):
    targets = _targets(spark, folder)
    added, _ = merge.attach_aliases(targets.limit(0).drop("seq"), targets)
    return added.select("provider", "external_id", "native_id")


@query(ALIASES_SQL + "select external_id, 'x' || external_id as native_id, min_by(native_id, seq) as refused_id from minted where external_id::bigint % 3 = 0 group by external_id")
def alias_conflicts(spark, folder):
    targets = _targets(spark, folder)
    held = table(spark, folder, "part").where("p_partkey % 3 = 0").select(F.lit("barcode").alias("provider"), F.lit("release").alias("entity_kind"), F.col("p_partkey").cast("string").alias("external_id"))
    _, conflicts = merge.attach_aliases(held.withColumn("native_id", F.concat(F.lit("x"), F.col("external_id"))), targets)
    return conflicts.select("external_id", "native_id", "refused_id")


@query("select n_nationkey::varchar as sublabel_id, n_regionkey::varchar as parent_id from nation where n_regionkey <> 0 or n_nationkey % 2 = 0 union select n_nationkey::varchar, n_regionkey::varchar from nation where false")
def sublabel_of(spark, folder):
    n = table(spark, folder, "nation")
    up = n.where("n_regionkey <> 0").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("data_id"), F.to_json(F.struct(F.struct(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("id")).alias("parentLabel"))).alias("data"))
    down = n.where("n_nationkey % 2 = 0").groupBy("n_regionkey").agg(F.collect_list(F.struct(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"))).alias("sublabels")).select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("data_id"), F.to_json(F.struct("sublabels")).alias("data"))
    out = derive.sublabel_of(up.unionByName(down))
    return out.select(F.substring("sublabel_id", 2, 99).alias("sublabel_id"), F.substring("parent_id", 2, 99).alias("parent_id"))


YEAR_CASES = "case o_orderkey % 5 when 0 then ' ' || year(o_orderdate)::varchar || ' ' when 1 then year(o_orderdate)::varchar when 2 then '0000' when 3 then year(o_orderdate)::varchar || '.5' else '' end"


@query(f"select o_orderkey::varchar as release_id, case when o_orderkey % 5 < 2 then year(o_orderdate)::int end as year from orders where {YEAR_CASES} is not null")
def positive_years(spark, folder):
    y = F.year("o_orderdate").cast("string")
    k = F.col("o_orderkey") % 5
    spelled = F.when(k == 0, F.concat(F.lit(" "), y, F.lit(" "))).when(k == 1, y).when(k == 2, "0000").when(k == 3, F.concat(y, F.lit(".5"))).otherwise("")
    return table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("release_id"), text.positive_year(spelled).alias("year"))


@query(NUMBERED_SQL + "select release_id, count(*) as candidates from numbered where l_orderkey % 2 = 0 group by release_id")
def candidate_documents(spark, folder):
    docs = release_documents(spark, folder)
    bare = docs.select("data_id", F.when(F.col("data_id").cast("long") % 2 == 0, F.col("data")).otherwise(F.lit('{"extraartists": []}')).alias("data"))
    kept = derive.parsed(derive.candidates("releases", bare))
    return kept.select(F.col("data_id").alias("release_id"), F.size(D.items(D.at(F.col("v"), "extraartists"))).cast("long").alias("candidates"))
