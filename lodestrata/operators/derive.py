"""From documents to the vertex and edge rows they assert.

``documents``: one row for each ``data_id``, with ``data``, a JSON string, and
perhaps ``seq``, its order of arrival. Every relation is a set. Those scoped by
a document are made distinct by array functions inside its row, without any
shuffle; only vertices and additive edges, which several documents may assert,
are reduced across documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import documents as D
from ..functions import text, vocabulary

SOURCE = "discogs"

ENTITIES = ("artists", "labels", "masters", "releases")

#: Relations whose rows of a changed document are deleted before its new ones come in.
REPLACED = {
    "artists": {"alias_of"},
    "labels": set(),
    "masters": {"master_by_artist", "master_in_genre", "master_in_style"},
    "releases": {"by_artist", "on_label", "derived_from", "in_genre", "in_style", "credited_on", "issued_on", "track_credited_on", "track_by_artist"},
}
#: Replaced only for releases that have a companies block.
CONDITIONAL = "credited_to"
#: Rows of these are written by several documents, and so never deleted with one.
ADDITIVE = {"member_of", "same_as"}
#: The column that names the document, and for shared relations the source that may be replaced.
DOCUMENT_COLUMN = {
    "alias_of": "artist_id",
    "master_by_artist": "master_id",
    "master_in_genre": "master_id",
    "master_in_style": "master_id",
} | dict.fromkeys([*REPLACED["releases"], CONDITIONAL], "release_id")
SOURCE_SCOPED = {"issued_on", "credited_to"}

Relations = dict[str, DataFrame]


def parsed(documents: DataFrame) -> DataFrame:
    """Adds ``v``, the document as a variant; unreadable JSON gives null."""
    return documents.withColumn("v", F.try_parse_json("data"))


def _pairs(docs: DataFrame, key: str, values: Column, name: str) -> DataFrame:
    """A row for each of the ``values``, which are distinct within a document."""
    return docs.select(F.col("data_id").alias(key), F.explode(values).alias(name))


def _in_order(docs: DataFrame, *position: Column) -> list[Column]:
    """What orders spellings: the document's arrival, where it is known (``seq``), and the place in it."""
    return [F.struct(F.col("seq"), *position).alias("seq")] if "seq" in docs.columns else []


def _spellings(rows: DataFrame) -> DataFrame:
    """Distinct rows; where there is an order (``seq``), each with the first place that it has in it."""
    names = [c for c in rows.columns if c != "seq"]
    return rows.distinct() if len(names) == len(rows.columns) else rows.groupBy(*names).agg(F.min("seq").alias("seq"))


def artists(documents: DataFrame) -> Relations:
    docs = parsed(documents)
    v = F.col("v")
    members = _pairs(docs, "group_artist_id", D.ids(D.items(D.at(v, "members"))), "member_artist_id")
    groups = _pairs(docs, "member_artist_id", D.ids(D.items(D.at(v, "groups"))), "group_artist_id")
    return {
        "member_of": members.unionByName(groups).select("member_artist_id", "group_artist_id").distinct(),
        "alias_of": _pairs(docs, "artist_id", D.ids(D.items(D.at(v, "aliases"))), "alias_artist_id").select("alias_artist_id", "artist_id"),
    }


def masters(documents: DataFrame) -> Relations:
    docs = parsed(documents)
    v = F.col("v")
    genres, styles = D.tags(D.at(v, "genres")), D.tags(D.at(v, "styles"))
    return {
        "genre": docs.select(F.explode(genres).alias("name")).distinct(),
        "style": docs.select(F.explode(styles).alias("name")).distinct(),
        "master_by_artist": _pairs(docs, "master_id", D.ids(D.items(D.at(v, "artists"))), "artist_id"),
        "master_in_genre": _pairs(docs, "master_id", genres, "genre_name"),
        "master_in_style": _pairs(docs, "master_id", styles, "style_name"),
    }


def _track_rows(docs: DataFrame, values, name: str) -> DataFrame:
    """A row for each value that ``values(track)`` finds in a track or sub-track; a document is parsed and exploded once.

    Ordinals count from one over all elements, also over those that aren't
    objects and so have no row; a track itself has sub-track ordinal zero.
    """

    def found(track, i, k):
        position = D.string(D.at(track, "position"))
        return F.transform(values(track), lambda x: F.struct((i + 1).cast("long").alias("track_ordinal"), k.cast("long").alias("sub_track_ordinal"), position.alias("track_position"), x.alias(name)))

    def of_track(track, i):
        sub = F.transform(D.unwrap(D.at(track, "sub_tracks"), "track"), lambda s, k: F.when(D.is_object(s), found(s, i, k + 1)))
        return F.when(D.is_object(track), F.concat(found(track, i, F.lit(0)), F.flatten(F.filter(sub, lambda x: x.isNotNull()))))

    each = F.transform(D.unwrap(D.at(F.col("v"), "tracklist"), "track"), of_track)
    rows = docs.select(F.col("data_id").alias("release_id"), F.explode(F.flatten(F.filter(each, lambda x: x.isNotNull()))).alias("t"))
    return rows.select("release_id", "t.track_ordinal", "t.sub_track_ordinal", "t.track_position", f"t.{name}")


def track_credits(docs: DataFrame) -> DataFrame:
    """Credits on tracks, each (name, role, artist) of a track once."""
    rows = _track_rows(docs, lambda track: F.array_distinct(D.credits(D.unwrap(D.at(track, "extraartists"), "artist"))), "c")
    return rows.select(F.col("c.name").alias("person_name"), "release_id", "track_ordinal", "sub_track_ordinal", "track_position", "c.role", "c.artist_id")


def track_performers(docs: DataFrame) -> DataFrame:
    return _track_rows(docs, lambda track: D.ids(D.unwrap(D.at(track, "artists"), "artist")), "artist_id")


def media_items(v: Column) -> Column:
    """The media of a release as structs (medium, family, qty), in source order.

    The canonical block if it is an object; else the formats, with quantities
    only if every one of them is an object.
    """
    media, formats = D.at(v, "media"), D.items(D.at(v, "formats"))
    canonical = F.transform(
        D.objects(D.items(D.at(media, "items"))),
        lambda i: F.struct(D.string(D.at(i, "medium")).alias("medium"), D.string(D.at(i, "family")).alias("family"), D.quantity(D.at(i, "qty")).alias("qty")),
    )
    structured = F.forall(formats, D.is_object)

    def descriptions(f):
        d = D.at(f, "descriptions")
        return F.filter(F.transform(D.unwrap(d, "description"), D.string), lambda s: s.isNotNull())

    def from_format(f):
        found = vocabulary.medium_of(D.string(D.at(f, "name")), descriptions(f))
        qty = F.when(structured, text.positive_whole(F.coalesce(D.string(D.at(f, "qty")), D.whole(D.at(f, "qty")))).try_cast("long"))
        return F.struct(found["medium"].alias("medium"), found["family"].alias("family"), F.coalesce(qty, F.lit(1)).cast("long").alias("qty"))

    chosen = F.when(D.is_object(media), canonical).otherwise(F.transform(D.objects(formats), from_format))
    usable = F.filter(chosen, lambda i: (i["medium"] != "") & (i["family"] != ""))
    return F.coalesce(usable, F.array().cast("array<struct<medium:string,family:string,qty:bigint>>"))


def release_media(docs: DataFrame) -> DataFrame:
    """(release_id, medium_id, family, label, qty): quantities summed, the first family kept, all within the row."""
    items = F.col("items")

    def summed(m):
        same = F.filter(items, lambda i: i["medium"] == m)
        return F.struct(m.alias("medium"), same[0]["family"].alias("family"), F.aggregate(same, F.lit(0).cast("long"), lambda n, i: n + F.coalesce(i["qty"], F.lit(0))).alias("qty"), F.exists(same, lambda i: i["qty"].isNotNull()).alias("known"))

    media = F.transform(F.array_distinct(F.transform(items, lambda i: i["medium"])), summed)
    in_order = ["seq"] if "seq" in docs.columns else []
    listed = docs.select(F.col("data_id").alias("release_id"), *in_order, media_items(F.col("v")).alias("items"))
    rows = listed.select("release_id", *in_order, F.posexplode(media).alias("pos", "m"))
    medium = F.col("m.medium")
    return rows.select("release_id", medium.alias("medium_id"), "m.family", vocabulary.medium_label(medium).alias("label"), F.when(F.col("m.known"), F.col("m.qty")).alias("qty"), *_in_order(docs, F.col("pos")))


def release_companies(docs: DataFrame) -> DataFrame:
    """(release_id, company_id, name, role, role_category): the first entry of a company and role wins, all within the row."""
    block = D.at(F.col("v"), "companies")
    in_order = ["seq"] if "seq" in docs.columns else []
    items = docs.where(D.is_object(block)).select(F.col("data_id").alias("release_id"), *in_order, D.objects(D.items(D.at(block, "items"))).alias("items"))
    named = items.withColumn("folded", D.folded_names(F.col("items")))
    fields = F.transform(
        "items",
        lambda item, i: F.struct(
            D.company_id_of(item, F.get(F.col("folded"), i)).alias("company_id"), text.text_or_null(D.string(D.at(item, "role"))).alias("role"),
            text.text_or_null(D.string(D.at(item, "name"))).alias("name"), text.text_or_null(D.string(D.at(item, "role_category"))).alias("category"),
        ),
    )
    kept = named.select("release_id", *in_order, F.filter(fields, lambda f: f["company_id"].isNotNull() & f["role"].isNotNull()).alias("found"))
    key = lambda f: F.struct(f["company_id"], f["role"])
    keys = F.transform("found", key)
    first = F.filter("found", lambda f, i: F.array_position(F.col("keys"), key(f)) == i + 1)
    rows = kept.withColumn("keys", keys).select("release_id", *in_order, F.posexplode(first).alias("pos", "f"))
    return rows.select("release_id", "f.company_id", F.coalesce("f.name", "f.company_id").alias("name"), "f.role", F.coalesce("f.category", F.lit(vocabulary.OTHER_ROLE)).alias("role_category"), *_in_order(docs, F.col("pos")))


def releases(documents: DataFrame) -> Relations:
    docs = parsed(documents)
    v = F.col("v")
    genres, styles = D.tags(D.at(v, "genres")), D.tags(D.at(v, "styles"))
    credit = F.explode(F.array_distinct(D.credits(D.items(D.at(v, "extraartists"))))).alias("c")
    named = docs.select(F.col("data_id").alias("release_id"), credit).select("release_id", F.col("c.name").alias("person_name"), "c.role", "c.artist_id")
    pairs = F.array_distinct(F.transform(D.credits(D.items(D.at(v, "extraartists"))), lambda c: F.struct(c["name"].alias("name"), c["role"].alias("role"))))
    on_tracks = track_credits(docs)
    people = named.select("person_name", "artist_id").unionByName(on_tracks.select("person_name", "artist_id"))
    media, companies = release_media(docs), release_companies(docs)
    label_id = F.when(text.all_digits(F.col("company_id")), F.col("company_id"))
    order = ["seq"] if "seq" in documents.columns else []
    return {
        "genre": docs.select(F.explode(genres).alias("name")).distinct(),
        "style": docs.select(F.explode(styles).alias("name")).distinct(),
        "person": people.select(F.col("person_name").alias("name")).distinct(),
        "media_family": media.select(F.col("family").alias("name")).distinct(),
        "medium": _spellings(media.select("medium_id", "family", "label", *order)),
        "company": _spellings(companies.select("company_id", "name", label_id.alias("discogs_label_id"), *order)),
        "by_artist": _pairs(docs, "release_id", D.ids(D.items(D.at(v, "artists"))), "artist_id"),
        "on_label": _pairs(docs, "release_id", D.ids(D.items(D.at(v, "labels"))), "label_id"),
        "derived_from": docs.select(F.col("data_id").alias("release_id"), D.usable_id(D.at(v, "master_id")).alias("master_id")).where("master_id is not null"),
        "in_genre": _pairs(docs, "release_id", genres, "genre_name"),
        "in_style": _pairs(docs, "release_id", styles, "style_name"),
        "credited_on": docs.select(F.col("data_id").alias("release_id"), F.explode(pairs).alias("c")).select(F.col("c.name").alias("person_name"), "release_id", "c.role"),
        "same_as": people.where("artist_id is not null").distinct(),
        "issued_on": media.select("release_id", "medium_id", F.lit(SOURCE).alias("source"), "qty"),
        "credited_to": companies.select("release_id", "company_id", "role", "role_category", F.lit(SOURCE).alias("source")),
        "track_credited_on": _track_rows(docs, lambda track: F.array_distinct(F.transform(D.credits(D.unwrap(D.at(track, "extraartists"), "artist")), lambda c: F.struct(c["name"].alias("name"), c["role"].alias("role")))), "c").select(
            F.col("c.name").alias("person_name"), "release_id", "track_ordinal", "sub_track_ordinal", "track_position", "c.role"
        ),
        "track_by_artist": track_performers(docs),
    }


def derive(entity: str, documents: DataFrame) -> Relations:
    """The relations that documents of one entity assert; labels assert none, nor does an unknown entity."""
    return {"artists": artists, "masters": masters, "releases": releases}.get(entity, lambda _: {})(documents)


def has_companies_block(documents: DataFrame) -> DataFrame:
    """``data_id`` of the releases whose ``credited_to`` rows are to be replaced."""
    return parsed(documents).where(D.is_object(D.at(F.col("v"), "companies"))).select("data_id")


def with_role_category(edges: DataFrame) -> DataFrame:
    """Adds the category of ``role``: a few comparisons in the row, cheaper than a join with the distinct roles."""
    return edges.withColumn("role_category", vocabulary.role_category(F.col("role")))


def part_of(in_genre: DataFrame, in_style: DataFrame, key: str = "release_id") -> DataFrame:
    """(style_name, genre_name) from releases, or masters, that have exactly one genre."""
    single = in_genre.distinct().groupBy(key).agg(F.count("*").alias("n"), F.min("genre_name").alias("genre_name")).where("n = 1").select(key, "genre_name")
    return in_style.join(single, key).select("style_name", "genre_name").distinct()


def in_family(medium: DataFrame) -> DataFrame:
    return medium.where("family is not null").select("medium_id", F.col("family").alias("family_name")).distinct()


def sublabel_of(labels: DataFrame) -> DataFrame:
    """(sublabel_id, parent_id) from label documents, stated at either end."""
    docs = parsed(labels)
    v = F.col("v")
    up = docs.select(F.col("data_id").alias("sublabel_id"), D.usable_id(D.at(D.at(v, "parentLabel"), "id")).alias("parent_id")).where("parent_id is not null")
    down = _pairs(docs, "parent_id", D.ids(D.items(D.at(v, "sublabels"))), "sublabel_id")
    return up.unionByName(down).distinct()


def release_years(documents: DataFrame) -> DataFrame:
    """(release_id, year): the positive year of each release, from ``year`` or else the date ``released``; or null."""
    docs = parsed(documents)

    def year(key: str) -> Column:
        value = D.at(F.col("v"), key)
        return text.plausible_year(F.coalesce(D.string(value), D.whole(value)))

    return docs.select(F.col("data_id").alias("release_id"), F.coalesce(year("year"), year("released")).alias("year"))


def labels_vertex(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("data_id").alias("label_id")).distinct()


def candidates(entity: str, documents: DataFrame) -> DataFrame:
    """The documents that can assert additive edges at all, so that a reconciliation derives from those only."""
    v = F.try_parse_json("data")
    fields = {"artists": ("members", "groups"), "releases": ("extraartists",)}.get(entity, ())
    wanted = F.lit(False)
    for f in fields:
        wanted = wanted | (F.size(D.items(D.at(v, f))) > 0)
    if entity == "releases":  # credits on tracks lie too deep for a cheap test
        wanted = wanted | ~D.is_null(D.at(v, "tracklist"))
    return documents.where(wanted)
