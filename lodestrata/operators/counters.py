"""Aggregate relations over the edges of the catalog graph.

Edges are sets of rows. Each co-occurrence count is a join of two edge
relations on the release, reduced to distinct pairs before it is counted, so
that a tag on a third of all releases is spread over its partners. Statistics
have a row for every vertex, zeros included; pair counts and degrees only for
what occurs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _count(rows: DataFrame, key: str, name: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias(name))


def _together(edges: DataFrame, key: str, others: DataFrame, other: str, name: str, on: str = "release_id") -> DataFrame:
    """How many distinct ``other`` share a release with each ``key``."""
    return _count(edges.join(others, on).select(key, other).distinct(), key, name)


def _stats(vertices: DataFrame, key: str, counts: list[DataFrame]) -> DataFrame:
    joined = reduce(lambda df, c: df.join(c, key, "left"), counts, vertices)
    names = [c for df in counts for c in df.columns if c != key]
    return joined.select(key, *(c if c == "first_year" else F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names))


def first_year(edges: DataFrame, key: str, years: DataFrame) -> DataFrame:
    """The least year of each tag's releases; ``years(release_id, year)`` has positive years or nulls."""
    return edges.join(years, "release_id").groupBy(key).agg(F.min("year").cast("int").alias("first_year"))


def tag_stats(vertices: DataFrame, key: str, edges: DataFrame, other_key: str, other_edges: DataFrame, other_name: str, by_artist: DataFrame, on_label: DataFrame, years: DataFrame) -> DataFrame:
    """Releases, artists, labels, tags of the other kind, and first year of each genre or style."""
    return _stats(
        vertices,
        key,
        [
            _count(edges.select(key, "release_id"), key, "release_count"),
            _together(edges, key, by_artist, "artist_id", "artist_count"),
            _together(edges, key, on_label, "label_id", "label_count"),
            _together(edges, key, other_edges, other_key, other_name),
            first_year(edges, key, years),
        ],
    )


def genre_stats(genres: DataFrame, in_genre: DataFrame, in_style: DataFrame, by_artist: DataFrame, on_label: DataFrame, years: DataFrame) -> DataFrame:
    return tag_stats(genres, "genre_name", in_genre, "style_name", in_style, "style_count", by_artist, on_label, years)


def style_stats(styles: DataFrame, in_genre: DataFrame, in_style: DataFrame, by_artist: DataFrame, on_label: DataFrame, years: DataFrame) -> DataFrame:
    return tag_stats(styles, "style_name", in_style, "genre_name", in_genre, "genre_count", by_artist, on_label, years)


def label_stats(labels: DataFrame, on_label: DataFrame, by_artist: DataFrame, in_genre: DataFrame) -> DataFrame:
    return _stats(
        labels,
        "label_id",
        [
            _count(on_label.select("label_id", "release_id"), "label_id", "release_count"),
            _together(on_label, "label_id", by_artist, "artist_id", "artist_count"),
            _together(on_label, "label_id", in_genre, "genre_name", "genre_count"),
        ],
    )


def degree(ends: list[tuple[DataFrame, str]], name: str) -> DataFrame:
    """Rows in which each id stands at one of the named ends; ids without any have no row."""
    by_table: list[tuple[DataFrame, list[str]]] = []
    for df, c in ends:  # both ends of a relation come from one scan of it
        known = next((columns for other, columns in by_table if other is df), None)
        if known is None:
            by_table.append((df, [c]))
        else:
            known.append(c)
    rows = reduce(DataFrame.unionByName, (df.select(F.col(cs[0]).alias(name) if len(cs) == 1 else F.explode(F.array(*cs)).alias(name)) for df, cs in by_table))
    return rows.groupBy(name).agg(F.count("*").alias("degree"))


def artist_degree(edges: dict[str, DataFrame]) -> DataFrame:
    ends = [("by_artist", "artist_id"), ("master_by_artist", "artist_id"), ("same_as", "artist_id"), ("member_of", "member_artist_id"), ("member_of", "group_artist_id"), ("alias_of", "alias_artist_id"), ("alias_of", "artist_id")]
    tables = {r: edges[r] for r in dict(ends)}
    return degree([(tables[r], c) for r, c in ends], "artist_id")


RELEASE_EDGES = ("by_artist", "on_label", "derived_from", "in_genre", "in_style", "credited_on", "credited_to", "issued_on")


def release_degree_base(edges: dict[str, DataFrame]) -> DataFrame:
    return degree([(edges[r], "release_id") for r in RELEASE_EDGES], "release_id")


def pair_count(edges: DataFrame, key: str, in_genre: DataFrame) -> DataFrame:
    """Distinct releases of each (key, genre)."""
    rows = edges.join(in_genre, "release_id")
    return rows.groupBy(key, "genre_name").agg(F.count("*").alias("release_count"))


def artist_genre(by_artist: DataFrame, in_genre: DataFrame) -> DataFrame:
    return pair_count(by_artist, "artist_id", in_genre)


def label_genre(on_label: DataFrame, in_genre: DataFrame) -> DataFrame:
    return pair_count(on_label, "label_id", in_genre)


def artist_member_of(member_of: DataFrame, other: DataFrame | None = None, other_source: str = "musicbrainz") -> DataFrame:
    """Memberships with their source; a second provider's are optional."""
    out = member_of.select("member_artist_id", "group_artist_id").distinct().withColumn("source", F.lit("discogs"))
    if other is not None:
        out = out.unionByName(other.select("member_artist_id", "group_artist_id").distinct().withColumn("source", F.lit(other_source)))
    return out


#: (relation, column, kind of vertex) of all ends that count towards a vertex's degree.
VERTEX_ENDS = (
    ("by_artist", "release_id", "r"), ("by_artist", "artist_id", "a"), ("on_label", "release_id", "r"), ("on_label", "label_id", "l"),
    ("derived_from", "release_id", "r"), ("derived_from", "master_id", "m"), ("in_genre", "release_id", "r"), ("in_genre", "genre_name", "g"),
    ("in_style", "release_id", "r"), ("in_style", "style_name", "s"), ("master_by_artist", "master_id", "m"), ("master_by_artist", "artist_id", "a"),
    ("master_in_genre", "master_id", "m"), ("master_in_genre", "genre_name", "g"), ("master_in_style", "master_id", "m"), ("master_in_style", "style_name", "s"),
    ("artist_member_of", "member_artist_id", "a"), ("artist_member_of", "group_artist_id", "a"), ("alias_of", "alias_artist_id", "a"), ("alias_of", "artist_id", "a"),
)


def vertex_degree(edges: dict[str, DataFrame]) -> DataFrame:
    """(kind, key, degree) over ten relations: both ends from one scan of each, counted within each task before the only shuffle."""
    by_table: dict[str, list] = {}
    for r, c, k in VERTEX_ENDS:
        by_table.setdefault(r, []).append(F.struct(F.lit(k).alias("kind"), F.col(c).alias("key")))
    ends = [edges[r].select(F.inline(F.array(*of))) for r, of in by_table.items() if r in edges]
    return reduce(DataFrame.unionByName, ends).groupBy("kind", "key").agg(F.count("*").alias("degree"))


def refresh(edges: dict[str, DataFrame], vertices: dict[str, DataFrame], years: DataFrame) -> dict[str, DataFrame]:
    """All derived relations, recomputed in full so that counts also go down."""
    e = edges | {"artist_member_of": artist_member_of(edges["member_of"])}
    return {
        "genre_stats": genre_stats(vertices["genre"].select(F.col("name").alias("genre_name")), e["in_genre"], e["in_style"], e["by_artist"], e["on_label"], years),
        "style_stats": style_stats(vertices["style"].select(F.col("name").alias("style_name")), e["in_genre"], e["in_style"], e["by_artist"], e["on_label"], years),
        "label_stats": label_stats(vertices["label"], e["on_label"], e["by_artist"], e["in_genre"]),
        "artist_degree": artist_degree(e),
        "release_degree_base": release_degree_base(e),
        "artist_genre": artist_genre(e["by_artist"], e["in_genre"]),
        "label_genre": label_genre(e["on_label"], e["in_genre"]),
        "artist_member_of": e["artist_member_of"],
        "vertex_degree": vertex_degree(e),
    }
