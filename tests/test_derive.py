from conftest import rows
from pyspark.sql import functions as F

import catalog
from lodestrata.functions import documents as D
from lodestrata.functions import text, vocabulary
from lodestrata.operators import counters, derive, identity


def variant(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, j string").select("i", F.try_parse_json("j").alias("v"))


def column(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_usable_ids(spark):
    df = variant(spark, "1", '"1"', '" 7 "', '"0"', "0", '"00"', "true", "1.5", "null", '""', '"  "', '{"a":1}', None, '"\\u00a0x\\u3000"')
    assert column(df, D.usable_id(F.col("v"))) == ["1", "1", "7", None, None, "00", None, None, None, None, None, None, None, "x"]


def test_unwrap(spark):
    df = variant(spark, '{"track":[1,2]}', '{"track":{"a":1}}', '{"track":null}', '{"other":1}', "[3]", '"x"', "null", None)
    assert column(df, F.size(D.unwrap(F.col("v"), "track"))) == [2, 1, 0, 0, 1, 1, 0, 0]


def test_tags_keep_spelling_and_order(spark):
    df = variant(spark, '["b","a","b",""," a",3,null]', '"x"', None)
    assert column(df, D.tags(F.col("v"))) == [["b", "a", " a"], [], []]


def test_quantities(spark):
    df = variant(spark, "null", "0", "-3", "true", '"2"', "1.5", "4", "1000000000000000000000000000000")
    assert column(df, D.quantity(F.col("v"))) == [1, 1, 1, 1, 1, 1, 4, None]


def test_company_identity(spark):
    df = variant(
        spark,
        *('{"discogs_id":%s,"name":"N"}' % x for x in ("0", '"0"', "-1", '""', '"  "', "null", "true", '"12a"')),
        '{"discogs_id":"0042"}', '{"discogs_id":7}', '{"name":" Old   Mill\\tRooms "}', '{"name":"Straße"}', '{"name":" "}', "{}",
    )
    assert column(df, D.company_id(F.col("v"))) == ["name:n"] * 8 + ["0042", "7", "name:old mill rooms", "name:strasse", None, None]


def test_person_padding(spark):
    df = variant(spark, '[{"name":"\\u200f Ines \\ufeff","role":"r"},{"name":" \\u200c","role":"r"},{"name":"A  B","role":"r"},{"name":"x"},{"name":"y","role":""}]')
    assert column(df, F.transform(D.credits(F.col("v").cast("array<variant>")), lambda c: c["name"])) == [["Ines", "A  B"]]
    assert column(df, D.padding_only(F.col("v").cast("array<variant>"))) == [1]


def test_years(spark):
    values = ["1970", "0", "0000", "", "abc", "1999.5", "-5", None, " 1985 ", "987", "0042", "1970\n", "99999999999"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, y string")
    assert column(df, text.positive_year(F.col("y"))) == [1970, None, None, None, None, None, None, None, 1985, 987, 42, None, None]


def test_versions_and_delays(spark):
    df = spark.createDataFrame(list(enumerate(["20240131", "20240231", "2024013", "20240131\n", "x"])), "i int, y string")
    assert column(df, text.ordered_version(F.col("y"))) == ["20240131", None, None, None, None]
    df = spark.createDataFrame([(i, i) for i in (0, 1, 5, 8, 9, 50)], "i int, n int")
    assert column(df, text.retry_delay(F.col("n"))) == [1, 2, 32, 256, 256, 256]


def test_roles(spark):
    df = spark.createDataFrame(list(enumerate(["Production", "Master Lacquer", "Stage"])), "i int, r string")
    assert column(df, vocabulary.role_category(F.col("r"))) == ["production", "mastering", "other"]


TRACKS = {
    "id": "T",
    "tracklist": {
        "track": [
            {"position": "A1", "extraartists": {"artist": {"name": "P", "role": "Mix", "id": 8}}, "sub_tracks": {"track": [{"position": "a", "artists": {"artist": {"id": 4}}}, {"artists": {"artist": [{"id": ""}, {"id": "0"}]}}]}},
            "not a track",
            {"position": 3, "artists": {"artist": [{"id": 6}, {"id": 6}]}},
        ]
    },
}


def test_tracks_count_skipped_elements(docs):
    out = derive.releases(docs(TRACKS, {"id": "S", "tracklist": {"track": {"artists": {"artist": {"id": 1}}}}}, {"id": "N", "tracklist": "x"}))
    assert rows(out["track_by_artist"]) == [("S", 1, 0, None, "1"), ("T", 1, 1, "a", "4"), ("T", 3, 0, None, "6")]
    assert rows(out["track_credited_on"]) == [("P", "T", 1, 0, "A1", "Mix")]
    assert rows(out["same_as"]) == [("P", "8")]


def test_media_routes(docs):
    out = derive.releases(
        docs(
            {"id": "1", "media": {"items": [{"medium": "vinyl_12", "family": "vinyl", "qty": 1}, {"medium": "vinyl_12", "family": "x", "qty": 2}, {"medium": "", "family": "x"}, {"medium": "wax", "family": "vinyl"}]}, "formats": [{"name": "CD"}]},
            {"id": "2", "formats": [{"name": "Vinyl", "qty": "2", "descriptions": {"description": "LP"}}, {"name": "CD"}]},
            {"id": "3", "formats": [{"name": "Vinyl", "qty": "2"}, "Album"]},
            {"id": "4", "formats": ["Vinyl", 42, None]},
            {"id": "5", "media": "no block", "formats": [{"name": "Box Set"}, {"name": "Wire spool"}]},
        )
    )
    assert rows(out["issued_on"]) == [("1", "vinyl_12", "discogs", 3), ("1", "wax", "discogs", 1), ("2", "optical_cd", "discogs", 1), ("2", "vinyl_12", "discogs", 2), ("3", "vinyl", "discogs", 1)]
    assert ("wax", "vinyl", "wax") in rows(out["medium"])


def test_companies(docs):
    block = {"items": [{"name": "P", "role": " Made "}, {"name": "p", "role": "Made", "role_category": "later"}, {"name": "Q"}, {"role": "r"}]}
    d = docs({"id": "1", "companies": block}, {"id": "2", "companies": []}, {"id": "3", "companies": {"items": []}}, {"id": "4"})
    assert rows(derive.releases(d)["credited_to"]) == [("1", "name:p", "Made", "other", "discogs")]
    assert rows(derive.has_companies_block(d)) == [("1",), ("3",)]


def test_labels_views(docs):
    d = docs({"id": "1", "parentLabel": {"id": 2}}, {"id": "2", "sublabels": [{"id": "1"}, {"id": "3"}]}, {"id": "5", "parentLabel": {"id": "0"}})
    assert rows(derive.sublabel_of(d)) == [("1", "2"), ("3", "2")]


def test_aliases(docs):
    d = docs({"id": "1", "identifiers": {"items": [{"type": "barcode", "value": "5 012-3"}, {"type": "catalog_number", "value": " ab  c1 "}, {"type": "matrix", "value": "xY"}, {"type": "other", "value": "z"}, {"type": "barcode", "value": "none"}]}})
    assert rows(identity.release_aliases(d)) == [("1", "barcode", "release", "50123"), ("1", "catalog_number", "release", "AB C1"), ("1", "matrix", "release", "xY")]


def edges_of(docs):
    masters, releases, artists = derive.masters(docs(*catalog.MASTERS)), derive.releases(docs(*catalog.RELEASES)), derive.artists(docs(*catalog.ARTISTS))
    vertices = {v: masters.get(v, releases[v].limit(0)).unionByName(releases[v]).distinct() for v in ("genre", "style")}
    return artists | {k: v for k, v in masters.items() if k.startswith("master_")} | {k: v for k, v in releases.items()}, vertices


def test_counted_by_hand(docs):
    edges, vertices = edges_of(docs)
    vertices["label"] = derive.labels_vertex(docs(*catalog.LABELS))
    years = derive.release_years(docs(*catalog.RELEASES))
    out = counters.refresh(edges, vertices, years)
    for name, want in catalog.EXPECTED.items():
        assert set(rows(out[name])) == want, name
    assert {(k, n) for kind, k, n in rows(out["vertex_degree"]) if kind == "a"} == catalog.DEGREES_A
    assert set(rows(derive.part_of(edges["in_genre"], edges["in_style"]))) | set(rows(derive.part_of(edges["master_in_genre"], edges["master_in_style"], "master_id"))) == catalog.PART_OF
    assert rows(derive.in_family(edges["medium"])) == [("optical_cd", "optical")]


def test_zero_rows(spark, docs):
    edges, vertices = edges_of(docs)
    more = vertices["genre"].select(F.col("name").alias("genre_name")).union(spark.createDataFrame([("Chant",)], "genre_name string"))
    out = rows(counters.genre_stats(more, edges["in_genre"], edges["in_style"], edges["by_artist"], edges["on_label"], derive.release_years(docs(*catalog.RELEASES))))
    assert ("Chant", 0, 0, 0, 0, None) in out and len(out) == 3
