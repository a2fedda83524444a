"""A small catalog made for these tests, counted by hand."""

ARTISTS = [
    {"id": "A10", "name": "Quartet", "members": [{"id": "A11"}, {"id": "A12"}]},
    {"id": "A11", "name": "Viola"},
    {"id": "A13", "name": "Cello", "groups": [{"id": "A10"}]},
    {"id": "A14", "name": "Solo", "aliases": [{"id": "A12"}]},
]
LABELS = [{"id": "L7", "name": "Seven"}, {"id": "L8", "name": "Eight"}, {"id": "L9", "name": "Nine"}]
MASTERS = [
    {"id": "M5", "artists": [{"id": "A10"}], "genres": ["Electronic"], "styles": ["Dub", "Ambient"]},
    {"id": "M6", "artists": [{"id": "A14"}], "genres": ["Folk"]},
]
RELEASES = [
    {
        "id": "X1", "year": 1988, "master_id": "M5", "artists": [{"id": "A10"}], "labels": [{"id": "L7"}, {"id": "L8"}], "genres": ["Electronic"], "styles": ["Dub"],
        "extraartists": [{"name": "Ines", "role": "Mixed By", "id": "A11"}, {"name": "Ines", "role": "Design"}],
        "formats": [{"name": "CD"}],
    },
    {"id": "X2", "year": "1991", "master_id": "M5", "artists": [{"id": "A10"}, {"id": "A14"}], "labels": [{"id": "L7"}], "genres": ["Electronic", "Folk"], "styles": ["Dub", "Ambient"]},
    {"id": "X3", "artists": [{"id": "A14"}, {"id": "A13"}], "labels": [{"id": "L9"}], "genres": ["Folk"]},
    {"id": "X4", "year": 2003, "artists": [{"id": "A13"}], "styles": ["Ambient"], "companies": {"items": [{"name": "Kiln Works", "role": "Mastered At"}]}},
]

EXPECTED = {
    "genre_stats": {("Electronic", 2, 2, 2, 2, 1988), ("Folk", 2, 3, 2, 2, 1991)},
    "style_stats": {("Ambient", 2, 3, 1, 2, 1991), ("Dub", 2, 2, 2, 2, 1988)},
    "label_stats": {("L7", 2, 2, 2), ("L8", 1, 1, 1), ("L9", 1, 2, 1)},
    "artist_degree": {("A10", 6), ("A11", 2), ("A12", 2), ("A13", 3), ("A14", 4)},
    "release_degree_base": {("X1", 9), ("X2", 8), ("X3", 4), ("X4", 3)},
    "artist_genre": {("A10", "Electronic", 2), ("A10", "Folk", 1), ("A13", "Folk", 1), ("A14", "Electronic", 1), ("A14", "Folk", 2)},
    "label_genre": {("L7", "Electronic", 2), ("L7", "Folk", 1), ("L8", "Electronic", 1), ("L9", "Folk", 1)},
    "artist_member_of": {("A11", "A10", "discogs"), ("A12", "A10", "discogs"), ("A13", "A10", "discogs")},
}
DEGREES_A = {("A10", 6), ("A11", 1), ("A12", 2), ("A13", 3), ("A14", 4)}
PART_OF = {("Dub", "Electronic"), ("Ambient", "Electronic")}
