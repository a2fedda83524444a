"""Small mapping tables. Each holds the entries that are documented, and nothing guessed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Format name with one of its descriptions ("" for none needed) to medium and family.
MEDIA = {
    ("Vinyl", "LP"): ("vinyl_12", "vinyl"),
    ("Vinyl", ""): ("vinyl", "vinyl"),
    ("CD", ""): ("optical_cd", "optical"),
}
# Labels of media; a medium without one is its own label.
MEDIUM_LABELS = {"vinyl_12": "12-inch vinyl", "vinyl": "Vinyl", "optical_cd": "CD"}
# Containers are not media.
CONTAINERS = ("Box Set",)
# Words in a role, in order of precedence, and the category they mean.
ROLE_WORDS = (("master", "mastering"), ("produc", "production"))
OTHER_ROLE = "other"


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))


def medium_label(medium: Column) -> Column:
    return F.coalesce(_map(MEDIUM_LABELS)[medium], medium)


def medium_of(name: Column, descriptions: Column) -> Column:
    """(medium, family) of a format, null if it is unknown or a container."""
    out = F.lit(None).cast("struct<medium:string,family:string>")
    for (n, d), (medium, family) in sorted(MEDIA.items(), key=lambda x: x[0][1] != ""):
        hit = name == n
        if d:
            hit &= F.coalesce(F.array_contains(descriptions, d), F.lit(False))
        out = F.when(hit, F.struct(F.lit(medium).alias("medium"), F.lit(family).alias("family"))).otherwise(out)
    return out


def role_category(role: Column) -> Column:
    low = F.lower(role)
    out = F.lit(OTHER_ROLE)
    for word, category in reversed(ROLE_WORDS):
        out = F.when(low.contains(word), category).otherwise(out)
    return out
