"""Alias references that the identifiers of releases mint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import documents as D
from ..functions import text

PROVIDER, KIND = "discogs", "release"
#: Types that mint an alias; all others mint none.
TYPES = ("barcode", "catalog_number", "matrix")


def release_aliases(documents: DataFrame) -> DataFrame:
    """(data_id, provider, entity_kind, external_id) of each alias; the provider names the kind of identifier.

    A barcode counts by its digits, a catalog number in upper case with single
    spaces, a matrix as spelled. Blank values mint nothing.
    """
    rows = documents.select("data_id", F.explode(D.objects(D.items(D.at(D.at(F.try_parse_json("data"), "identifiers"), "items")))).alias("i"))
    typed = rows.select("data_id", D.string(D.at(F.col("i"), "type")).alias("type"), D.string(D.at(F.col("i"), "value")).alias("value")).where(F.col("type").isin(*TYPES))
    value = (
        F.when(F.col("type") == "barcode", F.regexp_replace("value", "[^0-9]", ""))
        .when(F.col("type") == "catalog_number", F.upper(text.collapse_space(F.col("value"))))
        .otherwise(text.strip_space(F.col("value")))
    )
    return typed.select("data_id", F.col("type").alias("provider"), F.lit(KIND).alias("entity_kind"), value.alias("external_id")).where("external_id <> ''").distinct()
