"""Reading schema-less JSON documents: everything may be absent, null, or of another type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text

VARIANTS = "array<variant>"


def at(v: Column, key: str) -> Column:
    """The value under ``key``, null if there is none."""
    return F.try_variant_get(v, f"$.{key}", "variant")


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def is_null(v: Column) -> Column:
    return v.isNull() | F.coalesce(F.is_variant_null(v), F.lit(True))


def no_items() -> Column:
    return F.array().cast(VARIANTS)


def items(v: Column) -> Column:
    """The elements of an array; none for anything else."""
    return F.coalesce(F.try_variant_get(v, "$", VARIANTS), no_items())


def objects(values: Column) -> Column:
    return F.filter(values, is_object)


def unwrap(v: Column, key: str) -> Column:
    """The children of a wrapper ``{key: child or [children]}``; a bare list is taken as it is."""
    inner = at(v, key)
    inside = F.when(is_null(inner), no_items()).otherwise(F.coalesce(F.try_variant_get(inner, "$", VARIANTS), F.array(inner)))
    return F.when(is_null(v), no_items()).when(is_object(v), inside).otherwise(F.coalesce(F.try_variant_get(v, "$", VARIANTS), F.array(v)))


def string(v: Column) -> Column:
    """A JSON string's value, null for any other type."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def whole(v: Column) -> Column:
    """The digits of a JSON integer, null for any other type, floats and booleans included."""
    return F.when(F.schema_of_variant(v).rlike(r"\A(BIGINT|DECIMAL\([0-9]+,0\))\z"), F.try_variant_get(v, "$", "string"))


def usable_id(v: Column) -> Column:
    """An entity's id as text; null unless it is an integer or a string, not blank and not ``0``."""
    t = F.coalesce(whole(v), text.strip_space(string(v)))
    return F.when(~t.isin("", "0"), t)


def ids(values: Column) -> Column:
    """The distinct usable ids of the objects among ``values``, in order."""
    found = F.transform(objects(values), lambda e: usable_id(at(e, "id")))
    return F.array_distinct(F.filter(found, lambda i: i.isNotNull()))


def tags(v: Column) -> Column:
    """Distinct non-empty strings of an array, spelled as they are, in order."""
    found = F.transform(items(v), string)
    return F.array_distinct(F.filter(found, lambda s: s.isNotNull() & (s != "")))


def named_credits(values: Column) -> Column:
    """Credits with name and role as structs (name, role, artist_id); an all-padding name stays, as an empty one."""
    found = F.transform(
        objects(values),
        lambda e: F.struct(
            F.nullif(string(at(e, "name")), F.lit("")).alias("raw"),
            text.strip_padding(string(at(e, "name"))).alias("name"),
            F.nullif(string(at(e, "role")), F.lit("")).alias("role"),
            usable_id(at(e, "id")).alias("artist_id"),
        ),
    )
    return F.filter(found, lambda c: c["raw"].isNotNull() & c["role"].isNotNull())


def credits(values: Column) -> Column:
    """The credits whose name isn't padding alone."""
    return F.filter(named_credits(values), lambda c: c["name"] != "")


def padding_only(values: Column) -> Column:
    """How many credits were skipped because their name is all padding."""
    return F.size(F.filter(named_credits(values), lambda c: c["name"] == ""))


def quantity(v: Column) -> Column:
    """An integer of at least one; anything else counts as one. Beyond the range of long: null."""
    digits = whole(v)
    n = digits.try_cast("long")
    return F.when(digits.isNull(), F.lit(1).cast("long")).when(n.isNull() & ~digits.startswith("-"), n).otherwise(F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)).cast("long"))


def discogs_id(v: Column) -> Column:
    """A positive whole id as text, from an integer or a string of digits."""
    return F.coalesce(text.positive_whole(whole(v)), text.positive_whole(string(v)))


def _bare_name(item: Column) -> Column:
    return text.nullif_blank(text.collapse_space(string(at(item, "name"))))


def folded_names(items_: Column) -> Column:
    """The names of an array of objects, folded for comparison, in the same places."""
    return text.casefold_all(F.transform(items_, _bare_name))


def company_id_of(item: Column, folded: Column) -> Column:
    """A company's identity: its id, else ``name:`` and the folded name, else null."""
    return F.coalesce(discogs_id(at(item, "discogs_id")), F.concat(F.lit("name:"), folded))


def company_id(item: Column) -> Column:
    return company_id_of(item, text.casefold(_bare_name(item)))
