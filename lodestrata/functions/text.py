"""String rules: trimming, padding, folding, digits, years, versions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What counts as white space around a value: wider than Spark's trim, which knows U+0020 only.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Padding around person names: white space, separators, control and format characters.
PADDING = r"[\s\p{Z}\p{Cc}\p{Cf}]"


def strip_space(c: Column) -> Column:
    return F.regexp_replace(c, rf"\A{SPACE}+|{SPACE}+\z", "")


def strip_padding(c: Column) -> Column:
    """A person's name without padding at either end; the inside is left alone."""
    return F.regexp_replace(c, rf"\A{PADDING}+|{PADDING}+\z", "")


def collapse_space(c: Column) -> Column:
    """Runs of inner white space become one space."""
    return F.regexp_replace(strip_space(c), rf"{SPACE}+", " ")


def text_or_null(c: Column) -> Column:
    """Trimmed, and null if nothing is left."""
    return F.nullif(strip_space(c), F.lit(""))


@F.pandas_udf(T.StringType())
def _casefold(s: pd.Series) -> pd.Series:
    return s.str.casefold()


def casefold(c: Column) -> Column:
    """Full Unicode case folding. ASCII, nearly all values, stays in the JVM; Spark's lower() lacks the rest."""
    ascii_only = c.rlike(r"\A[\x00-\x7f]*\z")
    return F.coalesce(F.when(ascii_only, F.lower(c)), _casefold(F.when(~ascii_only, c)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _casefold_each(s: pd.Series) -> pd.Series:
    return s.map(lambda values: None if values is None else [None if x is None else x.casefold() for x in values])


def casefold_all(c: Column) -> Column:
    """``casefold`` of each element; only arrays with something beyond ASCII leave the JVM."""
    plain = F.forall(c, lambda x: x.isNull() | x.rlike(r"\A[\x00-\x7f]*\z"))
    return F.coalesce(F.when(plain, F.transform(c, lambda x: F.lower(x))), _casefold_each(F.when(~plain, c)))


def all_digits(c: Column) -> Column:
    return c.rlike(r"\A[0-9]+\z")


def positive_whole(c: Column) -> Column:
    """Digits with a value of at least one, kept as spelled; otherwise null."""
    t = strip_space(c)
    return F.when(t.rlike(r"\A0*[1-9][0-9]*\z"), t)


def positive_year(c: Column) -> Column:
    """A year as an int: digits only once spaces around are gone, above zero, in range; otherwise null."""
    t = F.btrim(c)
    return F.when(t.rlike(r"\A0*[1-9][0-9]*\z"), t.try_cast("int"))


def plausible_year(c: Column, least: int = 1860, most: int = 2100) -> Column:
    """The year that a date string begins with, if it is plausible; the bounds are this library's choice."""
    y = F.regexp_extract(F.btrim(c), r"\A([0-9]{4})(?:[^0-9].*)?\z", 1).try_cast("int")
    return F.when(y.between(least, most), y)


def ordered_version(c: Column) -> Column:
    """A version ``YYYYMMDD`` that is a real date; otherwise null."""
    ok = c.rlike(r"\A[0-9]{8}\z")
    return F.when(ok & F.try_to_date(F.when(ok, c), "yyyyMMdd").isNotNull(), c)


def retry_delay(attempts: Column) -> Column:
    """Seconds until the next attempt: powers of two up to 300."""
    return F.least(F.lit(300).cast("long"), F.pow(F.lit(2.0), F.least(attempts, F.lit(8))).cast("long"))


def nullif_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))
