"""Loading tables, with their columns asserted instead of inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str, columns: str | None = None) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return require(df, columns) if columns else df


def require(df: DataFrame, columns: str) -> DataFrame:
    """Those columns of ``df``; a missing one, or one of another type, is an error."""
    wanted = T.StructType.fromDDL(columns)
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f"{f.name} {f.dataType.simpleString()}" for f in wanted if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"needs {', '.join(wrong)}; has {df.schema.simpleString()}")
    return df.select(*wanted.fieldNames())
