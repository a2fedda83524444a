"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder;
    a cluster without it is refused, since executors share no local disk.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="checkpoints-")
    sc.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from that copy."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def as_bytes(column: str) -> F.Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches, a column at a time converted to Python values."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
        yield from zip(*columns, strict=True)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, to bound what is decoded at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
