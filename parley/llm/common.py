"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow batch. Texts can be long; a batch must stay small beside an executor's memory.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept_aside(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, and all columns as one struct ``_row``, out of the way of added names."""
    return docs.select(*names, F.struct(*[docs[c] for c in docs.columns]).alias("_row"))


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows that Python workers hold at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def sized_batches(spark: SparkSession) -> None:
    """Bound the bytes that Python workers get at once: many short rows or a few long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which follows the input's size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
