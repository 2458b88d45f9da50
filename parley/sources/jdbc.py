"""Relational sources and sinks behind Spark's own JDBC connector."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Rows of a query; with a partition column it is read in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=f"({query}) wrapped", **properties)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    """Append rows to a table; each task writes its own partition in batches."""
    df.write.format("jdbc").mode("append").options(url=url, dbtable=table, **properties).save()
