"""File audit and version history rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions.text import source_folder


def batch_file_audit(batch: DataFrame, batch_id: int) -> DataFrame:
    """Files a micro-batch was read from: name, change time, commit time, batch."""
    return (
        batch.select(
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_modification_time").alias("file_creation_time"),
        )
        .distinct()
        .withColumns({"file_commit_time": F.current_timestamp(), "ingest_id": F.lit(batch_id).cast("bigint")})
    )


def file_audit(
    lines: DataFrame,
    total_records: int,
    version: int | None = None,
    operation: str | None = None,
    metrics: Mapping[str, object] | None = None,
) -> DataFrame:
    """Files of a batch load with the load's size and the table write's figures.

    The write has one version, one operation and one set of figures, so they
    are literals, not a join.
    """
    entries = [x for k, v in (metrics or {}).items() for x in (F.lit(k), F.lit(str(v)))]
    figures = F.create_map(*entries) if entries else F.lit(None)
    return (
        lines.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_modification_time").alias("file_modification_time"),
        )
        .distinct()
        .withColumns(
            {
                "source_folder": source_folder(F.col("file_path")),
                "log_time": F.current_timestamp(),
                "total_records_read": F.lit(total_records).cast("bigint"),
                "version": F.lit(version).cast("bigint"),
                "operation": F.lit(operation).cast("string"),
                "operation_metrics": figures.cast("map<string,string>"),
            }
        )
    )


def latest_version(history: DataFrame) -> DataFrame:
    """The history row of the greatest version."""
    others = [c for c in history.columns if c != "version"]
    return (
        history.agg(F.max("version").alias("version"), F.max_by(F.struct(*others), "version").alias("__row"))
        .where(F.col("version").isNotNull())
        .select("version", *[F.col("__row")[c].alias(c) for c in others])
    )


def high_watermark(audit: DataFrame, column: str = "source_folder") -> DataFrame:
    """Greatest processed hour; missing for an empty audit."""
    return audit.agg(F.max(column).alias("high_watermark"))
