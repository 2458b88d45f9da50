"""Versioned Parquet tables: every write is a new version folder.

``<root>/version=N`` holds version N whole. A version is complete once Spark
has committed it (``_SUCCESS``); readers only see complete versions, so a
failed write is never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _numbers(spark: SparkSession, pattern: str) -> list[int]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    folders = [f.getPath() for f in found]
    folders = [f.getParent() if f.getName() == "_SUCCESS" else f for f in folders]
    return sorted(int(f.getName().split("=")[1]) for f in folders)


def versions(spark: SparkSession, root: str, name: str = "version") -> list[int]:
    """Numbers of the complete folders ``<root>/<name>=N``."""
    return _numbers(spark, f"{root}/{name}=*/_SUCCESS")


def next_version(spark: SparkSession, root: str, name: str = "version") -> int:
    """A number no folder uses yet, complete or not."""
    used = _numbers(spark, f"{root}/{name}=*")
    return used[-1] + 1 if used else 0


def write_version(df: DataFrame, root: str) -> int:
    """Replace the table: write ``df`` as the next version. Any schema is accepted."""
    version = next_version(df.sparkSession, root)
    df.write.parquet(f"{root}/version={version}")
    return version


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A version of a table, the newest by default."""
    if version is None:
        known = versions(spark, root)
        if not known:
            raise FileNotFoundError(f"no complete version below {root}")
        version = known[-1]
    return spark.read.parquet(f"{root}/version={version}")


def restore_version(spark: SparkSession, root: str, version: int) -> int:
    """Make an old version the newest one."""
    return write_version(read_version(spark, root, version), root)


def clone(spark: SparkSession, root: str, target: str, version: int | None = None) -> int:
    """Copy the data of a version to another table."""
    return write_version(read_version(spark, root, version), target)


def append(df: DataFrame, path: str) -> None:
    """Add rows; new columns are allowed and merged on reading."""
    df.write.mode("append").parquet(path)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def _checked(df: DataFrame, field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`").cast(field.dataType)
    if field.nullable:
        return value.alias(field.name)
    failure = F.raise_error(F.lit(f"NOT NULL constraint violated: {field.name}")).cast(field.dataType)
    return F.when(value.isNull(), failure).otherwise(value).alias(field.name)


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns, order, types and NOT NULL of a declared table.

    The job fails on a missing value in a NOT NULL column; no row is dropped.
    """
    return df.select(*[_checked(df, f) for f in schema.fields])
