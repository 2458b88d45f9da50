"""A partitioned table whose partitions are replaced one by one.

``data/version=N/<column>=V`` holds partition V as write N left it, and
``commits/version=N`` the values it replaced, written last. A partition is its newest
committed version; one that a write replaced by nothing is empty. Readers open the folders of the wanted
values only, writers those they replace.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.sources.tables import versions


class PartitionVersions:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, column: str):
        self.spark, self.root, self.schema, self.column = spark, root, schema, column

    def owners(self, upto: int | None = None) -> dict[object, int]:
        """The newest version of every value that a write has named; one entry per partition reaches the driver."""
        done = [v for v in versions(self.spark, f"{self.root}/commits") if upto is None or v <= upto]
        if not done:
            return {}
        schema = T.StructType([self.schema[self.column], T.StructField("version", T.LongType())])
        listed = self.spark.read.schema(schema).option("basePath", f"{self.root}/commits")
        rows = listed.parquet(*[f"{self.root}/commits/version={v}" for v in done])
        return {r[0]: r[1] for r in rows.groupBy(self.column).agg(F.max("version")).collect()}

    def read(self, values: Iterable[object] | None = None, upto: int | None = None) -> DataFrame:
        """The partitions of ``values`` (default: all) as of a version (default: now)."""
        wanted = None if values is None else set(values)
        by_version: dict[int, list[object]] = {}
        for value, version in self.owners(upto).items():
            if wanted is None or value in wanted:
                by_version.setdefault(version, []).append(value)
        if not by_version:
            return self.spark.createDataFrame([], self.schema)
        full = T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])
        rows = self.spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(
            *[f"{self.root}/data/version={v}" for v in sorted(by_version)])
        newest = F.lit(False)
        for version, found in by_version.items():
            newest = newest | ((F.col("version") == version) & F.col(self.column).isin(found))
        return rows.where(newest).select(*self.schema.names)

    def replace(self, rows: DataFrame, values: DataFrame, version: int) -> None:
        """Replace the partitions that ``values`` lists by ``rows``, as a version.

        A version written again replaces its first writing, as long as no later one was committed.
        """
        if any(v > version for v in versions(self.spark, f"{self.root}/commits")):
            raise ValueError(f"a version after {version} is committed")
        rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy(self.column).parquet(f"{self.root}/data/version={version}")
        values.select(self.column).distinct().coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commits/version={version}")
