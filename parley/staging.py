"""Cut points: intermediate tables in the shared checkpoint folder.

A staged table is written once as Parquet and read back, so that several
branches of a plan read only the columns they need instead of recomputing
their common input, and a lost executor costs a re-read, not a recompute.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def staging_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may run without the setting; it then gets a folder of
    its own. A cluster session without it is refused, because a machine-local
    folder would not be visible to the executors.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="parley-staging-")
    return _local_root


def staging_path(spark: SparkSession, label: str) -> str:
    """A path under the staging folder that nothing has used before."""
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh staged table and return a reader of it."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
