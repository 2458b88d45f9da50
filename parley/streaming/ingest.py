"""Streaming upsert into a change table, file audit, compaction.

A stream does not rewrite the table per micro-batch. Batch N writes its newest
row per key to ``changes/batch_id=N``, replacing that folder, so a replayed
batch leaves the same state. Readers combine the base with the changes; a
compaction job folds changes into a new base now and then. The table, its
audit and its checkpoint share one root folder, so batch numbers stay unique.

Time travel is ``upto=N``; ``change_feed`` gives what changed between two
batches, from the keys these batches brought.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from parley.operators.audit import batch_file_audit
from parley.operators.latest import any_key_null, comparable, newest_per_key, row_digest
from parley.operators.upsert import cluster_by
from parley.sources.jsonlines import CORRUPT
from parley.sources.tables import versions


def apply_batch(
    batch: DataFrame, batch_id: int, root: str, keys: Sequence[str], sequence: Sequence[str], null_keys: str = "append"
) -> None:
    """Write one micro-batch: newest rows, its figures, then the files they came from."""
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        newest = newest_per_key(batch, keys, sequence, null_keys)
        newest.write.mode("overwrite").parquet(f"{root}/changes/batch_id={batch_id}")
        malformed = F.count(CORRUPT) if CORRUPT in batch.columns else F.lit(0).cast("bigint")
        figures = batch.agg(F.count(F.lit(1)).alias("cnt"), malformed.alias("malformed"))
        figures.write.mode("overwrite").parquet(f"{root}/figures/batch_id={batch_id}")
        if "_metadata" in batch.columns:
            batch_file_audit(batch, batch_id).write.mode("overwrite").parquet(f"{root}/audit/batch_id={batch_id}")
    finally:
        batch.unpersist()


def observed(stream: DataFrame, name: str = "metric") -> DataFrame:
    """Count rows and rejected rows; the figures arrive with every progress event."""
    figures = [F.count(F.lit(1)).alias("cnt")]
    if CORRUPT in stream.columns:
        figures.append(F.count(CORRUPT).alias("malformed"))
    return stream.observe(name, *figures)


def read_figures(spark: SparkSession, root: str) -> DataFrame:
    """Rows and rejected rows of every batch, however many there were.

    The progress reports that a query keeps are the last hundred only; these are stored.
    """
    return spark.read.option("basePath", f"{root}/figures").parquet(f"{root}/figures")


def start_upsert(
    stream: DataFrame,
    root: str,
    keys: Sequence[str],
    sequence: Sequence[str],
    query_name: str | None = None,
    processing_time: str | None = None,
    null_keys: str = "append",
) -> StreamingQuery:
    """Run the stream into the change table: all that is there now, or on a timer."""
    writer = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", f"{root}/checkpoint")
        .foreachBatch(lambda df, batch_id: apply_batch(df, batch_id, root, keys, sequence, null_keys))
    )
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()


def read_changes(
    spark: SparkSession, root: str, after: int = -1, upto: int | None = None, schema: StructType | None = None
) -> DataFrame:
    """Change rows with their ``batch_id``.

    Only complete folders inside the range are listed and read, so folders
    that a base has taken in cost nothing. Without ``schema`` the schemas of
    these folders' files are merged; give it when they are many.
    """
    wanted = [n for n in versions(spark, f"{root}/changes", "batch_id") if n > after and (upto is None or n <= upto)]
    if not wanted:
        raise FileNotFoundError(f"no complete change folder below {root} in the range")
    reader = spark.read.option("basePath", f"{root}/changes")
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    return reader.parquet(*[f"{root}/changes/batch_id={n}" for n in wanted])


def read_current(
    spark: SparkSession,
    root: str,
    keys: Sequence[str],
    sequence: Sequence[str],
    guard: bool = True,
    upto: int | None = None,
    null_keys: str = "append",
    schema: StructType | None = None,
) -> DataFrame:
    """The table as of batch ``upto`` (default: now).

    ``guard``: the greatest sequence wins even if it arrived earlier; without
    it the last batch wins.
    """
    folded = [v for v in versions(spark, f"{root}/base") if upto is None or v <= upto]
    if folded:
        base = spark.read.parquet(f"{root}/base/version={folded[-1]}")
        later = [n for n in versions(spark, f"{root}/changes", "batch_id") if n > folded[-1] and (upto is None or n <= upto)]
        if not later:
            return base  # one row per key already
        rows = base.unionByName(read_changes(spark, root, folded[-1], upto, schema), allowMissingColumns=True)
    else:
        rows = read_changes(spark, root, upto=upto, schema=schema)
    order = [*sequence, "batch_id"] if guard else ["batch_id", *sequence]
    return newest_per_key(rows, keys, order, null_keys)


def _stored_rows(spark: SparkSession, root: str, upto: int, schema: StructType | None) -> DataFrame:
    """Base and change rows up to a batch, with ``batch_id``; a base's rows without one have its number."""
    folded = [v for v in versions(spark, f"{root}/base") if v <= upto]
    if not folded:
        return read_changes(spark, root, upto=upto, schema=schema)
    base = spark.read.parquet(f"{root}/base/version={folded[-1]}")
    if "batch_id" not in base.columns:
        base = base.withColumn("batch_id", F.lit(folded[-1]))
    if not any(folded[-1] < n <= upto for n in versions(spark, f"{root}/changes", "batch_id")):
        return base
    return base.unionByName(read_changes(spark, root, folded[-1], upto, schema), allowMissingColumns=True)


def change_feed(
    spark: SparkSession,
    root: str,
    keys: Sequence[str],
    sequence: Sequence[str],
    after: int,
    upto: int,
    guard: bool = True,
    schema: StructType | None = None,
) -> DataFrame:
    """What the batches after one up to another changed, as ``table_diff`` names it.

    Only keys of these batches can have changed, so rows before them are
    filtered by these keys first, without two snapshots: one aggregate takes each key's newest row before
    (batches up to ``after``) and now. Rows without a key are always inserted. A base newer than
    ``after`` no longer tells what was before.
    """
    if any(after < v <= upto for v in versions(spark, f"{root}/base")):
        raise ValueError(f"a base folded batch {after} and later ones")
    changed = read_changes(spark, root, after, upto, schema)
    touched = changed.where(~any_key_null(keys)).select(*keys).distinct()
    names = [c for c in changed.columns if c != "batch_id"]
    rows = changed.where(~any_key_null(keys)).select(*changed.columns, F.lit(False).alias("__before"))
    if after >= 0 and (versions(spark, f"{root}/base") or any(n <= after for n in versions(spark, f"{root}/changes", "batch_id"))):
        before = _stored_rows(spark, root, after, schema).join(touched, list(keys), "left_semi").withColumn("__before", F.lit(True))
        rows = rows.unionByName(before, allowMissingColumns=True)
    order = [*sequence, "batch_id"] if guard else ["batch_id", *sequence]
    place = F.struct(*order, row_digest(changed, keys))
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    image = F.struct(*[c for c in rows.columns if c not in ("__before", *keys)])
    both = rows.groupBy(*keys).agg(
        F.max_by(image, F.when(F.col("__before"), place)).alias("old"), F.max_by(image, place).alias("new"))

    def seen(side: str):
        return F.struct(*[comparable(F.col(side)[c], kinds[c]) for c in names if c not in keys])

    def change(kind: str, side: str):
        return F.struct(F.lit(kind).alias("_change_type"), F.col(side).alias("row"))

    changes = F.when(F.col("old").isNull(), F.array(change("insert", "new"))).when(
        ~seen("old").eqNullSafe(seen("new")), F.array(change("update_preimage", "old"), change("update_postimage", "new")))
    out = both.select(*keys, F.explode(changes).alias("c")).select(*keys, "c.row.*", "c._change_type")
    loose = changed.where(any_key_null(keys)).withColumn("_change_type", F.lit("insert"))
    return out.unionByName(loose, allowMissingColumns=True).select(*names, "batch_id", "_change_type")


def compact(
    spark: SparkSession,
    root: str,
    keys: Sequence[str],
    sequence: Sequence[str],
    upto: int,
    cluster_column: str | None = None,
    partitions: int | None = None,
    guard: bool = True,
    null_keys: str = "append",
) -> None:
    """Fold the changes up to a batch into a new base, clustered for file skipping."""
    current = read_current(spark, root, keys, sequence, guard, upto, null_keys)
    if cluster_column:
        current = cluster_by(current, cluster_column, partitions)
    current.write.parquet(f"{root}/base/version={upto}")


def history(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch: rows written and files read."""
    written = read_changes(spark, root).groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows_written"))
    files = (
        spark.read.option("basePath", f"{root}/audit").parquet(f"{root}/audit")
        .groupBy("batch_id")
        .agg(F.count(F.lit(1)).alias("files_read"), F.max("file_commit_time").alias("committed"))
    )
    return written.join(files, "batch_id", "left")


def start_file_audit(spark: SparkSession, bronze: str, target: str, processing_time: str | None = None) -> StreamingQuery:
    """A stream over a stored stream: names of the files each row came from.

    ``bronze`` holds Parquet rows with the ``_metadata`` struct of their source
    file stored as ``row_created_metadata``.
    """
    schema = spark.read.parquet(bronze).schema
    rows = spark.readStream.schema(schema).parquet(bronze).select(
        F.col("row_created_metadata.file_path").alias("file_path"),
        F.col("row_created_metadata.file_name").alias("file_name"),
        F.col("row_created_metadata.file_modification_time").alias("file_creation_time"),
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.distinct().withColumn("file_commit_time", F.current_timestamp()).write.mode("overwrite").parquet(
            f"{target}/files/batch_id={batch_id}"
        )

    writer = rows.writeStream.option("checkpointLocation", f"{target}/checkpoint").foreachBatch(write)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()


def read_file_audit(spark: SparkSession, target: str) -> DataFrame:
    """One row per file, with its first commit: a file whose rows reached several batches is listed by each."""
    listed = spark.read.option("basePath", f"{target}/files").parquet(f"{target}/files")
    return listed.groupBy("file_path", "file_name").agg(
        F.min("file_creation_time").alias("file_creation_time"), F.min("file_commit_time").alias("file_commit_time")
    )


def start_append(
    stream: DataFrame, target: str, checkpoint: str, query_name: str | None = None, processing_time: str | None = None
) -> StreamingQuery:
    """Store a stream unchanged as Parquet, exactly once: all that is there now, or on a timer."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()
