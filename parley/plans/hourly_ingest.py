"""Incremental hourly batch ingest of JSON lines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parley.functions.text import json_to_map, line_key, partition_key
from parley.functions.times import ZONE, hourly_suffixes
from parley.operators.audit import file_audit, high_watermark
from parley.schemas import FILE_AUDIT
from parley.sources import tables
from parley.sources.jsonlines import existing_paths, read_lines
from parley.staging import stage
from parley.streaming.ingest import read_current

KEYS = ["line_md5", "partition_key"]


def parse_lines(lines: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Distinct lines as columns: key, folder, declared fields, nested maps, and all other fields in the map ``rest``.

    One row per line text and hour folder, also when several files of the
    folder repeat the line. Lines that are not a JSON object have a missing
    ``parsed`` map; see :func:`split_rejects`.
    """
    parsed = lines.select(
        line_key("value").alias("line_md5"),
        partition_key(F.col("_metadata.file_path")).alias("partition_key"),
        "value",
    ).dropDuplicates(KEYS)
    parsed = parsed.withColumn("parsed", json_to_map("value"))
    nested = [f for f in fields if f in ("Properties", "Measurements")]
    return parsed.select(
        *KEYS, "value", "parsed",
        *[
            json_to_map(F.col("parsed")[f]).alias(f) if f in nested else F.col("parsed")[f].alias(f)
            for f in fields
        ],
        F.map_filter("parsed", lambda k, _: ~k.isin(*fields)).alias("rest"),
    )


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to store and rejected lines (text, key, folder)."""
    good = parsed.where(F.col("parsed").isNotNull()).drop("value", "parsed")
    bad = parsed.where(F.col("parsed").isNull()).select(*KEYS, "value")
    return good, bad


def next_window(
    spark: SparkSession, audit_path: str, now: dt.datetime | None = None, zone: str = ZONE
) -> tuple[dt.datetime, dt.datetime]:
    """Hours still to read: from the last logged hour (two hours ago if none) to the last full hour."""
    now = now or dt.datetime.now(ZoneInfo(zone))
    last = None
    if existing_paths(spark, [audit_path]):
        last = high_watermark(tables.read_appended(spark, audit_path)).head()[0]
    start = (
        dt.datetime.strptime(last, "%Y-%m-%d:%H").replace(tzinfo=now.tzinfo) if last else now - dt.timedelta(hours=2)
    )
    whole = {"minute": 0, "second": 0, "microsecond": 0}
    return start.replace(**whole), (now - dt.timedelta(hours=1)).replace(**whole)


def run_hourly_ingest(
    spark: SparkSession,
    source: str,
    table: str,
    audit_path: str,
    rejects_path: str,
    fields: Sequence[str],
    start: dt.datetime,
    end: dt.datetime,
) -> int | None:
    """Read the hours after ``start`` up to ``end`` and upsert them; returns the version.

    The cost grows with these hours, not with the table: the load becomes a
    change folder, and :func:`read_bronze` resolves lines stored before. The
    text is read once, into a staged table of distinct parsed lines and of files.

    Stored rows, rejects and audit all go to ``batch_id=N``, the audit last; N
    follows the last complete audit. A run repeated after a failure uses the
    same N and replaces what the failed one left. Without any folder for these
    hours nothing is written.
    """
    suffixes = [r[0] for r in hourly_suffixes(spark, start, end).collect()]
    folders = existing_paths(spark, [f"{source}/{s}" for s in suffixes])
    if not folders:
        return None

    done = tables.versions(spark, audit_path, "batch_id")
    version = done[-1] + 1 if done else 0
    # The struct of the file travels with the text; a second read of it costs columns, not text.
    lines = stage(read_lines(spark, folders).select("value", F.col("_metadata").alias("file")), "hourly-lines")
    lines = lines.select("value", F.col("file").alias("_metadata"))
    parsed = stage(parse_lines(lines, fields), "hourly-parsed")
    good, bad = split_rejects(parsed)

    stored = Observation("rows_stored")
    good.observe(stored, F.count(F.lit(1)).alias("count")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("partition_key").parquet(f"{table}/changes/batch_id={version}")
    bad.write.mode("overwrite").parquet(f"{rejects_path}/batch_id={version}")

    metrics = {"numOutputRows": stored.get["count"]}
    if version:
        known = _stored_before(spark, table, parsed, version)
        metrics |= {"numTargetRowsInserted": stored.get["count"] - known, "numTargetRowsUpdated": known}
    audit = file_audit(lines, lines.count(), version, "MERGE" if version else "CREATE", metrics)
    tables.enforce_schema(audit, FILE_AUDIT).write.mode("overwrite").parquet(f"{audit_path}/batch_id={version}")
    return version


def _stored_before(spark: SparkSession, table: str, parsed: DataFrame, version: int) -> int:
    """How many keys of a load earlier loads have stored; only their folders of the load's hours are read."""
    earlier = [n for n in tables.versions(spark, f"{table}/changes", "batch_id") if n < version]
    hours = [r[0] for r in parsed.where("parsed IS NOT NULL").select("partition_key").distinct().collect()]
    if not earlier or not hours:
        return 0
    held = spark.read.schema("line_md5 string, partition_key string").option("basePath", f"{table}/changes").parquet(
        *[f"{table}/changes/batch_id={n}" for n in earlier])
    held = held.where(F.col("partition_key").isin(hours))
    return parsed.where("parsed IS NOT NULL").select(*KEYS).join(held, KEYS, "left_semi").count()


def read_bronze(spark: SparkSession, table: str, upto: int | None = None) -> DataFrame:
    """The ingested rows: of a line stored by several loads, the last one."""
    return read_current(spark, table, KEYS, ["batch_id"], upto=upto)
