"""Catalogue: streaming jobs and log reports over data derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parley.operators import logs
from parley.plans.catalog_tables import event_lines, events, with_extra
from parley.schemas import EVENT_HINTS, PROGRESS_LOG, RAW_EVENT
from parley.sources.jsonlines import CORRUPT, stored_schema, stream_events
from parley.staging import staging_path
from parley.streaming import ingest
from parley.streaming.listener import ObservedLog, ProgressLog, read_observed

KEYS, SEQUENCE = ["UserId", "Name"], ["time"]


def _landed(spark: SparkSession, sf_dir: str, files: int | None = None, broken: bool = False, extra: bool = False) -> str:
    """Event lines in several files, in time order across files; as many as there are partitions unless told."""
    path = staging_path(spark, "stream-landing")
    lines = with_extra(event_lines(spark, sf_dir)) if extra else event_lines(spark, sf_dir)
    if broken:
        lines = lines.withColumn("value", F.when(F.second("ts") < 20, F.substr("value", F.lit(1), F.lit(40))).otherwise(F.col("value")))
    ranged = lines.repartitionByRange(files, "ts") if files else lines.repartitionByRange("ts")
    ranged.select("value").write.text(path)
    return path


def _out(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("time"), F.col("Name").alias("name"), F.col("UserId").alias("user_id"),
        F.col("ItemCount").alias("item_count"), F.col("Properties")["k"].alias("k"),
    )


def stream_file_ingest(spark, sf_dir):
    source, target = _landed(spark, sf_dir), staging_path(spark, "bronze")
    ingest.start_append(stream_events(spark, source, RAW_EVENT), target, f"{target}-checkpoint").awaitTermination()
    return _out(spark.read.parquet(target))


def stream_upsert_latest(spark, sf_dir):
    """Four micro-batches into a change table, one compaction in between."""
    source, root = _landed(spark, sf_dir, 4), staging_path(spark, "silver")
    stream = stream_events(spark, source, RAW_EVENT, max_files_per_trigger=1)
    ingest.start_upsert(stream, root, KEYS, SEQUENCE).awaitTermination()
    ingest.compact(spark, root, KEYS, SEQUENCE, upto=1, cluster_column="time", partitions=4)
    return _out(ingest.read_current(spark, root, KEYS, SEQUENCE))


def stream_observe(spark, sf_dir):
    """Rows and rejected rows over all batches, as a listener stored what each batch observed."""
    source, root, folder = _landed(spark, sf_dir, 4, broken=True), staging_path(spark, "observed"), staging_path(spark, "observed-log")
    listener = ObservedLog(spark, folder)
    spark.streams.addListener(listener)
    try:
        stream = ingest.observed(stream_events(spark, source, RAW_EVENT, max_files_per_trigger=2))
        query = ingest.start_upsert(stream, root, KEYS, SEQUENCE)
        query.awaitTermination()
        listener.wait_for_end(query.runId)
    finally:
        spark.streams.removeListener(listener)
    stored = read_observed(spark, folder).where(F.col("name") == "metric")
    return stored.agg(*[F.sum(F.col("metrics")[c].cast("bigint")).alias(c) for c in ("cnt", "malformed")])


def stream_figures(spark, sf_dir):
    """The same from the figures that each batch stores beside its rows."""
    source, root = _landed(spark, sf_dir, 4, broken=True), staging_path(spark, "figures")
    ingest.start_upsert(stream_events(spark, source, RAW_EVENT, max_files_per_trigger=2), root, KEYS, SEQUENCE).awaitTermination()
    return ingest.read_figures(spark, root).agg(F.sum("cnt").alias("cnt"), F.sum("malformed").alias("malformed"))


def stream_file_audit(spark, sf_dir):
    """Files of a stored stream, from a second stream over it: one per day's folder."""
    source, bronze, target = (staging_path(spark, x) for x in ("stream-landing", "bronze", "files"))
    days = event_lines(spark, sf_dir).select("value", F.to_date("ts").alias("day"))
    days.repartition("day").write.partitionBy("day").text(source)
    ingest.start_append(stream_events(spark, source, RAW_EVENT), bronze, f"{bronze}-checkpoint").awaitTermination()
    ingest.start_file_audit(spark, bronze, target).awaitTermination()
    named = ingest.read_file_audit(spark, target).where("file_creation_time <= file_commit_time")
    return named.groupBy(F.regexp_extract("file_path", "day=([0-9-]+)", 1).alias("day")).agg(F.count(F.lit(1)).alias("files"))


def stream_history(spark, sf_dir):
    """Days by the batches and files that brought them: one file per day and batch."""
    source, root = staging_path(spark, "stream-landing"), staging_path(spark, "history")
    days = event_lines(spark, sf_dir).select("value", F.to_date("ts").alias("day"))
    days.repartition("day").write.partitionBy("day").text(source)
    stream = stream_events(spark, source, RAW_EVENT, max_files_per_trigger=8)
    ingest.start_upsert(stream, root, ["UserId", "Name", "time"], SEQUENCE).awaitTermination()
    told = ingest.history(spark, root)
    return told.agg(
        F.count(F.lit(1)).alias("batches"), F.sum("files_read").alias("files"), F.sum("rows_written").alias("rows_written"),
        F.max("files_read").alias("most_files"),
    )


def stream_schema_evolution(spark, sf_dir):
    """Two runs of one stream; the second finds a new field and has it as a column."""
    source, root, store = (staging_path(spark, x) for x in ("evolving", "evolved", "schemas"))
    lines = event_lines(spark, sf_dir)
    late = F.to_date("ts") >= "2024-01-16"
    for number, part in enumerate((lines.where(~late), with_extra(lines.where(late)))):
        part.select("value").write.text(f"{source}/part={number}")
        schema = stored_schema(spark, source, store, EVENT_HINTS)
        ingest.start_upsert(stream_events(spark, source, schema), root, ["ItemCount"], SEQUENCE).awaitTermination()
    rows = ingest.read_current(spark, root, ["ItemCount"], SEQUENCE)
    return rows.select(F.col("ItemCount").alias("item_count"), F.col("Name").alias("name"), F.col("Extra").alias("extra"), CORRUPT)


def stream_rescued_fields(spark, sf_dir):
    """A stream with a fixed schema keeps the fields outside it as JSON."""
    source, root = _landed(spark, sf_dir, extra=True), staging_path(spark, "rescued")
    ingest.start_append(stream_events(spark, source, RAW_EVENT), root, f"{root}-checkpoint").awaitTermination()
    return spark.read.parquet(root).select(F.col("ItemCount").alias("item_count"), F.col("UserId").alias("user_id"), CORRUPT)


def listener_log(spark, sf_dir):
    """Rows per status in the log that the listener keeps of one query."""
    source, root, folder = _landed(spark, sf_dir, 4), staging_path(spark, "listened"), staging_path(spark, "listener-log")
    listener = ProgressLog(spark, folder)
    spark.streams.addListener(listener)
    try:
        stream = stream_events(spark, source, RAW_EVENT, max_files_per_trigger=1)
        query = ingest.start_upsert(stream, root, KEYS, SEQUENCE, query_name="logged")
        query.awaitTermination()
        listener.wait_for_end(query.runId)
    finally:
        spark.streams.removeListener(listener)
    raw = spark.read.schema(PROGRESS_LOG).json(folder).select("*", "_metadata")
    parsed = logs.parse_progress(raw, F.col("_metadata.file_path")).where(F.col("run_id") == str(query.runId))
    return parsed.groupBy("status").agg(F.coalesce(F.sum("num_input_rows"), F.lit(0)).alias("input_rows"))


def observe_counts(spark, sf_dir):
    counts = Observation("counts")
    rows = events(spark, sf_dir).withColumn(CORRUPT, F.when(F.second("ts") < 20, F.col("props")))
    rows.observe(counts, F.count(F.lit(1)).alias("cnt"), F.count(CORRUPT).alias("malformed")).write.format("noop").mode(
        "overwrite"
    ).save()
    return spark.range(1).select(
        F.lit(counts.get["cnt"]).cast("bigint").alias("cnt"), F.lit(counts.get["malformed"]).cast("bigint").alias("malformed")
    )


# --- pipeline event log and progress log ----------------------------------

_FLOW = """concat('{"flow_definition":{"output_dataset":"ds', CAST(user_id AS STRING), '","input_datasets":["in_', event_type,
  '"],"flow_type":"COMPLETE","schema":{"rows":', CAST(event_id AS STRING), '}}}')"""
_QUALITY = """concat('{"flow_progress":{"metrics":{"num_output_rows":', CAST(event_id AS STRING),
  '},"data_quality":{"dropped_records":', CAST(user_id AS STRING), ',"expectations":[{"name":"', event_type, '","dataset":"ds',
  CAST(user_id AS STRING), '","passed_records":', CAST(event_id AS STRING), ',"failed_records":', CAST(user_id AS STRING),
  '},{"name":"all","dataset":"ds","passed_records":1,"failed_records":0}]}}}')"""


def event_log(spark, sf_dir):
    """A pipeline event log: flow definitions and progress events."""
    return events(spark, sf_dir).select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"),
        F.col("ts").alias("timestamp"),
        F.expr(f"CASE WHEN event_type IN ('signup', 'error') THEN {_FLOW} WHEN event_type <> 'view' THEN {_QUALITY} ELSE '{{}}' END").alias("details"),
    )


def event_log_flows(spark, sf_dir):
    return logs.flow_definitions(event_log(spark, sf_dir))


def expectation_report(spark, sf_dir):
    return logs.expectation_report(event_log(spark, sf_dir))


def progress_log_parse(spark, sf_dir):
    """Listener lines, one per event: started, updated or terminated."""
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
    ident = F.col("event_id").cast("string")
    status = (
        F.when(F.col("event_type") == "signup", "STREAM_STARTED")
        .when(F.col("event_type") == "error", "STREAM_TERMINATED")
        .otherwise("STREAM_UPDATED")
    )
    updated = status == "STREAM_UPDATED"
    report = F.concat(
        F.lit('{"id":"q'), ident, F.lit('","runId":"r'), ident, F.lit('","name":"demo","timestamp":"'), stamp,
        F.lit('","batchId":'), ident, F.lit(',"numInputRows":'), F.col("user_id").cast("string"),
        F.lit(',"inputRowsPerSecond":'), F.col("value").cast("string"),
        F.lit(',"processedRowsPerSecond":2.5,"durationMs":{"addBatch":'), F.col("user_id").cast("string"),
        F.lit(',"getBatch":7},"sources":[{"description":"files","metrics":{"numFilesOutstanding":"'), ident, F.lit('"}}]}'),
    )
    path = staging_path(spark, "progress-log")
    events(spark, sf_dir).select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("EVENT_TIME"),
        status.alias("STATUS"),
        F.when(~updated, F.concat(F.lit("q"), ident)).alias("STREAM_ID"),
        F.when(~updated, F.concat(F.lit("r"), ident)).alias("RUN_ID"),
        F.when(F.col("event_type") == "signup", "demo").alias("STREAM_NAME"),
        F.when(updated, report).alias("BATCH_INFO"),
        F.when(F.col("event_type") == "error", "boom").alias("TERMINATION_EXCEPTION"),
    ).write.json(path)
    logged = spark.read.schema(PROGRESS_LOG).json(path)
    parsed = logs.parse_progress(logged, F.col("_metadata.file_path"))
    return parsed.drop("source_file", "batch_info").withColumns(
        {"input_time": F.col("input_time").cast("timestamp_ntz"), "event_time": F.col("event_time").cast("timestamp_ntz")}
    )


# --- SQL side -------------------------------------------------------------

_RAW = """SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0Z' AS time, event_type AS name, concat('u', CAST(user_id AS VARCHAR)) AS user_id,
    CAST(event_id AS INTEGER) AS item_count, regexp_extract(props, '"k": ([0-9]+)', 1) AS k FROM events"""

ORACLES = {
    "stream_file_ingest": _RAW,
    "stream_upsert_latest": _RAW + " QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1",
    "stream_observe": "SELECT count(*) AS cnt, count(*) FILTER (WHERE second(ts) < 20) AS malformed FROM events",
    "stream_figures": "SELECT count(*) AS cnt, count(*) FILTER (WHERE second(ts) < 20) AS malformed FROM events",
    "stream_file_audit": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(1 AS BIGINT) AS files FROM events GROUP BY 1",
    "stream_history": """SELECT CAST(ceil(count(DISTINCT CAST(ts AS DATE)) / 8.0) AS BIGINT) AS batches, count(DISTINCT CAST(ts AS DATE)) AS files,
        count(DISTINCT (user_id, event_type, ts)) AS rows_written, least(8, count(DISTINCT CAST(ts AS DATE))) AS most_files FROM events""",
    "stream_schema_evolution": """SELECT event_id AS item_count, event_type AS name, CASE WHEN second(ts) < 20 AND CAST(ts AS DATE) >= DATE '2024-01-16'
        THEN concat('x', CAST(second(ts) AS VARCHAR)) END AS extra, CAST(NULL AS VARCHAR) AS _rescued_data FROM events""",
    "stream_rescued_fields": """SELECT CAST(event_id AS INTEGER) AS item_count, concat('u', CAST(user_id AS VARCHAR)) AS user_id,
        CASE WHEN second(ts) < 20 THEN concat('{"Extra":"x', CAST(second(ts) AS VARCHAR), '"}') END AS _rescued_data FROM events""",
    "listener_log": """SELECT unnest(['STREAM_STARTED', 'STREAM_UPDATED', 'STREAM_TERMINATED']) AS status,
        unnest([CAST(0 AS BIGINT), count(*), CAST(0 AS BIGINT)]) AS input_rows FROM events""",
    "observe_counts": "SELECT count(*) AS cnt, count(*) FILTER (WHERE second(ts) < 20) AS malformed FROM events",
    "event_log_flows": """SELECT concat('ds', CAST(user_id AS VARCHAR)) AS output_dataset, concat('["in_', event_type, '"]') AS input_datasets,
        'COMPLETE' AS flow_type, concat('{"rows":', CAST(event_id AS VARCHAR), '}') AS schema,
        concat('{"output_dataset":"ds', CAST(user_id AS VARCHAR), '","input_datasets":["in_', event_type,
          '"],"flow_type":"COMPLETE","schema":{"rows":', CAST(event_id AS VARCHAR), '}}') AS flow_definition
        FROM events WHERE event_type IN ('signup', 'error') ORDER BY ts""",
    "expectation_report": """SELECT concat('e', CAST(event_id AS VARCHAR)) AS id, concat('ds', CAST(user_id AS VARCHAR)) AS dataset,
          event_type AS name, user_id AS failed_records, event_id AS passed_records FROM events WHERE event_type IN ('click', 'purchase')
        UNION ALL SELECT concat('e', CAST(event_id AS VARCHAR)), 'ds', 'all', 0, 1 FROM events WHERE event_type IN ('click', 'purchase')""",
    "progress_log_parse": """SELECT concat('q', CAST(event_id AS VARCHAR)) AS stream_id, concat('r', CAST(event_id AS VARCHAR)) AS run_id,
        CASE WHEN event_type <> 'error' THEN 'demo' END AS stream_name,
        CASE event_type WHEN 'signup' THEN 'STREAM_STARTED' WHEN 'error' THEN 'STREAM_TERMINATED' ELSE 'STREAM_UPDATED' END AS status,
        ts AS input_time, CASE WHEN event_type IN ('signup', 'error') THEN ts ELSE date_trunc('millisecond', ts) END AS event_time,
        CASE WHEN event_type NOT IN ('signup', 'error') THEN event_id END AS batch_id,
        CASE WHEN event_type NOT IN ('signup', 'error') THEN user_id END AS num_input_rows,
        CASE WHEN event_type NOT IN ('signup', 'error') THEN value END AS input_rows_per_second,
        CASE WHEN event_type NOT IN ('signup', 'error') THEN 2.5::DOUBLE END AS processed_rows_per_second,
        CASE WHEN event_type NOT IN ('signup', 'error') THEN CAST(event_id AS INTEGER) END AS outstanding_files,
        CAST(NULL AS BIGINT) AS trigger_execution_ms, CAST(NULL AS BIGINT) AS query_planning_ms,
        CASE WHEN event_type NOT IN ('signup', 'error') THEN CAST(7 AS BIGINT) END AS get_batch_ms,
        CAST(NULL AS BIGINT) AS commit_offsets_ms, CAST(NULL AS BIGINT) AS latest_offset_ms,
        CASE WHEN event_type NOT IN ('signup', 'error') THEN user_id END AS add_batch_ms, CAST(NULL AS BIGINT) AS wal_commit_ms,
        CASE WHEN event_type = 'error' THEN 'boom' END AS termination_exception FROM events""",
}

QUERIES = {name: globals()[name] for name in ORACLES}
