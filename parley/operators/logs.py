"""Reports over the pipeline event log and the streaming progress log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.text import OUTSTANDING_FILES, extract_int
from parley.schemas import EXPECTATIONS, PROGRESS_REPORT

# Phases of a micro-batch and the column each becomes.
PHASES = {
    "triggerExecution": "trigger_execution_ms",
    "queryPlanning": "query_planning_ms",
    "getBatch": "get_batch_ms",
    "commitOffsets": "commit_offsets_ms",
    "latestOffset": "latest_offset_ms",
    "addBatch": "add_batch_ms",
    "walCommit": "wal_commit_ms",
}


#: Parts of an event's ``details`` that the reports read; nested parts stay JSON text.
FLOW = "flow_definition STRING"
FLOW_PARTS = "output_dataset STRING, input_datasets STRING, flow_type STRING, schema STRING"
PROGRESS = f"flow_progress STRUCT<metrics: STRING, data_quality: STRUCT<expectations: {EXPECTATIONS}>>"


def flow_definitions(log: DataFrame) -> DataFrame:
    """Flows a pipeline declared, in time order.

    The details are parsed once, and of flows their definition once more.
    """
    flows = log.select("timestamp", F.from_json("details", FLOW)["flow_definition"].alias("flow_definition"))
    parts = flows.where(F.col("flow_definition").isNotNull()).withColumn("parts", F.from_json("flow_definition", FLOW_PARTS))
    return parts.orderBy("timestamp").select("parts.*", "flow_definition")


def expectation_report(log: DataFrame) -> DataFrame:
    """Passed and failed records per expectation of every progress event; the details are parsed once."""
    progress = log.select("id", F.from_json("details", PROGRESS)["flow_progress"].alias("progress"))
    return (
        progress.where(F.col("progress.metrics").isNotNull())
        .select("id", F.explode("progress.data_quality.expectations").alias("e"))
        .select("id", "e.dataset", "e.name", "e.failed_records", "e.passed_records")
    )


def details_schema(log: DataFrame) -> DataFrame:
    """``schema``: what the details of a log hold, as the DDL that :func:`pyspark.sql.functions.from_json` takes.

    One aggregate over details parsed once; types that conflict become text. Use it before declaring parts to read.
    """
    merged = F.schema_of_variant_agg(F.try_parse_json("details"))
    ddl = F.regexp_replace(F.regexp_replace(merged, "OBJECT", "STRUCT"), r"\b(VARIANT|VOID)\b", "STRING")
    return log.agg(ddl.alias("schema"))


def parse_progress(logs: DataFrame, source_file: Column | None = None) -> DataFrame:
    """Listener lines as typed rows: ids, rates, phases, backlog, status.

    Rows without a progress report (start, end) take the log time as event time.
    """
    report = F.from_json("BATCH_INFO", PROGRESS_REPORT)
    parsed = logs.withColumn("report", report)
    return parsed.select(
        F.coalesce("STREAM_ID", "report.id").alias("stream_id"),
        F.coalesce("RUN_ID", "report.runId").alias("run_id"),
        F.coalesce("STREAM_NAME", "report.name").alias("stream_name"),
        F.col("STATUS").alias("status"),
        F.col("EVENT_TIME").try_cast("timestamp").alias("input_time"),
        F.coalesce(
            F.col("report.timestamp").try_cast("timestamp"), F.col("EVENT_TIME").try_cast("timestamp")
        ).alias("event_time"),
        F.col("report.batchId").alias("batch_id"),
        F.col("report.numInputRows").alias("num_input_rows"),
        F.col("report.inputRowsPerSecond").alias("input_rows_per_second"),
        F.col("report.processedRowsPerSecond").alias("processed_rows_per_second"),
        extract_int(F.col("report.sources"), OUTSTANDING_FILES).alias("outstanding_files"),
        *[F.col("report.durationMs")[phase].alias(name) for phase, name in PHASES.items()],
        F.col("TERMINATION_EXCEPTION").alias("termination_exception"),
        (source_file if source_file is not None else F.lit(None).cast("string")).alias("source_file"),
        F.col("BATCH_INFO").alias("batch_info"),
    )
