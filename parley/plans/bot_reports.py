"""Daily bot reports: new dialogs, their KPIs, scored utterances."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.times import date_window, in_date_range
from parley.operators import dialogs as d
from parley.operators.utterances import score_utterances
from parley.schemas import DAILY_KPI, DIALOG, SCORED_UTTERANCE, STORED_EVENT
from parley.sources import tables
from parley.sources.group_store import GroupStore
from parley.sources.jsonlines import existing_paths
from parley.staging import stage

DIALOG_KEYS = ("event_date", "conversation_id", "dialog")
UTTERANCE_KEYS = ("event_date", "conversation_id", "activity_id")
#: The day and conversation whose events gave an utterance, which its own ids need not name.
UTTERANCE_GROUP = {"event_date": "event_date", "event_conversation_id": "conversation_id"}
STORED_UTTERANCE = T.StructType([*SCORED_UTTERANCE.fields, T.StructField("event_date", T.DateType())])


def events_of(
    bot_events: DataFrame, mode: str = "", start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Events in scope of yesterday, or of the days start..end-1."""
    return d.in_scope(in_date_range(bot_events, "event_date", *date_window(mode, start, end)))


def conversation_events(bot_events: DataFrame, conversation_id: str) -> DataFrame:
    """Events of one conversation, by its own or its master id."""
    return bot_events.where(
        (F.col("props_conversation_id") == conversation_id)
        | (F.col("props_master_conversation_id") == conversation_id)
    )


def _stored_days(spark: SparkSession, events: DataFrame, path: str, schema: T.StructType) -> DataFrame | None:
    """Stored rows of the days of ``events``, None if nothing is stored; other days' folders are not read."""
    if not existing_paths(spark, [path]):
        return None
    first, last = events.agg(F.min("event_date"), F.max("event_date")).first()
    stored = spark.read.schema(schema).parquet(path)
    return stored.where(F.col("event_date").between(F.lit(first), F.lit(last)))


def save_dialogs(spark: SparkSession, events: DataFrame, path: str) -> DataFrame:
    """Append the dialogs the table does not hold yet; returns them.

    Only the stored days that the events touch are read.
    """
    known = _stored_days(spark, events, path, DIALOG)
    found = d.segment_dialogs(events, known, known_keys=DIALOG_KEYS)
    found = stage(tables.enforce_schema(found, DIALOG), "dialogs-new")
    found.write.mode("append").partitionBy("event_date").parquet(path)
    return found


def dialog_summary(spark: SparkSession, path: str, first: dt.date, last: dt.date) -> DataFrame:
    """KPIs per day for dialogs saved before; reads only the partitions of these days."""
    stored = spark.read.schema(DIALOG).parquet(path)
    return tables.enforce_schema(d.daily_kpis(in_date_range(stored, "event_date", first, last)), DAILY_KPI)


def save_utterances(spark: SparkSession, events: DataFrame, path: str) -> DataFrame:
    """Score the utterances and append those whose conversation and activity are not stored; returns them.

    The table is partitioned by day; only the stored days that the events touch are read.
    """
    known = _stored_days(spark, events, path, STORED_UTTERANCE)
    scored = tables.enforce_schema(score_utterances(events), SCORED_UTTERANCE).withColumn("event_date", F.to_date("time"))
    if known is not None:
        held = known.select(*[F.col(k).alias(f"__{k}") for k in UTTERANCE_KEYS]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in UTTERANCE_KEYS]
        scored = scored.join(held, same, "left_anti")
    found = stage(scored, "utterances-new")
    found.write.mode("append").partitionBy("event_date").parquet(path)
    return found


def dialog_store(spark: SparkSession, root: str, event: T.StructType = STORED_EVENT) -> GroupStore:
    """Events and dialogs by conversation and day; see :func:`deliver_dialogs`."""
    return GroupStore(spark, root, d.KEYS, event, DIALOG, ["event_id"], ["time"])


def deliver_dialogs(store: GroupStore, events: DataFrame, number: int | None = None) -> int:
    """Take a delivery of events, late ones too, and segment the conversation-days it touches anew.

    Dialogs that a late event ends, splits, flags or joins are replaced; all others stay as they are.
    """
    return store.deliver(d.in_scope(events), d.segment_dialogs, number)


def utterance_store(spark: SparkSession, root: str, event: T.StructType = STORED_EVENT) -> GroupStore:
    """Events and scored utterances by conversation and day; see :func:`deliver_utterances`."""
    # Both sides name the group alike; the utterance's own conversation id is a column of the result.
    source = T.StructType([event["event_date"], T.StructField("event_conversation_id", T.StringType()), *[
        f for f in event.fields if f.name not in ("event_date", "conversation_id")]])
    result = T.StructType([*SCORED_UTTERANCE.fields, source["event_date"], source["event_conversation_id"]])
    return GroupStore(spark, root, list(UTTERANCE_GROUP), source, result, ["event_id"], ["time"])


def deliver_utterances(store: GroupStore, events: DataFrame, number: int | None = None) -> int:
    """Take a delivery of events and score the utterances of the conversation-days it touches anew."""

    def score(rows: DataFrame) -> DataFrame:
        return score_utterances(rows.withColumnRenamed("event_conversation_id", "conversation_id"), keep=UTTERANCE_GROUP)

    return store.deliver(d.in_scope(events).withColumnRenamed("conversation_id", "event_conversation_id"), score, number)
