"""Bot events from raw telemetry."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions.columns import select_paths
from parley.schemas import BOT_EVENT_COLUMNS


def bot_events_from_raw(raw: DataFrame, columns: Mapping[str, str] = BOT_EVENT_COLUMNS) -> DataFrame:
    """Bot events from raw telemetry with a ``Properties`` map.

    Times become timestamps, scores doubles; ``event_id`` is a digest of the
    event, the last key of every order.
    """
    picked = select_paths(raw, columns, keep=[F.xxhash64(F.to_json(F.struct(*raw.columns))).alias("event_id")])
    return picked.withColumns(
        {
            "time": F.try_to_timestamp("time"),
            "intent_score": F.col("intent_score").try_cast("double"),
            "top_answer_score": F.col("top_answer_score").try_cast("double"),
            "conversation_id": F.coalesce("props_master_conversation_id", "props_conversation_id"),
        }
    ).withColumn("event_date", F.to_date("time"))
