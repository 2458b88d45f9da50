"""Bot events derived from the plain ``events`` table, for the catalogue's queries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from parley.operators.ordered import minute_slice, position

#: Column expressions over the numbered events; the same text runs on any SQL engine.
DERIVED_COLUMNS = """
  event_id, ts AS time, event_date, name,
  concat('c', CAST(cv AS STRING), CASE WHEN cv % 10 = 9 THEN '-us' ELSE '-in' END) AS conversation_id,
  CASE WHEN s % 4 <> 0 THEN concat('c', CAST(cv AS STRING), CASE WHEN cv % 10 = 9 THEN '-us' ELSE '-in' END) END AS props_master_conversation_id,
  concat(CASE WHEN s % 4 <> 0 THEN 'k' ELSE '' END, 'c', CAST(cv AS STRING), CASE WHEN cv % 10 = 9 THEN '-us' ELSE '-in' END) AS props_conversation_id,
  concat('a', CAST(cv AS STRING), '|', CAST(act AS STRING)) AS activity_id,
  CASE WHEN name <> 'BotMessageReceived' THEN concat('i', CAST(inst AS STRING)) END AS instance_id,
  CASE WHEN name = 'BotMessageReceived' AND b < 9 THEN CASE b WHEN 0 THEN 'Yes' WHEN 1 THEN 'cancel' WHEN 2 THEN 'Croma'
       WHEN 3 THEN 'customer care' WHEN 4 THEN 'yes, please.' ELSE concat('text ', CAST(s AS STRING)) END
       WHEN name = 'BotMessageSend' AND b < 5 THEN concat('You', chr(39), 're now connected to a customer care executive.')
       WHEN name = 'BotMessageSend' THEN 'Your conversation with the customer care executive has ended.' END AS text,
  CASE WHEN name = 'LuisResult' THEN CASE WHEN b = 0 THEN 'Cancel' WHEN b < 4 THEN 'IdentifyBrand' WHEN b < 6 THEN 'Help' ELSE 'TrackOrder' END END AS intent,
  CASE WHEN name = 'LuisResult' THEN CAST(s AS DOUBLE) / CAST(1000 AS DOUBLE) END AS intent_score,
  CASE WHEN name = 'QnAResult' THEN CAST(s AS DOUBLE) / CAST(1000 AS DOUBLE) END AS top_answer_score,
  CASE WHEN name = 'BotMessageReceived' OR b < 4 THEN 'TDL.Chatbot.Master' WHEN b < 7 THEN 'TCP.Chatbot.Shop' ELSE 'TDL.Chatbot.Skill' END AS app_role_name,
  CASE WHEN name = 'WaterfallStep' THEN CASE WHEN b < 6 THEN 'InitialStepAsync' WHEN b = 6 THEN 'EstablishChatStepAsync' WHEN b < 9 THEN 'FinalStepAsync' ELSE 'OtherStep' END END AS step_name,
  CASE WHEN name = 'WaterfallStep' THEN CASE WHEN b < 6 THEN 'MainDialog.WaterfallDialog' WHEN b = 6 THEN 'WaterfallDialog' ELSE 'DisambiguateUserUtteranceDialog.WaterfallDialog' END END AS dialog_id
"""

#: Kind of event, from the position in the conversation and a pseudo-random part.
DERIVED_NAME = """
  CASE WHEN p % 4 = 0 AND r < 92 THEN 'BotMessageReceived' WHEN r < 30 THEN 'LuisResult' WHEN r < 45 THEN 'QnAResult'
       WHEN r < 52 THEN 'FailedUtterance' WHEN r < 60 THEN 'WaterfallComplete'
       WHEN r < 85 THEN 'WaterfallStep' ELSE 'BotMessageSend' END AS name
"""

DERIVED_PARTS = """
  event_id, ts, user_id, CAST(ts AS DATE) AS event_date, user_id % 20 AS cv,
  (event_id * 7919 + user_id * 31) % 100 AS r,
  (event_id * 104729 + user_id * 17) % 1000 AS s,
  (event_id * 613 + user_id * 7) % 10 AS b
"""


def bot_events_sql(table: str = "events") -> str:
    """The derivation as one SQL text, for engines that check the results."""
    return f"""
WITH e AS (SELECT {DERIVED_PARTS},
  CAST(row_number() OVER (PARTITION BY user_id % 20, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS BIGINT) AS p
  FROM {table}),
n AS (SELECT e.*, CAST(floor(p / 4.0) AS BIGINT) AS act, CAST(floor(p / 6.0) AS BIGINT) AS inst, {DERIVED_NAME} FROM e)
SELECT {DERIVED_COLUMNS} FROM n
"""


def derived_bot_events(events: DataFrame) -> DataFrame:
    """Deterministic bot telemetry over ``events(event_id, ts, user_id)``."""
    spark = events.sparkSession
    parts = spark.sql(f"SELECT {DERIVED_PARTS} FROM {{events}}", events=events)
    placed = position(parts, ["cv", "event_date"], ["ts", "event_id"], minute_slice(parts, "ts"), "p")
    named = placed.selectExpr(
        "*", "CAST(floor(p / 4.0) AS BIGINT) AS act", "CAST(floor(p / 6.0) AS BIGINT) AS inst", DERIVED_NAME
    )
    return spark.sql(f"SELECT {DERIVED_COLUMNS} FROM {{named}}", named=named)
