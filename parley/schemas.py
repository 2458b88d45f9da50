"""Declared schemas of inputs and outputs."""

from pyspark.sql import types as T

_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
_TS, _DATE = T.TimestampType(), T.DateType()
_MAP = T.MapType(_S, _S)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


#: One raw telemetry event as it stands in a JSON line.
RAW_EVENT = _struct(
    ("time", _S), ("resourceId", _S), ("ResourceGUID", _S), ("Type", _S), ("IKey", _S),
    ("AppRoleInstance", _S), ("AppRoleName", _S), ("AppVersion", _S),
    ("ClientCity", _S), ("ClientCountryOrRegion", _S), ("ClientIP", _S),
    ("ClientStateOrProvince", _S), ("ClientType", _S), ("ClientBrowser", _S),
    ("_BilledSize", _I),
    ("OperationId", _S), ("OperationName", _S), ("ParentId", _S), ("SDKVersion", _S),
    ("SessionId", _S), ("UserId", _S),
    ("Properties", _MAP), ("Measurements", T.MapType(_S, _D)),
    ("Name", _S), ("ItemCount", _I),
)

#: Type hints laid over an inferred event schema.
EVENT_HINTS = "Properties MAP<STRING,STRING>, _BilledSize INT"

# Property names of the bot framework.
#: Bot events as the dialog and utterance operators read them: path -> column name.
BOT_EVENT_COLUMNS = {
    "time": "time",
    "Name": "name",
    "Properties.conversationId": "props_conversation_id",
    "Properties.MasterBotConversationId": "props_master_conversation_id",
    "Properties.text": "text",
    "Properties.activityId": "activity_id",
    "Properties.TopAnswer": "top_answer",
    "Properties.TopAnswerScore": "top_answer_score",
    "Properties.intent": "intent",
    "Properties.intentScore": "intent_score",
    "Properties.userUtterance": "user_utterance",
    "Properties.DialogId": "dialog_id",
    "Properties.StepName": "step_name",
    "Properties.InstanceId": "instance_id",
    "AppRoleName": "app_role_name",
}

#: Bot events as the dialog and utterance stores keep them.
STORED_EVENT = _struct(
    ("event_date", _DATE), ("event_id", _L), ("time", _TS), ("name", _S), ("conversation_id", _S),
    ("props_conversation_id", _S), ("props_master_conversation_id", _S), ("activity_id", _S), ("instance_id", _S),
    ("text", _S), ("intent", _S), ("intent_score", _S), ("top_answer_score", _S), ("app_role_name", _S),
    ("step_name", _S), ("dialog_id", _S),
)

DIALOG = _struct(
    ("event_date", _DATE), ("dialog", _S), ("conversation_id", _S), ("start_time", _TS), ("end_time", _TS),
    ("abandoned_left", _B), ("cancelled", _B), ("failed", _B), ("agent", _B),
)

SCORED_UTTERANCE = _struct(
    ("time", _TS), ("text", _S), ("activity_id", _S), ("intent", _S), ("intent_score", _D),
    ("app_role_name", _S), ("child_app_role_name", _S), ("props_conversation_id", _S),
    ("props_master_conversation_id", _S), ("conversation_id", _S), ("agent_connection", _B),
    ("master_score", _D), ("child_score", _D), ("final_score", _D),
)

DAILY_KPI = _struct(
    ("date", _DATE), ("total_conversations", _L), ("total_dialogs", _L), ("abandoned_dialogs", _L),
    ("failed_dialogs", _L), ("agent_dialogs", _L), ("open_agent_dialogs", _L),
    ("closed_agent_dialogs", _L), ("fcr_dialogs", _L), ("fcr_pct", _D), ("failed_pct", _D), ("fbr_pct", _D),
)

DAILY_USERS = _struct(("date", _DATE, False), ("total_users", _L))

CLIENT_TYPE_DISTRIBUTION = _struct(
    ("date", _DATE, False), ("client_type", _S), ("user_base", _L), ("total_users", _L), ("percent_users", _D),
)

USER_PREFERRED_CHANNEL = _struct(
    ("date", _DATE, False), ("user_id", _S), ("activity_type", _S), ("interactions", _D),
    ("communication_channel", T.ArrayType(_S)),
)

FILE_AUDIT = _struct(
    ("file_path", _S), ("file_name", _S), ("file_size", _L), ("file_modification_time", _TS),
    ("source_folder", _S), ("log_time", _TS), ("total_records_read", _L), ("version", _L),
    ("operation", _S), ("operation_metrics", _MAP),
)

#: Lines the streaming listener writes.
PROGRESS_LOG = _struct(
    ("EVENT_TIME", _S), ("STATUS", _S), ("STREAM_ID", _S), ("RUN_ID", _S), ("STREAM_NAME", _S),
    ("BATCH_INFO", _S), ("TERMINATION_EXCEPTION", _S),
)

#: Lines the listener of observed metrics writes.
OBSERVED_LOG = _struct(
    ("query_id", _S), ("run_id", _S), ("batch_id", _L), ("name", _S), ("time", _TS), ("metrics", _MAP),
)

#: Parts of a progress report the parser reads.
PROGRESS_REPORT = (
    "id STRING, runId STRING, name STRING, timestamp STRING, batchId BIGINT, numInputRows BIGINT, "
    "inputRowsPerSecond DOUBLE, processedRowsPerSecond DOUBLE, durationMs MAP<STRING,BIGINT>, sources STRING"
)

EXPECTATIONS = "ARRAY<STRUCT<name: STRING, dataset: STRING, passed_records: BIGINT, failed_records: BIGINT>>"
