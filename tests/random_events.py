"""Random small conversations that reach every rule, as rows of bot events."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import types as T

from parley.operators import utterances as u

COLUMNS = [
    "event_id", "event_date", "conversation_id", "time", "name", "text", "activity_id", "instance_id", "step_name",
    "dialog_id", "intent", "intent_score", "top_answer_score", "app_role_name", "props_conversation_id",
    "props_master_conversation_id",
]
SCHEMA = T.StructType([
    T.StructField(
        c,
        {"event_id": T.LongType(), "event_date": T.DateType(), "time": T.TimestampNTZType()}.get(c, T.StringType()),
    )
    for c in COLUMNS
])


def conversation(
    rng: random.Random, conversation_id: str, size: int, utterances: bool, sticky: bool = False
) -> list[dict]:
    """``sticky``: nearly every utterance may be merged into the one before it."""
    day = dt.date(2024, 3, 1 + rng.randrange(2))
    start = dt.datetime.combine(day, dt.time(0, 0))
    rows = []
    names = (
        ["BotMessageReceived"] * 4 + ["LuisResult"] * 3 + ["QnAResult", "FailedUtterance", "BotMessageSend", "BotMessageSend"]
        if utterances
        else ["BotMessageReceived", "WaterfallStep", "WaterfallStep", "WaterfallStep", "WaterfallComplete", "FailedUtterance"]
    )
    texts = [
        "Yes", "cancel", " Croma ", "ihcl", "customer care", "Yes, please.", "hello", "track", None, None, "show more",
    ]
    if sticky:
        names = ["BotMessageReceived"] * 5 + ["LuisResult"] * 3 + ["BotMessageSend"] * 3
        texts = ["croma", "ihcl", "customer care", "yes, please.", "qmin", "need to talk to executive"] * 4 + ["hello"]
    for i in range(size):
        name = rng.choice(names)
        step, dialog = rng.choice([
            ("InitialStepAsync", "MainDialog.WaterfallDialog"), ("InitialStepAsync", "MainDialog.WaterfallDialog"),
            ("EstablishChatStepAsync", "WaterfallDialog"), ("FinalStepAsync", None), (None, None), ("OtherStep", "X"),
            (None, "DisambiguateUserUtteranceDialog.WaterfallDialog"),
        ]) if name == "WaterfallStep" else (None, None)
        text = None
        if name == "BotMessageReceived":
            text = rng.choice(texts)
        elif name == "BotMessageSend":
            text = rng.choice([u.AGENT_START, u.AGENT_END, "ok", None])
        rows.append({
            "event_id": rng.randrange(10**9) * 1000 + i, "event_date": day, "conversation_id": conversation_id,
            # Few distinct times, so that ties and several minutes both occur.
            "time": start + dt.timedelta(seconds=rng.randrange(6) * 50),
            "name": name, "text": text,
            "activity_id": rng.choice(["a0", "a1", "a2", "a3", None] if not utterances else [f"a{k}" for k in range(max(4, size // 3))]),
            "instance_id": rng.choice(["i0", "i1", "i2", None]) if not utterances else None,
            "step_name": step, "dialog_id": dialog,
            "intent": rng.choice(["Cancel", "IdentifyBrand", "IdentifyBrand", "Help", "Track", None]) if name == "LuisResult" or rng.random() < 0.1 else None,
            "intent_score": rng.choice(["0.9", "0.75", "0.4", "0.005", "bad", None, "0.8"]) if name == "LuisResult" else None,
            "top_answer_score": rng.choice(["0.95", "0.5", "0.0", None]) if name == "QnAResult" else None,
            "app_role_name": rng.choice(["TDL.Chatbot.Master", "TDL.Chatbot.Master", "TCP.Chatbot.Shop", "Skill", None]),
            "props_conversation_id": rng.choice([conversation_id, conversation_id, "other"]),
            "props_master_conversation_id": rng.choice([conversation_id, None]),
        })
    return rows


def conversations(seed: int, count: int, max_size: int, utterances: bool, sticky: bool = False) -> list[dict]:
    rng = random.Random(seed)
    return [
        row
        for n in range(count)
        for row in conversation(rng, f"c{n}-in", rng.randrange(1, max_size), utterances, sticky)
    ]


def frame(spark, rows: list[dict]):
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], SCHEMA)


def grouped(rows: list[dict]) -> dict:
    out: dict = {}
    for r in rows:
        out.setdefault((r["event_date"], r["conversation_id"]), []).append(r)
    return out
