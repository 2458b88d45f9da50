"""Catalogue: dialog and utterance queries over the derived bot events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.times import in_date_range
from parley.operators import dialogs as d
from parley.operators import utterances as u
from parley.operators.ordered import minute_slice, position
from parley.plans.bot_reports import (
    conversation_events, deliver_dialogs, deliver_utterances, dialog_store, save_dialogs, save_utterances, utterance_store,
)
from parley.plans.derived_events import bot_events_sql, derived_bot_events
from parley.staging import stage, staging_path


def bot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived_bot_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.in_scope(bot_events(spark, sf_dir))


def scoped_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stored table, for jobs that read the events several times."""
    return stage(scoped(spark, sf_dir), "bot-events")


# --- Spark side -----------------------------------------------------------


def event_position(spark, sf_dir):
    events = scoped(spark, sf_dir)
    return position(events, d.KEYS, d.ORDER, minute_slice(events, "time")).select(*d.KEYS, "event_id", "pos")


def filter_conversation_events(spark, sf_dir):
    return conversation_events(scoped(spark, sf_dir), "c7-in").select("event_id", "conversation_id", "name")


def filter_date_range(spark, sf_dir):
    events = in_date_range(bot_events(spark, sf_dir), "event_date", dt.date(2024, 1, 5), dt.date(2024, 1, 11))
    return events.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


def conversation_id_coalesce(spark, sf_dir):
    return bot_events(spark, sf_dir).select(
        "event_id",
        F.coalesce("props_master_conversation_id", "props_conversation_id").alias("resolved_conversation_id"),
    )


def semi_user_instances(spark, sf_dir):
    return d.user_instances(scoped_table(spark, sf_dir))


def dialog_segments(spark, sf_dir):
    return d.segment_dialogs(scoped_table(spark, sf_dir))


def incremental_new_dialogs(spark, sf_dir):
    """A run over the first half of the month, then one over all of it: what the second adds."""
    events, path = scoped_table(spark, sf_dir), staging_path(spark, "dialogs")
    save_dialogs(spark, in_date_range(events, "event_date", dt.date(2000, 1, 1), dt.date(2024, 1, 15)), path)
    added = save_dialogs(spark, events, path)
    return added.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")})


def incremental_utterances(spark, sf_dir):
    """Two runs that overlap; the store holds every utterance once."""
    events, path = scoped_table(spark, sf_dir), staging_path(spark, "utterances")
    save_utterances(spark, in_date_range(events, "event_date", dt.date(2000, 1, 1), dt.date(2024, 1, 15)), path)
    save_utterances(spark, events, path)
    return spark.read.parquet(path).drop("event_date").withColumn("time", F.col("time").cast("timestamp_ntz"))


#: Events of some conversations that arrive with a second delivery.
_LATE = "event_date >= DATE '2024-01-12' AND event_id % 3 = 0 AND conversation_id IN ('c1-in', 'c4-in', 'c7-in', 'c12-in')"


def _deliveries(events):
    """On time; late; and the late ones once more, with a few of the first."""
    late = F.expr(_LATE)
    return events.where(~late), events.where(late), events.where(late | F.expr("event_date = DATE '2024-01-20' AND conversation_id = 'c2-in'"))


def late_dialogs(spark, sf_dir):
    """Dialogs after three deliveries, with the delivery that last computed each."""
    store = dialog_store(spark, staging_path(spark, "late-dialogs"))
    for events in _deliveries(scoped_table(spark, sf_dir)):
        deliver_dialogs(store, events)
    return store.read().withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")})


def late_utterances(spark, sf_dir):
    """Utterances after three deliveries, the first two folded into a base before the third."""
    store = utterance_store(spark, staging_path(spark, "late-utterances"))
    first, late, again = _deliveries(scoped_table(spark, sf_dir))
    deliver_utterances(store, first)
    store.compact(deliver_utterances(store, late))
    deliver_utterances(store, again)
    return store.read().drop("event_date", "event_conversation_id").withColumn("time", F.col("time").cast("timestamp_ntz"))


def dialog_daily_kpis(spark, sf_dir):
    return d.daily_kpis(d.segment_dialogs(scoped_table(spark, sf_dir)))


def conversation_bounce_stats(spark, sf_dir):
    events = scoped_table(spark, sf_dir)
    return d.bounce_stats(events, d.segment_dialogs(events))


def activity_first_seen(spark, sf_dir):
    first = u.user_activity_order(scoped(spark, sf_dir))
    ranked = position(first, d.KEYS, u.ORDER, minute_slice(first, "first_time"), "seen")
    return ranked.select(*d.KEYS, "activity_id", "seen")


_INTENT_COLUMNS = [
    "event_date", "activity_id", "time", "text", "intent", "intent_score", "app_role_name", "child_app_role_name",
    "props_conversation_id", "props_master_conversation_id", "agent_connection", "agent_closed",
    "resolved_conversation_id",
]


def activity_intent(spark, sf_dir):
    return u.resolve_intents(scoped(spark, sf_dir)).select(*_INTENT_COLUMNS)


def utterance_raw_scores(spark, sf_dir):
    return u.raw_scores(u.resolve_intents(scoped(spark, sf_dir))).select(
        "event_date", "activity_id", "intent", "intent_score", "master_score", "child_score"
    )


_PASS_COLUMNS = [
    "event_date", "activity_id", "intent", "intent_score", "child_app_role_name", "props_conversation_id",
    "props_master_conversation_id", "agent_connection", "agent_closed", "master_score", "child_score",
]


def lookahead_brand(spark, sf_dir):
    return u.absorb_brand_choice(u.prepared_utterances(scoped(spark, sf_dir))).select(*_PASS_COLUMNS)


def lookahead_agent(spark, sf_dir):
    return u.merged_utterances(scoped(spark, sf_dir)).select(*_PASS_COLUMNS)


def agent_span_removal(spark, sf_dir):
    merged = stage(u.merged_utterances(scoped(spark, sf_dir)), "utterances-merged")
    return u.remove_agent_spans(merged).select(*_PASS_COLUMNS)


def utterance_scores(spark, sf_dir):
    return u.score_utterances(scoped(spark, sf_dir))


def activity_distinct_count(spark, sf_dir):
    return u.score_utterances(scoped(spark, sf_dir)).agg(F.count_distinct("activity_id").alias("activities"))


# --- SQL side -------------------------------------------------------------

_BASE = f"""
WITH b AS ({bot_events_sql()}),
s AS (SELECT b.*, CAST(row_number() OVER (PARTITION BY event_date, conversation_id
             ORDER BY time, activity_id, event_id) - 1 AS BIGINT) AS pos
      FROM b WHERE conversation_id LIKE '%-in')"""

_DIALOGS = _BASE + """,
ua AS (SELECT DISTINCT event_date, conversation_id, activity_id FROM s
       WHERE name = 'BotMessageReceived' AND text IS NOT NULL),
vi AS (SELECT DISTINCT event_date, conversation_id, instance_id FROM s
       WHERE instance_id IS NOT NULL AND EXISTS (SELECT 1 FROM ua WHERE ua.event_date = s.event_date
         AND ua.conversation_id = s.conversation_id AND ua.activity_id = s.activity_id)),
m AS (SELECT s.event_date, s.conversation_id, s.instance_id, s.pos,
        coalesce((vi.instance_id IS NOT NULL AND s.step_name = 'InitialStepAsync' AND s.dialog_id = 'MainDialog.WaterfallDialog')
          OR (s.step_name = 'EstablishChatStepAsync' AND s.dialog_id = 'WaterfallDialog'), false) AS starts,
        coalesce(vi.instance_id IS NOT NULL AND (s.dialog_id = 'DisambiguateUserUtteranceDialog.WaterfallDialog'
          OR s.step_name = 'FinalStepAsync' OR s.name = 'WaterfallComplete'), false) AS ends
      FROM s LEFT JOIN vi USING (event_date, conversation_id, instance_id) WHERE s.instance_id IS NOT NULL),
i AS (SELECT event_date, conversation_id, instance_id, min(pos) FILTER (WHERE starts) AS first,
        max(pos) FILTER (WHERE starts) AS start, max(pos) FILTER (WHERE ends) AS finish
      FROM m WHERE (event_date, conversation_id) IN (SELECT (event_date, conversation_id) FROM ua)
      GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE starts) > 0),
r AS (SELECT i.*, count(finish) OVER g AS nc, count(*) OVER g AS n,
        row_number() OVER (PARTITION BY event_date, conversation_id ORDER BY first) AS rk,
        row_number() OVER (PARTITION BY event_date, conversation_id, finish IS NULL ORDER BY first) AS crk,
        lead(start) OVER (PARTITION BY event_date, conversation_id ORDER BY first) AS nxt
      FROM i WINDOW g AS (PARTITION BY event_date, conversation_id)),
lf AS (SELECT event_date, conversation_id, max_by(finish, first) AS last_finish FROM i WHERE finish IS NOT NULL GROUP BY 1, 2),
dl AS (
  SELECT event_date, conversation_id, crk AS number, instance_id, start AS lo, finish AS hi, false AS abandoned_left, false AS own_only
  FROM r WHERE finish IS NOT NULL
  UNION ALL
  SELECT r.event_date, r.conversation_id, CASE WHEN nc = 0 THEN n ELSE nc + 1 END, instance_id, start, 1000000000000, true, false
  FROM r LEFT JOIN lf USING (event_date, conversation_id) WHERE rk = n AND (nc = 0 OR start > last_finish)
  UNION ALL
  SELECT event_date, conversation_id, rk, instance_id, start, nxt, true, true FROM r WHERE nc = 0 AND rk < n),
won AS (SELECT s.event_date, s.conversation_id, s.pos, max(dl.number) AS number
        FROM s JOIN dl ON s.event_date = dl.event_date AND s.conversation_id = dl.conversation_id AND s.pos BETWEEN dl.lo AND dl.hi
          AND (NOT dl.own_only OR s.instance_id IS NULL OR s.instance_id = dl.instance_id)
        GROUP BY 1, 2, 3),
dialogs AS (SELECT s.event_date, 'D' || dl.number || '|' || dl.instance_id AS dialog, s.conversation_id,
        min(s.time) AS start_time, max(s.time) AS end_time, bool_or(dl.abandoned_left) AS abandoned_left,
        coalesce(bool_or(s.intent = 'Cancel'), false) AS cancelled, bool_or(s.name = 'FailedUtterance') AS failed,
        coalesce(bool_or(s.step_name = 'EstablishChatStepAsync'), false) AS agent
      FROM s JOIN won USING (event_date, conversation_id, pos) JOIN dl USING (event_date, conversation_id, number)
      GROUP BY s.event_date, dl.number, dl.instance_id, s.conversation_id)
"""

_START = "concat('You', chr(39), 're now connected to a customer care executive.')"
_END = "'Your conversation with the customer care executive has ended.'"
_EXCLUDED = ", ".join(f"'{w}'" for w in u.EXCLUDED_INTENTS)
_NAMES = ", ".join(f"'{w}'" for w in u.RESULT_NAMES)
_BRANDS = ", ".join(f"'{w}'" for w in u.BRANDS)
_PHRASES = ", ".join(f"'{w}'" for w in u.AGENT_PHRASES)

_INTENTS = _BASE + f""",
cand AS (SELECT event_date, conversation_id, activity_id, min(pos) AS cpos FROM s
         WHERE (name = 'BotMessageReceived' AND text IS NOT NULL) OR text IN ({_START}, {_END}) GROUP BY 1, 2, 3),
k AS (SELECT s.*, cand.cpos, row_number() OVER (PARTITION BY s.event_date, s.conversation_id, s.activity_id, s.name ORDER BY pos) AS nth,
        row_number() OVER (PARTITION BY s.event_date, s.conversation_id, s.activity_id ORDER BY pos) AS nth_any,
        row_number() OVER (PARTITION BY s.event_date, s.conversation_id, s.activity_id, s.name,
          coalesce(s.intent IN ({_EXCLUDED}), false) ORDER BY pos DESC) AS from_end,
        bool_or(text = {_START}) OVER a AS ac, bool_or(text = {_END}) OVER a AS ax
      FROM s JOIN cand USING (event_date, conversation_id, activity_id) WHERE s.name IN ({_NAMES})
      WINDOW a AS (PARTITION BY s.event_date, s.conversation_id, s.activity_id)),
j AS (SELECT c.event_date, c.conversation_id, c.activity_id, c.cpos, msg.time, msg.text, msg.app_role_name,
        coalesce(msg.ac, false) AS agent_connection, coalesce(msg.ax, false) AS agent_closed,
        f.event_id IS NOT NULL AS failed, l.event_id IS NOT NULL AS has_luis, q.event_id IS NOT NULL AS has_qna,
        l.intent AS l_intent, CASE WHEN l.event_id IS NULL THEN 0.0 ELSE l.intent_score END AS l_score,
        CASE WHEN q.event_id IS NULL THEN 0.0 ELSE q.top_answer_score END AS q_score,
        f.app_role_name AS f_role, f.props_conversation_id AS f_c, f.props_master_conversation_id AS f_m,
        q.app_role_name AS q_role, q.props_conversation_id AS q_c, q.props_master_conversation_id AS q_m,
        CASE WHEN l.event_id IS NOT NULL THEN l.app_role_name WHEN l1.event_id IS NOT NULL THEN l1.app_role_name ELSE a1.app_role_name END AS o_role,
        CASE WHEN l.event_id IS NOT NULL THEN l.props_conversation_id WHEN l1.event_id IS NOT NULL THEN l1.props_conversation_id ELSE a1.props_conversation_id END AS o_c,
        CASE WHEN l.event_id IS NOT NULL THEN l.props_master_conversation_id WHEN l1.event_id IS NOT NULL THEN l1.props_master_conversation_id ELSE a1.props_master_conversation_id END AS o_m
      FROM cand c
      JOIN k msg ON msg.event_date = c.event_date AND msg.conversation_id = c.conversation_id AND msg.activity_id = c.activity_id AND msg.name = 'BotMessageReceived' AND msg.nth = 1
      JOIN k a1 ON a1.event_date = c.event_date AND a1.conversation_id = c.conversation_id AND a1.activity_id = c.activity_id AND a1.nth_any = 1
      LEFT JOIN k f ON f.event_date = c.event_date AND f.conversation_id = c.conversation_id AND f.activity_id = c.activity_id AND f.name = 'FailedUtterance' AND f.nth = 1
      LEFT JOIN k q ON q.event_date = c.event_date AND q.conversation_id = c.conversation_id AND q.activity_id = c.activity_id AND q.name = 'QnAResult' AND q.nth = 1
      LEFT JOIN k l1 ON l1.event_date = c.event_date AND l1.conversation_id = c.conversation_id AND l1.activity_id = c.activity_id AND l1.name = 'LuisResult' AND l1.nth = 1
      LEFT JOIN k l ON l.event_date = c.event_date AND l.conversation_id = c.conversation_id AND l.activity_id = c.activity_id AND l.name = 'LuisResult' AND l.from_end = 1
        AND NOT coalesce(l.intent IN ({_EXCLUDED}), false)),
it AS (SELECT j.*, CASE WHEN failed THEN 'FailedUtterance' WHEN q_score > l_score THEN 'QnAResult' WHEN has_luis THEN l_intent END AS intent,
        CASE WHEN failed THEN 0.0 WHEN q_score > l_score THEN q_score ELSE l_score END AS intent_score,
        CASE WHEN failed THEN f_role WHEN has_qna THEN q_role ELSE o_role END AS child_app_role_name,
        CASE WHEN failed THEN f_c WHEN q_score > l_score THEN q_c ELSE o_c END AS props_conversation_id,
        CASE WHEN failed THEN f_m WHEN q_score > l_score THEN q_m ELSE o_m END AS props_master_conversation_id
      FROM j WHERE failed OR (l_score IS NOT NULL AND q_score IS NOT NULL)),
intents AS (SELECT it.*, coalesce(props_master_conversation_id, props_conversation_id) AS rc FROM it)"""

_SCORES = _INTENTS + """,
sc AS (SELECT *, app_role_name IS NOT DISTINCT FROM child_app_role_name AS same,
         coalesce(child_app_role_name = 'TDL.Chatbot.Master', false) AS im,
         coalesce(child_app_role_name LIKE '%TCP.Chatbot.%', false) AS ic FROM intents),
scores AS (SELECT *,
    round(CASE WHEN intent IS NULL THEN 0.0 WHEN NOT same AND intent <> 'FailedUtterance' THEN 0.5
      WHEN intent = 'QnAResult' AND im AND intent_score >= 0.75 THEN 0.5
      WHEN intent = 'QnAResult' AND im AND intent_score BETWEEN 0.01 AND 0.75 THEN 0.3
      WHEN intent = 'QnAResult' AND NOT im AND ic THEN 0.5
      WHEN intent = 'IdentifyBrand' OR (same AND intent <> 'FailedUtterance') THEN 0.3 ELSE 0.0 END::DOUBLE
      - CASE WHEN agent_connection AND same THEN 0.1 ELSE 0.0 END::DOUBLE, 2) AS master_score,
    round(CASE WHEN intent IS NULL THEN 0.0 WHEN intent = 'QnAResult' AND im THEN 0.0
      WHEN intent = 'QnAResult' AND ic AND intent_score >= 0.75 THEN 0.5
      WHEN intent = 'QnAResult' AND ic AND intent_score BETWEEN 0.01 AND 0.75 THEN 0.35
      WHEN NOT same AND intent_score >= 0.75 THEN 0.5
      WHEN NOT same AND intent_score BETWEEN 0.01 AND 0.75 THEN 0.35 ELSE 0.0 END::DOUBLE
      - CASE WHEN agent_connection AND NOT same THEN 0.1 ELSE 0.0 END::DOUBLE, 2) AS child_score
  FROM sc)"""

_G = "PARTITION BY event_date, conversation_id ORDER BY cpos"
_FIELDS = "event_date, conversation_id, activity_id, cpos, time, text, app_role_name, agent_closed, rc"

_BRAND = _SCORES + f""",
p0 AS (SELECT * FROM scores WHERE NOT coalesce(lower(text) IN ('yes', 'no', 'no, thanks.'), false)),
p1a AS (SELECT *, lead(activity_id) OVER w IS NOT NULL AND rc IS NOT DISTINCT FROM lead(rc) OVER w
      AND coalesce(intent = 'IdentifyBrand', false) AND same
      AND lead(intent) OVER w IS DISTINCT FROM 'FailedUtterance'
      AND coalesce(lower(trim(lead(text) OVER w)) IN ({_BRANDS}), false) AS eats,
    lead(intent) OVER w AS n_intent, lead(intent_score) OVER w AS n_score, lead(child_app_role_name) OVER w AS n_role,
    lead(child_score) OVER w AS n_child, lead(props_conversation_id) OVER w AS n_c, lead(props_master_conversation_id) OVER w AS n_m
  FROM p0 WINDOW w AS ({_G})),
p1b AS (SELECT *, coalesce(lag(eats) OVER ({_G}), false) AS gone FROM p1a),
p1 AS (SELECT {_FIELDS}, agent_connection, master_score,
    CASE WHEN eats THEN n_intent ELSE intent END AS intent, CASE WHEN eats THEN n_score ELSE intent_score END AS intent_score,
    CASE WHEN eats THEN n_role ELSE child_app_role_name END AS child_app_role_name,
    CASE WHEN eats THEN n_child ELSE child_score END AS child_score,
    CASE WHEN eats THEN n_c ELSE props_conversation_id END AS props_conversation_id,
    CASE WHEN eats THEN n_m ELSE props_master_conversation_id END AS props_master_conversation_id
  FROM p1b WHERE NOT gone)"""


def _agent_pass(source: str, target: str, text_rule: str) -> str:
    return f""",
{target}a AS (SELECT *, app_role_name IS NOT DISTINCT FROM child_app_role_name AS same_now,
    lead(activity_id) OVER w IS NOT NULL AND rc IS NOT DISTINCT FROM lead(rc) OVER w
    AND coalesce(lead(agent_connection) OVER w, false) AND {text_rule} AS eats
  FROM {source} WINDOW w AS ({_G})),
{target}b AS (SELECT *, coalesce(lag(eats) OVER ({_G}), false) AS gone FROM {target}a),
{target} AS (SELECT {_FIELDS}, intent, intent_score, child_app_role_name, props_conversation_id, props_master_conversation_id,
    agent_connection OR eats AS agent_connection,
    CASE WHEN eats AND same_now THEN round(master_score - 0.1::DOUBLE, 2) ELSE master_score END AS master_score,
    CASE WHEN eats AND NOT same_now THEN round(child_score - 0.1::DOUBLE, 2) ELSE child_score END AS child_score
  FROM {target}b WHERE NOT gone)"""


_AGENT = (
    _BRAND
    + _agent_pass("p1", "p2", "(lead(text) OVER w IS NULL OR lower(lead(text) OVER w) = 'yes, please.')")
    + _agent_pass("p2", "p3", f"coalesce(lower(lead(text) OVER w) IN ({_PHRASES}), false)")
)

_SPANS = _AGENT + """,
op AS (SELECT event_date, conversation_id, rc, cpos, row_number() OVER (PARTITION BY event_date, conversation_id, rc ORDER BY cpos) AS nth,
         count(*) OVER (PARTITION BY event_date, conversation_id, rc) AS n FROM p3 WHERE agent_connection),
cl AS (SELECT event_date, conversation_id, rc, cpos, row_number() OVER (PARTITION BY event_date, conversation_id, rc ORDER BY cpos) AS nth,
         count(*) OVER (PARTITION BY event_date, conversation_id, rc) AS n FROM p3 WHERE agent_closed),
sp AS (SELECT op.event_date, op.conversation_id, op.cpos AS a, cl.cpos AS z FROM op JOIN cl USING (event_date, conversation_id, rc, nth, n)),
p4 AS (SELECT * FROM p3 WHERE NOT EXISTS (SELECT 1 FROM sp WHERE sp.event_date = p3.event_date
         AND sp.conversation_id = p3.conversation_id AND p3.cpos > sp.a AND p3.cpos <= sp.z))"""

_FINAL = _SPANS + """,
final AS (SELECT time, text, activity_id, intent, intent_score, app_role_name, child_app_role_name, props_conversation_id,
    props_master_conversation_id, coalesce(props_master_conversation_id, props_conversation_id) AS conversation_id,
    agent_connection, master_score, child_score, round(master_score + child_score, 2) AS final_score
  FROM p4 WHERE NOT coalesce(lower(text) IN ('cancel', 'show more', 'yes, please.'), false))"""

_DIALOG_OUT = "event_date, dialog, conversation_id, start_time, end_time, abandoned_left, cancelled, failed, agent"
_PASS_OUT = ", ".join(_PASS_COLUMNS)

ORACLES = {
    "event_position": _BASE + " SELECT event_date, conversation_id, event_id, pos FROM s",
    "filter_conversation_events": _BASE + """ SELECT event_id, conversation_id, name FROM s
        WHERE props_conversation_id = 'c7-in' OR props_master_conversation_id = 'c7-in'""",
    "filter_date_range": _BASE + """ SELECT event_date, count(*) AS n FROM b
        WHERE event_date >= DATE '2024-01-05' AND event_date < DATE '2024-01-12' GROUP BY 1""",
    "conversation_id_coalesce": _BASE + """ SELECT event_id,
        coalesce(props_master_conversation_id, props_conversation_id) AS resolved_conversation_id FROM b""",
    "semi_user_instances": _DIALOGS + " SELECT event_date, conversation_id, instance_id FROM vi",
    "dialog_segments": _DIALOGS + f" SELECT {_DIALOG_OUT} FROM dialogs",
    "late_dialogs": _DIALOGS + f""",
        tc AS (SELECT DISTINCT event_date, conversation_id, CAST(2 AS BIGINT) AS last FROM s
          WHERE ({_LATE}) OR (event_date = DATE '2024-01-20' AND conversation_id = 'c2-in'))
        SELECT {_DIALOG_OUT}, coalesce(last, 0) AS batch_id FROM dialogs LEFT JOIN tc USING (event_date, conversation_id)""",
    "late_utterances": _SPANS + f""",
        tc AS (SELECT DISTINCT event_date, conversation_id, CAST(2 AS BIGINT) AS last FROM s
          WHERE ({_LATE}) OR (event_date = DATE '2024-01-20' AND conversation_id = 'c2-in'))
        SELECT time, text, activity_id, intent, intent_score, app_role_name, child_app_role_name, props_conversation_id,
          props_master_conversation_id, coalesce(props_master_conversation_id, props_conversation_id) AS conversation_id,
          agent_connection, master_score, child_score, round(master_score + child_score, 2) AS final_score, coalesce(last, 0) AS batch_id
        FROM p4 LEFT JOIN tc USING (event_date, conversation_id)
        WHERE NOT coalesce(lower(text) IN ('cancel', 'show more', 'yes, please.'), false)""",
    "incremental_new_dialogs": _DIALOGS + f""" SELECT {_DIALOG_OUT} FROM dialogs d WHERE NOT EXISTS (
        SELECT 1 FROM dialogs o WHERE o.start_time < TIMESTAMP '2024-01-16' AND o.event_date = d.event_date
        AND o.conversation_id = d.conversation_id AND o.dialog = d.dialog)""",
    "dialog_daily_kpis": _DIALOGS + """,
        kc AS (SELECT CAST(start_time AS DATE) AS date, count(DISTINCT conversation_id) AS total_conversations, count(*) AS total_dialogs,
          count(*) FILTER (WHERE (abandoned_left OR cancelled) AND NOT agent) AS abandoned_dialogs,
          count(*) FILTER (WHERE failed) AS failed_dialogs, count(*) FILTER (WHERE agent AND NOT cancelled) AS agent_dialogs,
          count(*) FILTER (WHERE agent AND NOT cancelled AND abandoned_left) AS open_agent_dialogs,
          count(*) FILTER (WHERE agent AND NOT cancelled AND NOT abandoned_left) AS closed_agent_dialogs
          FROM dialogs GROUP BY 1),
        kf AS (SELECT *, total_dialogs - (abandoned_dialogs + failed_dialogs + agent_dialogs) AS fcr_dialogs,
          CAST(NULLIF(total_dialogs - abandoned_dialogs, 0) AS DOUBLE) AS kept FROM kc)
        SELECT * EXCLUDE (kept), round(fcr_dialogs / kept * 100.0::DOUBLE, 2) AS fcr_pct,
          round(failed_dialogs / kept * 100.0::DOUBLE, 2) AS failed_pct, round(agent_dialogs / kept * 100.0::DOUBLE, 2) AS fbr_pct FROM kf""",
    "conversation_bounce_stats": _DIALOGS + """,
        tk AS (SELECT DISTINCT event_date, conversation_id FROM s),
        tu AS (SELECT DISTINCT event_date, conversation_id, true AS talks FROM ua),
        td AS (SELECT DISTINCT event_date, conversation_id, true AS kept FROM dialogs)
        SELECT event_date, count(*) AS conversations, count(*) FILTER (WHERE talks IS NULL) AS bounced,
          count(*) FILTER (WHERE kept) AS saved
        FROM tk LEFT JOIN tu USING (event_date, conversation_id) LEFT JOIN td USING (event_date, conversation_id) GROUP BY 1""",
    "activity_first_seen": _INTENTS + """ SELECT event_date, conversation_id, activity_id,
        CAST(row_number() OVER (PARTITION BY event_date, conversation_id ORDER BY cpos) - 1 AS BIGINT) AS seen FROM cand""",
    "activity_intent": _INTENTS + " SELECT event_date, activity_id, time, text, intent, intent_score, app_role_name,"
        " child_app_role_name, props_conversation_id, props_master_conversation_id, agent_connection, agent_closed,"
        " rc AS resolved_conversation_id FROM intents",
    "utterance_raw_scores": _SCORES + " SELECT event_date, activity_id, intent, intent_score, master_score, child_score FROM scores",
    "lookahead_brand": _BRAND + f" SELECT {_PASS_OUT} FROM p1",
    "lookahead_agent": _AGENT + f" SELECT {_PASS_OUT} FROM p3",
    "agent_span_removal": _SPANS + f" SELECT {_PASS_OUT} FROM p4",
    "utterance_scores": _FINAL + " SELECT * FROM final",
    "incremental_utterances": _FINAL + " SELECT * FROM final",
    "activity_distinct_count": _FINAL + " SELECT count(DISTINCT activity_id) AS activities FROM final",
}

QUERIES = {
    f.__name__: f
    for f in (
        event_position, filter_conversation_events, filter_date_range, conversation_id_coalesce, semi_user_instances,
        dialog_segments, incremental_new_dialogs, dialog_daily_kpis, conversation_bounce_stats, activity_first_seen,
        activity_intent, utterance_raw_scores, lookahead_brand, lookahead_agent, agent_span_removal, utterance_scores,
        activity_distinct_count, incremental_utterances, late_dialogs, late_utterances,
    )
}
