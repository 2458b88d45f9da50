"""Utterance scoring: one resolved intent and two scores per user activity.

``resolve_intents`` reduces the events of an activity with one aggregate, so a
hot activity is combined before the shuffle. The clean-up passes look at
neighbouring utterances of a conversation. They need no window over a whole
conversation: an utterance whose text none of the passes can absorb starts a
new *run*, passes never reach across runs, and windows run per run. Run
numbers and positions come from sliced running totals. A run that is itself
very long (one conversation repeating a request, say) is cut into blocks, and
the rows next to a cut take part in both blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators import ordered
from parley.operators.dialogs import FAILED_UTTERANCE, KEYS, USER_MESSAGE
from parley.operators.ordered import block_slice, minute_slice, position, running_totals
from parley.staging import stage

# Names, sentences and word lists of the bot.
LUIS_RESULT = "LuisResult"
QNA_RESULT = "QnAResult"
IDENTIFY_BRAND = "IdentifyBrand"
MASTER_ROLE = "TDL.Chatbot.Master"
CHILD_ROLE_PART = "TCP.Chatbot."
RESULT_NAMES = [
    "BotMessageReceived", "LuisResult", "QnAResult", "UtteranceDisambiguated", "FailedUtterance", "BotMessageSend",
]
AGENT_START = "You're now connected to a customer care executive."
AGENT_END = "Your conversation with the customer care executive has ended."
EXCLUDED_INTENTS = [
    "ReadAloud", "Reject", "Repeat", "SearchByDate", "SearchByOrderId", "SelectAny", "SelectItem", "SelectNone",
    "ShowPrevious", "StartOver", "Stop", "Cancel", "Confirm", "DoNotRemember", "ExtractEmail", "ExtractNumber",
    "FinishTask", "GoBack", "Help", "ExtractName",
]
BRANDS = [
    "croma", "bigbasket", "tata 1mg", "tata neu", "tata cliq", "airasia india", "ihcl", "westside", "qmin",
]
AGENT_PHRASES = [
    "i would like to talk to a customer care executive instead.",
    "no, i want to talk to a customer care executive.",
    "customer care",
    "i want to talk to a customer care executive.",
    "i want to talk to an agent",
    "i want to chat with support team",
    "need to talk to executive",
    "i want to connect to an agent",
    "connect to an customer care executive!",
    "i want to talk to customer care",
]
AGENT_CONFIRMATION = "yes, please."
FILLERS_BEFORE = ["yes", "no", "no, thanks."]
FILLERS_AFTER = ["cancel", "show more", "yes, please."]
GOOD_SCORE = 0.75
BAD_SCORE = 0.01
AGENT_PENALTY = 0.1
WHITESPACE = " \t\n\r\f\v"

IDS = ["app_role_name", "props_conversation_id", "props_master_conversation_id"]
ORDER = ["first_time", "activity_id", "first_event_id"]
RUN = [*KEYS, "run"]
OUTPUT = [
    "time", "text", "activity_id", "intent", "intent_score", "app_role_name", "child_app_role_name",
    "props_conversation_id", "props_master_conversation_id", "conversation_id", "agent_connection",
    "master_score", "child_score", "final_score",
]


def _true(condition: Column) -> Column:
    """Two-valued: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def _same_role() -> Column:
    return F.col("app_role_name").eqNullSafe(F.col("child_app_role_name"))


def _listed(text: str | Column, words: Sequence[str]) -> Column:
    col = F.col(text) if isinstance(text, str) else text
    return _true(F.lower(col).isin([w.lower() for w in words]))


def user_activity_order(
    events: DataFrame, agent_start: str = AGENT_START, agent_end: str = AGENT_END
) -> DataFrame:
    """Candidate activities with the place of their first qualifying event."""
    return (
        events.where(F.col("activity_id").isNotNull() & _candidate(agent_start, agent_end))
        .groupBy(*KEYS, "activity_id")
        .agg(F.min(_event_place()).alias("first"))
        .select(
            *KEYS, "activity_id", F.col("first.time").alias("first_time"), F.col("first.event_id").alias("first_event_id")
        )
    )


def _event_place() -> Column:
    """Order of events inside one activity."""
    return F.struct(F.col("time").isNull().alias("late"), "time", "event_id")


def _candidate(agent_start: str, agent_end: str) -> Column:
    return _true(
        ((F.col("name") == USER_MESSAGE) & F.col("text").isNotNull()) | F.col("text").isin(agent_start, agent_end)
    )


def resolve_intents(
    events: DataFrame,
    excluded_intents: Sequence[str] = EXCLUDED_INTENTS,
    agent_start: str = AGENT_START,
    agent_end: str = AGENT_END,
) -> DataFrame:
    """One row per user activity with its intent, score, roles and agent flags.

    Activities without a user message event, or whose deciding score is
    missing or not a number, have no row.
    """
    place = _event_place()
    kept = F.col("name").isin(RESULT_NAMES)
    luis = F.col("name") == LUIS_RESULT
    usable_luis = luis & ~_true(F.col("intent").isin(list(excluded_intents)))
    ids = F.struct(*IDS)
    luis_score = F.col("intent_score").try_cast("double")
    qna_score = F.col("top_answer_score").try_cast("double")

    def first(value: Column, condition: Column) -> Column:
        return F.min_by(value, F.when(condition, place))

    picked = (
        events.where(F.col("activity_id").isNotNull() & _true(kept | F.col("text").isin(agent_start, agent_end)))
        .groupBy("activity_id", *KEYS)  # the most telling column first: it decides most comparisons of the sort
        .agg(
            F.min(F.when(_candidate(agent_start, agent_end), place)).alias("candidate"),
            _true(F.max(kept & (F.col("text") == agent_start))).alias("agent_connection"),
            _true(F.max(kept & (F.col("text") == agent_end))).alias("agent_closed"),
            first(ids, F.col("name") == FAILED_UTTERANCE).alias("failed"),
            F.max_by(F.struct("intent", luis_score.alias("score"), ids.alias("ids")), F.when(usable_luis, place)).alias("luis"),
            first(ids, luis).alias("first_luis"),
            first(F.struct(qna_score.alias("score"), ids.alias("ids")), F.col("name") == QNA_RESULT).alias("qna"),
            first(ids, kept).alias("first_any"),
            first(F.struct("time", "text", "app_role_name"), F.col("name") == USER_MESSAGE).alias("message"),
        )
        .where(F.col("candidate").isNotNull() & F.col("message").isNotNull())
    )

    has_failed, has_luis, has_qna = (F.col(c).isNotNull() for c in ("failed", "luis", "qna"))
    luis_value = F.when(has_luis, F.col("luis.score")).otherwise(F.lit(0.0))
    qna_value = F.when(has_qna, F.col("qna.score")).otherwise(F.lit(0.0))
    # A score that is not a number never compares as greater.
    qna_wins = _true(~F.isnan(qna_value) & (qna_value > luis_value))
    fallback = F.coalesce(F.col("luis.ids"), F.col("first_luis"), F.col("first_any"))
    chosen = F.when(has_failed, F.col("failed")).when(qna_wins, F.col("qna.ids")).otherwise(fallback)
    role = (
        F.when(has_failed, F.col("failed.app_role_name"))
        .when(has_qna, F.col("qna.ids.app_role_name"))
        .otherwise(fallback["app_role_name"])
    )
    return (
        picked.where(has_failed | (luis_value.isNotNull() & qna_value.isNotNull()))
        .select(
            *KEYS,
            "activity_id",
            F.col("candidate.time").alias("first_time"),
            F.col("candidate.event_id").alias("first_event_id"),
            F.col("message.time").alias("time"),
            F.col("message.text").alias("text"),
            F.when(has_failed, F.lit(FAILED_UTTERANCE))
            .when(qna_wins, F.lit(QNA_RESULT))
            .otherwise(F.col("luis.intent")).alias("intent"),
            F.when(has_failed, F.lit(0.0)).when(qna_wins, qna_value).otherwise(luis_value).alias("intent_score"),
            F.col("message.app_role_name").alias("app_role_name"),
            role.alias("child_app_role_name"),
            chosen["props_conversation_id"].alias("props_conversation_id"),
            chosen["props_master_conversation_id"].alias("props_master_conversation_id"),
            "agent_connection",
            "agent_closed",
        )
        .withColumn(
            "resolved_conversation_id",
            F.coalesce(F.col("props_master_conversation_id"), F.col("props_conversation_id")),
        )
    )


def raw_scores(utterances: DataFrame) -> DataFrame:
    """Add ``master_score`` and ``child_score``; the first matching rule counts."""
    intent = F.col("intent")
    score = F.nanvl(F.col("intent_score"), F.lit(-1.0))
    same = _same_role()
    failed = intent.eqNullSafe(F.lit(FAILED_UTTERANCE))
    qna = intent == QNA_RESULT
    in_master = _true(F.col("child_app_role_name") == MASTER_ROLE)
    in_child = _true(F.col("child_app_role_name").contains(CHILD_ROLE_PART))
    good = score >= GOOD_SCORE
    bad = score.between(BAD_SCORE, GOOD_SCORE)

    master = (
        F.when(intent.isNull(), 0.0)
        .when(~same & ~failed, 0.5)
        .when(qna & in_master & good, 0.5)
        .when(qna & in_master & bad, 0.3)
        .when(qna & ~in_master & in_child, 0.5)
        .when((intent == IDENTIFY_BRAND) | (same & ~failed), 0.3)
        .otherwise(0.0)
    )
    child = (
        F.when(intent.isNull(), 0.0)
        .when(qna & in_master, 0.0)
        .when(qna & in_child & good, 0.5)
        .when(qna & in_child & bad, 0.35)
        .when(~same & good, 0.5)
        .when(~same & bad, 0.35)
        .otherwise(0.0)
    )
    penalty = F.lit(AGENT_PENALTY)
    agent = F.col("agent_connection")
    return utterances.withColumns(
        {
            "master_score": F.round(master - F.when(agent & same, penalty).otherwise(0.0), 2),
            "child_score": F.round(child - F.when(agent & ~same, penalty).otherwise(0.0), 2),
        }
    )


def drop_fillers(utterances: DataFrame, words: Sequence[str] = FILLERS_BEFORE) -> DataFrame:
    """Remove utterances that consist of a listed word; missing texts stay."""
    return utterances.where(~_listed("text", words))


def with_runs(
    utterances: DataFrame, brands: Sequence[str] = BRANDS, phrases: Sequence[str] = AGENT_PHRASES
) -> DataFrame:
    """Add the position in the conversation and the run number.

    A run starts at every utterance that no pass can merge into the one before
    it, judged on text, intent and flag as they stand before the first pass.
    Passes never change a text, and the flag only matters for phrases, which
    are all treated as mergeable, so later passes cannot reach across runs.
    """
    mergeable = (
        (_listed(F.btrim("text", F.lit(WHITESPACE)), brands) & ~F.col("intent").eqNullSafe(F.lit(FAILED_UTTERANCE)))
        | (F.col("agent_connection") & (F.col("text").isNull() | _listed("text", [AGENT_CONFIRMATION])))
        | _listed("text", phrases)
    )
    out = running_totals(
        utterances, KEYS, ORDER, minute_slice(utterances, "first_time"),
        {"utterance_pos": F.lit(1), "run": (~mergeable).cast("int")},
    )
    return out.withColumn("utterance_pos", F.col("utterance_pos") - 1)


def _absorb_next(
    utterances: DataFrame, peek: Sequence[str], condition: Column, updates: dict[str, Column]
) -> DataFrame:
    """Merge the next utterance of the run into this one where ``condition``.

    ``condition`` and ``updates`` may use the ``peek`` columns of the struct
    ``next``. Each pass reads only its own input: a row that is itself merged
    away may still absorb.
    """
    parts = [*RUN, "block"] if "block" in utterances.columns else RUN
    run = Window.partitionBy(*reversed(parts)).orderBy("utterance_pos")
    peeked = utterances.withColumn("next", F.lead(F.struct("resolved_conversation_id", *peek)).over(run))
    judged = peeked.withColumn(
        "absorbs",
        F.col("next").isNotNull()
        & F.col("resolved_conversation_id").eqNullSafe(F.col("next.resolved_conversation_id"))
        & _true(condition),
    )
    return (
        judged.withColumn("absorbed", F.lag("absorbs", 1, False).over(run))
        .where(~F.col("absorbed"))
        .withColumns({c: F.when(F.col("absorbs"), new).otherwise(F.col(c)) for c, new in updates.items()})
        .drop("next", "absorbs", "absorbed")
    )


def absorb_brand_choice(utterances: DataFrame, brands: Sequence[str] = BRANDS) -> DataFrame:
    """The answer to a brand question takes the place of the question's result."""
    copied = [
        "intent", "intent_score", "child_app_role_name", "child_score",
        "props_conversation_id", "props_master_conversation_id",
    ]
    return _absorb_next(
        utterances,
        [*copied, "text"],
        (F.col("intent") == IDENTIFY_BRAND)
        & _same_role()
        & ~F.col("next.intent").eqNullSafe(F.lit(FAILED_UTTERANCE))
        & _listed(F.btrim("next.text", F.lit(WHITESPACE)), brands),
        {c: F.col(f"next.{c}") for c in copied},
    )


def _agent_updates() -> dict[str, Column]:
    same = _same_role()

    def lowered(column: str) -> Column:
        return F.round(F.col(column) - AGENT_PENALTY, 2)

    return {
        "agent_connection": F.lit(True),
        "master_score": F.when(same, lowered("master_score")).otherwise(F.col("master_score")),
        "child_score": F.when(~same, lowered("child_score")).otherwise(F.col("child_score")),
    }


def absorb_agent_confirmation(utterances: DataFrame) -> DataFrame:
    """A silent or confirming hand-over to an agent belongs to the request before it."""
    return _absorb_next(
        utterances,
        ["agent_connection", "text"],
        F.col("next.agent_connection")
        & (F.col("next.text").isNull() | (F.lower("next.text") == AGENT_CONFIRMATION)),
        _agent_updates(),
    )


def absorb_agent_request(utterances: DataFrame, phrases: Sequence[str] = AGENT_PHRASES) -> DataFrame:
    """An explicit request for an agent belongs to the utterance before it."""
    return _absorb_next(
        utterances,
        ["agent_connection", "text"],
        F.col("next.agent_connection") & _listed("next.text", phrases),
        _agent_updates(),
    )


def remove_agent_spans(utterances: DataFrame) -> DataFrame:
    """Remove what was said between an agent's connection and its close.

    Per resolved conversation the k-th connection is paired with the k-th
    close, provided there are equally many. A pair removes every position of
    the whole conversation-day after the connection up to the close.
    """
    conversation = [*KEYS, "resolved_conversation_id"]
    opens, closes = F.col("agent_connection").cast("int"), F.col("agent_closed").cast("int")
    flagged = utterances.where(
        F.col("resolved_conversation_id").isNotNull() & (F.col("agent_connection") | F.col("agent_closed"))
    ).select(*conversation, "utterance_pos", "agent_connection", "agent_closed")
    ranked = running_totals(
        flagged, conversation, ["utterance_pos"], block_slice("utterance_pos"),
        {"open_rank": opens, "close_rank": closes},
        {"n_open": opens, "n_close": closes},
    ).where(F.col("n_open") == F.col("n_close"))
    ends = F.array(
        F.when(F.col("agent_connection"), F.struct(F.col("open_rank").alias("rank"), F.lit("open").alias("kind"))),
        F.when(F.col("agent_closed"), F.struct(F.col("close_rank").alias("rank"), F.lit("close").alias("kind"))),
    )
    spans = (
        ranked.select(*conversation, "utterance_pos", F.explode(F.filter(ends, lambda e: e.isNotNull())).alias("end"))
        .groupBy(*conversation, F.col("end.rank").alias("rank"))
        .agg(
            F.max(F.when(F.col("end.kind") == "open", F.col("utterance_pos"))).alias("opened"),
            F.max(F.when(F.col("end.kind") == "close", F.col("utterance_pos"))).alias("closed"),
        )
        .where(F.col("closed") > F.col("opened"))
    )
    steps = spans.select(
        *KEYS,
        F.explode(F.array(
            F.struct(F.col("opened").alias("pos"), F.lit(1).alias("step")),
            F.struct(F.col("closed").alias("pos"), F.lit(-1).alias("step")),
        )).alias("s"),
    ).select(*KEYS, F.col("s.pos").alias("utterance_pos"), F.col("s.step").alias("step"), F.lit(1).alias("after"))
    rows = utterances.withColumns({"step": F.lit(0), "after": F.lit(0)})
    depth = running_totals(
        rows.unionByName(steps, allowMissingColumns=True), KEYS, ["utterance_pos", "after"],
        block_slice("utterance_pos"), {"depth": F.col("step")},
    )
    return depth.where((F.col("after") == 0) & (F.col("depth") == 0)).select(*utterances.columns)


def final_scores(
    utterances: DataFrame, words: Sequence[str] = FILLERS_AFTER, keep: dict[str, str] | None = None
) -> DataFrame:
    """Total score, final conversation id, closing filter and output columns.

    ``keep`` names further columns (new name to old name) of the utterances.
    """
    kept = {new: F.col(old) for new, old in (keep or {}).items()}
    return drop_fillers(utterances, words).withColumns(
        {
            **kept,
            "final_score": F.round(F.col("master_score") + F.col("child_score"), 2),
            "conversation_id": F.coalesce(F.col("props_master_conversation_id"), F.col("props_conversation_id")),
        }
    ).select(*OUTPUT, *kept)


def prepared_utterances(events: DataFrame) -> DataFrame:
    """Resolved, scored and numbered utterances: the input of the passes."""
    scored = stage(drop_fillers(raw_scores(resolve_intents(events))), "utterances-scored")
    return stage(with_runs(scored), "utterances-numbered")


PASSES = (absorb_brand_choice, absorb_agent_confirmation, absorb_agent_request)


def _in_blocks(utterances: DataFrame) -> DataFrame:
    """Blocks of a run; the rows on both sides of a cut stand in both blocks (``edge``)."""
    size = 1 << ordered.BLOCK_BITS
    placed = position(utterances, RUN, ["utterance_pos"], block_slice("utterance_pos"), "place")
    block, offset = block_slice("place"), F.col("place") % size

    def member(number: Column, edge: bool) -> Column:
        return F.struct(number.alias("block"), F.lit(edge).alias("edge"))

    members = F.array(
        member(block, False),
        F.when((offset == 0) & (F.col("place") > 0), member(block - 1, True)),
        F.when(offset == size - 1, member(block + 1, True)),
    )
    return placed.select(
        *utterances.columns, F.explode(F.filter(members, lambda m: m.isNotNull())).alias("m")
    ).select(*utterances.columns, "m.block", "m.edge")


def merge_passes(numbered: DataFrame) -> DataFrame:
    """The three merging passes over numbered utterances (a stored table).

    A run no longer than a block is one group, and the passes go through it one
    after another in the same tasks. The few longer ones (there is at most one
    per block's worth of rows) go through each pass in blocks, renumbered after
    every pass, so that a long run is many groups.
    """
    counted = numbered.groupBy(*RUN).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1 << ordered.BLOCK_BITS)
    cut = stage(counted.select(*[F.col(k).alias(f"__{k}") for k in RUN]), "utterances-long-runs")
    if cut.isEmpty():
        return _all_passes(numbered)
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in RUN]
    short, long = (numbered.join(F.broadcast(cut), same, how) for how in ("left_anti", "left_semi"))
    for merge in PASSES:
        long = stage(merge(_in_blocks(long)).where(~F.col("edge")).drop("block", "edge"), "utterances-pass")
    return _all_passes(short).unionByName(long)


def _all_passes(numbered: DataFrame) -> DataFrame:
    for merge in PASSES:
        numbered = merge(numbered)
    return numbered


def merged_utterances(events: DataFrame) -> DataFrame:
    """Utterances after the three merging passes."""
    return merge_passes(prepared_utterances(events))


def score_utterances(events: DataFrame, keep: dict[str, str] | None = None) -> DataFrame:
    """The whole chain: events in scope to scored utterances; ``keep`` as in :func:`final_scores`."""
    merged = stage(merged_utterances(events), "utterances-merged")
    return final_scores(remove_agent_spans(merged), keep=keep)


def new_utterances(utterances: DataFrame, known: DataFrame) -> DataFrame:
    """Utterances whose activity was not stored before."""
    return utterances.join(known.select("activity_id").distinct(), "activity_id", "left_anti")
