"""Dialog segmentation: start and end markers of a conversation become dialogs.

All rules hold per (event_date, conversation_id) on events ordered by time,
activity and event id:

* An instance is *valid* when it occurs in an activity that holds a user message.
* A dialog instance starts at its last start marker, ends at its last end
  marker, and instances are ranked by their first start marker.
* With closed instances (start and end), each covers start..end, and the last
  instance in rank order becomes an open tail when it starts after the end of
  the last closed one.
* Without any, every instance reaches to the start of the next in rank order
  (only its own rows and rows without instance), and the last one is the tail.
* Where dialogs overlap, the higher number wins.

Nothing gathers a conversation into one task. Markers are reduced per instance
before the shuffle; ranks come from sliced running totals. "Highest number
covering a place" is answered on the end points of the intervals only: each
interval is decomposed into O(log n) dyadic blocks of end-point ranks, each
end point looks up its O(log n) enclosing blocks, and the winners are filled
forward over the events slice by slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.operators.ordered import fill_forward, minute_slice, order_key, running_totals
from parley.staging import stage

KEYS = ["event_date", "conversation_id"]
ORDER = ["time", "activity_id", "event_id"]

# Event, step and dialog names of the bot framework.
USER_MESSAGE = "BotMessageReceived"
FAILED_UTTERANCE = "FailedUtterance"
WATERFALL_COMPLETE = "WaterfallComplete"
CANCEL_INTENT = "Cancel"
INITIAL_STEP = "InitialStepAsync"
FINAL_STEP = "FinalStepAsync"
AGENT_STEP = "EstablishChatStepAsync"
MAIN_DIALOG = "MainDialog.WaterfallDialog"
PLAIN_DIALOG = "WaterfallDialog"
DISAMBIGUATION_DIALOG = "DisambiguateUserUtteranceDialog.WaterfallDialog"
SCOPE_SUFFIX = "-in"


def in_scope(events: DataFrame, suffix: str = SCOPE_SUFFIX) -> DataFrame:
    """Dated events of conversations whose id ends with ``suffix``."""
    return events.where(
        F.col("event_date").isNotNull()
        & F.col("conversation_id").isNotNull()
        & F.col("conversation_id").endswith(suffix)
    )


def is_user_message() -> Column:
    return (F.col("name") == USER_MESSAGE) & F.col("text").isNotNull()


def user_activities(events: DataFrame) -> DataFrame:
    """Activities that hold a user message."""
    return events.where(is_user_message()).select(*KEYS, "activity_id").distinct()


def user_instances(events: DataFrame) -> DataFrame:
    """Dialog instances that occur in an activity with a user message."""
    seen = events.where(F.col("instance_id").isNotNull()).select(*KEYS, "activity_id", "instance_id").distinct()
    users = user_activities(events)
    same = [seen[k] == users[k] for k in KEYS] + [seen["activity_id"].eqNullSafe(users["activity_id"])]
    return seen.join(users, same, "left_semi").select(*KEYS, "instance_id").distinct()


def marked_instances(events: DataFrame) -> DataFrame:
    """One row per started instance: first start, last start, last end."""
    place = order_key(*ORDER)
    main_start = (F.col("step_name") == INITIAL_STEP) & (F.col("dialog_id") == MAIN_DIALOG)
    # Agent hand-over starts a dialog even when its instance is not valid.
    agent_start = (F.col("step_name") == AGENT_STEP) & (F.col("dialog_id") == PLAIN_DIALOG)
    end = (
        (F.col("dialog_id") == DISAMBIGUATION_DIALOG)
        | (F.col("step_name") == FINAL_STEP)
        | (F.col("name") == WATERFALL_COMPLETE)
    )
    markers = (
        events.where(F.col("instance_id").isNotNull() & (main_start | agent_start | end))
        .groupBy(*KEYS, "instance_id")
        .agg(
            F.min(F.when(main_start, place)).alias("main_first"),
            F.max(F.when(main_start, place)).alias("main_last"),
            F.min(F.when(agent_start, place)).alias("agent_first"),
            F.max(F.when(agent_start, place)).alias("agent_last"),
            F.max(F.when(end, place)).alias("end_last"),
        )
    )
    valid = user_instances(events).withColumn("valid", F.lit(True))
    return (
        markers.join(valid, [*KEYS, "instance_id"], "left")
        .select(
            *KEYS,
            "instance_id",
            F.least(F.col("agent_first"), F.when(F.col("valid"), F.col("main_first"))).alias("first"),
            F.greatest(F.col("agent_last"), F.when(F.col("valid"), F.col("main_last"))).alias("start"),
            F.when(F.col("valid"), F.col("end_last")).alias("finish"),
        )
        .where(F.col("start").isNotNull())
    )


def numbered_dialogs(instances: DataFrame, talking: DataFrame | None = None) -> DataFrame:
    """Dialogs with their number and the interval they may cover.

    ``lo`` and ``hi`` are inclusive places (``hi`` missing: open end). Dialogs
    with ``own_only`` cover rows of their own instance and rows without one;
    such rows lose to the open tail from ``tail_lo`` on.

    With ``talking`` (conversations that have a user message), instances of
    other conversations are left out. It takes part as one marker row per
    conversation, so that a conversation with very many instances needs no
    join on its key.
    """
    rows = instances.withColumn("talks", F.lit(talking is None))
    if talking is not None:
        rows = rows.unionByName(talking.withColumn("talks", F.lit(True)), allowMissingColumns=True)
    rows = rows.withColumn("first_time", F.col("first.time"))
    started, closed = F.col("start").isNotNull(), F.col("finish").isNotNull()
    ranked = running_totals(
        rows,
        KEYS,
        ["first"],
        minute_slice(rows, "first_time"),
        {"rank": started.cast("int"), "closed_rank": closed.cast("int")},
        {"n": started.cast("int"), "n_closed": closed.cast("int")},
        {
            "in_use": F.col("talks"),
            "last": F.when(started, F.struct("first", "start")),
            "last_closed": F.when(closed, F.struct("first", "finish")),
        },
    ).where(started & F.col("in_use"))

    nowhere = F.lit(None).cast(instances.schema["start"].dataType)
    none_closed = F.col("n_closed") == 0
    is_last = F.col("rank") == F.col("n")
    tail_lo = F.col("last.start")
    as_tail = F.when(
        is_last & (none_closed | (F.col("start") > F.col("last_closed.finish"))),
        F.struct(
            F.when(none_closed, F.col("n")).otherwise(F.col("n_closed") + 1).alias("number"),
            F.col("start").alias("lo"), nowhere.alias("hi"),
            F.lit(True).alias("abandoned_left"), F.lit(False).alias("own_only"), nowhere.alias("tail_lo"),
        ),
    )
    as_closed = F.when(
        closed,
        F.struct(
            F.col("closed_rank").alias("number"), F.col("start").alias("lo"), F.col("finish").alias("hi"),
            F.lit(False).alias("abandoned_left"), F.lit(False).alias("own_only"), nowhere.alias("tail_lo"),
        ),
    )
    covering = ranked.select(
        *KEYS, "instance_id", F.explode(F.filter(F.array(as_closed, as_tail), lambda x: x.isNotNull())).alias("d")
    ).select(*KEYS, "instance_id", "d.*")

    open_only = ranked.where(none_closed)
    following = open_only.select(*KEYS, (F.col("rank") - 1).alias("rank"), F.col("start").alias("hi"))
    middle = open_only.join(following, [*KEYS, "rank"]).select(
        *KEYS, "instance_id", F.col("rank").alias("number"), F.col("start").alias("lo"), "hi",
        F.lit(True).alias("abandoned_left"), F.lit(True).alias("own_only"), tail_lo.alias("tail_lo"),
    )
    return covering.unionByName(middle).where(F.col("hi").isNull() | (F.col("lo") <= F.col("hi")))


def _dyadic_blocks(lo: str, hi: str) -> Column:
    """Canonical blocks (level, block) of the half-open rank range lo..hi."""

    return F.expr(
        f"""
        filter(
          flatten(transform(sequence(0, cast(ceil(log2(greatest({hi}, 1))) as int) + 1), j -> array(
            named_struct('level', j, 'block', shiftright({lo} + shiftleft(1L, j) - 1, j),
                         'used', shiftright({lo} + shiftleft(1L, j) - 1, j) < shiftright({hi}, j)
                                 and shiftright({lo} + shiftleft(1L, j) - 1, j) % 2 = 1),
            named_struct('level', j, 'block', shiftright({hi}, j) - 1,
                         'used', shiftright({lo} + shiftleft(1L, j) - 1, j) < shiftright({hi}, j)
                                 and shiftright({hi}, j) % 2 = 1)
          ))),
          b -> b.used)
        """
    )


def cover_changes(dialogs: DataFrame) -> DataFrame:
    """Places where the winning dialog changes, with the winner from there on.

    Returns the order columns, ``side`` (0: just before the event at that
    place, 2: just after it), ``rank``, and the winners ``any_number`` (all
    dialogs) and ``full_number`` (dialogs that cover rows of any instance).
    """
    ends = dialogs.select(
        *KEYS, "number", "own_only",
        F.explode(F.array(
            F.struct(F.col("lo").alias("place"), F.lit(0).alias("side")),
            F.struct(F.col("hi").alias("place"), F.lit(2).alias("side")),
        )).alias("end"),
    ).select(*KEYS, "number", "own_only", "end.place", "end.side", F.col("end.place.time").alias("place_time")) \
        .where(F.col("place").isNotNull())
    ranked = running_totals(
        ends, KEYS, ["place", "side", "number"], minute_slice(ends, "place_time"),
        {"rank": F.lit(1)}, {"n_ends": F.lit(1)},
    )
    ranked = stage(ranked.withColumn("rank", F.col("rank") - 1), "dialog-ends")

    intervals = ranked.groupBy(*KEYS, "number", "own_only").agg(
        F.min("rank").alias("from_rank"),
        F.coalesce(F.max(F.when(F.col("side") == 2, F.col("rank"))), F.max("n_ends")).alias("to_rank"),
    )
    blocks = (
        intervals.select(*KEYS, "number", "own_only", F.explode(_dyadic_blocks("from_rank", "to_rank")).alias("b"))
        .groupBy(*KEYS, "b.level", "b.block")
        .agg(
            F.max("number").alias("any_number"),
            F.max(F.when(~F.col("own_only"), F.col("number"))).alias("full_number"),
        )
    )
    lookups = ranked.select(
        *KEYS, "place", "side", "rank",
        F.explode(F.expr("sequence(0, cast(ceil(log2(greatest(n_ends, 1))) as int) + 1)")).alias("level"),
    ).withColumn("block", F.expr("shiftright(rank, level)"))
    return (
        lookups.join(blocks, [*KEYS, "level", "block"], "left")
        .groupBy(*KEYS, "rank")
        .agg(
            F.first("place").alias("place"), F.first("side").alias("side"),
            F.max("any_number").alias("any_number"), F.max("full_number").alias("full_number"),
        )
        .select(*KEYS, *[F.col(f"place.{c}").alias(c) for c in ORDER], "side", "rank", "any_number", "full_number")
    )


def segment_dialogs(
    events: DataFrame,
    known: DataFrame | None = None,
    keep_bounced: bool = False,
    known_keys: Sequence[str] = ("dialog",),
) -> DataFrame:
    """Dialogs with start, end and outcome flags; see the module text.

    ``events`` must be in scope and dated. ``known`` holds dialogs that were
    saved before; they are left out of the result.
    """
    instances = stage(marked_instances(events), "dialog-instances")
    talking = None if keep_bounced else user_activities(events).select(*KEYS).distinct()
    dialogs = stage(numbered_dialogs(instances, talking), "dialogs-numbered")

    changes = cover_changes(dialogs)
    rows = events.select(*KEYS, *ORDER, "instance_id", "name", "intent", "step_name").withColumns(
        {"slice": minute_slice(events, "time"), "side": F.lit(1), "rank": F.lit(0).cast("bigint")}
    )
    marks = changes.withColumn("slice", minute_slice(changes, "time"))
    filled = fill_forward(rows, marks, KEYS, ORDER, ["side", "rank"], "slice", ["any_number", "full_number"])

    flags = ["time", "name", "intent", "step_name"]
    by_place = filled.select(
        *KEYS, *flags,
        F.when(F.col("instance_id").isNull(), F.col("any_number")).otherwise(F.col("full_number")).alias("number"),
    ).where(F.col("number").isNotNull())

    own = dialogs.where(F.col("own_only")).select(*KEYS, "instance_id", "number", "lo", "hi", "tail_lo")
    place = order_key(*ORDER)
    by_instance = (
        events.where(F.col("instance_id").isNotNull())
        .select(*KEYS, "instance_id", *flags, place.alias("place"))
        .join(own, [*KEYS, "instance_id"])
        .where(F.col("place").between(F.col("lo"), F.col("hi")) & (F.col("place") < F.col("tail_lo")))
        .select(*KEYS, *flags, "number")
    )

    outcomes = by_place.unionByName(by_instance).groupBy(*KEYS, "number").agg(
        F.min("time").alias("start_time"),
        F.max("time").alias("end_time"),
        F.coalesce(F.max(F.col("intent") == CANCEL_INTENT), F.lit(False)).alias("cancelled"),
        F.coalesce(F.max(F.col("name") == FAILED_UTTERANCE), F.lit(False)).alias("failed"),
        F.coalesce(F.max(F.col("step_name") == AGENT_STEP), F.lit(False)).alias("agent"),
    )
    out = outcomes.join(dialogs.select(*KEYS, "number", "instance_id", "abandoned_left"), [*KEYS, "number"]).select(
        "event_date",
        F.concat(F.lit("D"), F.col("number").cast("string"), F.lit("|"), F.col("instance_id")).alias("dialog"),
        "conversation_id", "start_time", "end_time", "abandoned_left", "cancelled", "failed", "agent",
    )
    return new_dialogs(out, known, known_keys) if known is not None else out


def new_dialogs(dialogs: DataFrame, known: DataFrame, keys: Sequence[str] = ("dialog",)) -> DataFrame:
    """Dialogs that ``known`` does not hold yet."""
    return dialogs.join(known.select(*keys).distinct(), list(keys), "left_anti")


def daily_kpis(dialogs: DataFrame) -> DataFrame:
    """Resolution, failure and fallback figures per day of dialog start."""
    left, cancelled, agent, failed = (F.col(c) for c in ("abandoned_left", "cancelled", "agent", "failed"))
    counts = dialogs.groupBy(F.to_date("start_time").alias("date")).agg(
        F.count_distinct("conversation_id").alias("total_conversations"),
        F.count(F.lit(1)).alias("total_dialogs"),
        F.count_if((left | cancelled) & ~agent).alias("abandoned_dialogs"),
        F.count_if(failed).alias("failed_dialogs"),
        F.count_if(agent & ~cancelled).alias("agent_dialogs"),
        F.count_if(agent & ~cancelled & left).alias("open_agent_dialogs"),
        F.count_if(agent & ~cancelled & ~left).alias("closed_agent_dialogs"),
    )
    with_fcr = counts.withColumn(
        "fcr_dialogs",
        F.col("total_dialogs") - (F.col("abandoned_dialogs") + F.col("failed_dialogs") + F.col("agent_dialogs")),
    )
    kept = F.col("total_dialogs") - F.col("abandoned_dialogs")

    def share(column: str) -> Column:
        return F.round(F.try_divide(F.col(column), kept) * F.lit(100.0), 2)

    return with_fcr.withColumns(
        {"fcr_pct": share("fcr_dialogs"), "failed_pct": share("failed_dialogs"), "fbr_pct": share("agent_dialogs")}
    )


def bounce_stats(events: DataFrame, dialogs: DataFrame | None = None) -> DataFrame:
    """Conversations per day: all, without any user message, and with dialogs."""
    per_conversation = events.groupBy(*KEYS).agg(
        F.coalesce(F.max(is_user_message()), F.lit(False)).alias("talking")
    )
    sums = [
        F.count(F.lit(1)).alias("conversations"),
        F.count_if(~F.col("talking")).alias("bounced"),
    ]
    if dialogs is not None:
        with_dialogs = dialogs.select(*KEYS).distinct().withColumn("saved", F.lit(True))
        per_conversation = per_conversation.join(with_dialogs, KEYS, "left")
        sums.append(F.count_if(F.coalesce(F.col("saved"), F.lit(False))).alias("saved"))
    return per_conversation.groupBy("event_date").agg(*sums)
