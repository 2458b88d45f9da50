"""Jobs end to end, and properties of the physical plans."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

import random_events as gen
from parley.operators import dialogs as d
from parley.operators import gold
from parley.operators import utterances as u
from parley.operators.latest import newest_per_key
from parley.operators.upsert import upsert
from parley.plans import bot_reports, catalog_bot, gold_refresh
from parley.sources import tables
from parley.staging import stage, staging_path

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", 1000)
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 10000)
    return df._jdf.queryExecution().executedPlan().toString()


def _silver(spark, rows):
    return spark.createDataFrame(
        rows, "time string, UserId string, ClientType string, AppRoleName string, ItemCount int, Properties map<string,string>"
    )


def test_gold_refresh(spark):
    channels, types = staging_path(spark, "channels"), staging_path(spark, "types")
    row = lambda user, client, role, day="01", n=1: (
        f"2024-01-{day}T10:00:00.1234567Z", user, client, role, n, {"activityType": "message"}
    )
    first = _silver(spark, [row("u1", "PC", "a", n=2), row("u1", "PC", "b"), row("u2", None, "a"), (None, "u9", "PC", "a", 1, {})])
    assert gold_refresh.refresh_user_channels(first, channels) == 0
    got = {(str(r.date), r.user_id, r.activity_type, r.interactions, tuple(r.communication_channel)) for r in tables.read_version(spark, channels).collect()}
    assert got == {("2024-01-01", "u1", "message", 3.0, ("a", "b")), ("2024-01-01", "u2", "message", 1.0, ("a",))}
    assert all(r.success and r.evaluated == 2 for r in gold_refresh.channel_report(spark, channels).collect())

    gold_refresh.refresh_client_types(first, types)
    second = _silver(spark, [row("u1", "PC", "a"), row("u3", "PC", "a"), row("u2", None, "a"), row("u2", "TV", "a", day="02")])
    gold_refresh.refresh_client_types(second, types)
    changes = {(str(r.date), r.client_type, r.user_base, r._change_type) for r in gold_refresh.client_type_changes(spark, types, 0, 1).collect()}
    assert changes == {
        ("2024-01-01", "PC", 1, "update_preimage"), ("2024-01-01", "PC", 2, "update_postimage"),
        ("2024-01-01", None, 1, "update_preimage"), ("2024-01-01", None, 1, "update_postimage"),
        ("2024-01-02", "TV", 1, "insert"),
    }
    # The missing client type matched; it was not inserted again.
    assert tables.read_version(spark, types).count() == 3


def test_bot_reports_are_incremental(spark):
    rows = gen.conversations(seed=21, count=60, max_size=20, utterances=False)
    events = gen.frame(spark, rows)
    path = staging_path(spark, "dialogs")
    day = lambda n: bot_reports.events_of(events, "", dt.date(2024, 3, n), dt.date(2024, 3, n + 1))
    one = bot_reports.save_dialogs(spark, day(1), path).count()
    assert one > 0
    assert bot_reports.save_dialogs(spark, day(1), path).count() == 0
    two = bot_reports.save_dialogs(spark, day(2), path).count()
    assert tables.read_appended(spark, path).count() == one + two
    summary = bot_reports.dialog_summary(spark, path, dt.date(2024, 3, 1), dt.date(2024, 3, 1))
    assert [r.total_dialogs for r in summary.collect()] == [one]
    assert "PartitionFilters: [isnotnull(event_date" in summary._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    scored = staging_path(spark, "scored")
    first = bot_reports.save_utterances(spark, day(1), scored).count()
    assert first > 0 and bot_reports.save_utterances(spark, day(1), scored).count() == 0
    second = bot_reports.save_utterances(spark, day(2), scored).count()
    assert spark.read.parquet(scored).count() == first + second


def test_kpis_of_a_day_where_all_left(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), "c", True, False, False, False)],
        "start_time timestamp_ntz, conversation_id string, abandoned_left boolean, cancelled boolean, failed boolean, agent boolean",
    )
    r = d.daily_kpis(df).head()
    assert (r.total_dialogs, r.abandoned_dialogs, r.fcr_dialogs, r.fcr_pct, r.fbr_pct) == (1, 1, 0, None, None)


@pytest.fixture(scope="module")
def events(spark):
    rows = gen.conversations(seed=5, count=50, max_size=20, utterances=True)
    return stage(d.in_scope(gen.frame(spark, rows)), "events")


def _plans(spark, events):
    scored = stage(u.drop_fillers(u.raw_scores(u.resolve_intents(events))), "scored")
    instances = stage(d.marked_instances(events), "instances")
    talking = d.user_activities(events).select(*d.KEYS).distinct()
    merged = u.absorb_agent_request(u.absorb_agent_confirmation(u.absorb_brand_choice(u.with_runs(scored))))
    return {
        "instances": d.marked_instances(events),
        "numbered": d.numbered_dialogs(instances, talking),
        "segments": d.segment_dialogs(events),
        "intents": u.raw_scores(u.resolve_intents(events)),
        "merged": merged,
        "spans": u.remove_agent_spans(stage(merged, "merged")),
        "newest": newest_per_key(events, ["activity_id"], ["time", "event_id"]),
        "upsert": upsert(events, events, ["activity_id"], ["time", "event_id"]),
    }


def test_plans_have_no_python_and_no_cross_join(spark, events):
    for name, df in _plans(spark, events).items():
        plan = _plan(df)
        for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
            assert node not in plan, f"{name}: {node}"


def test_no_window_gathers_the_rows_of_a_conversation(spark, events):
    """Windows keyed by the conversation alone only run over one row per slice."""
    checked = 0
    for name, df in _plans(spark, events).items():
        lines = _plan(df).splitlines()
        for i, line in enumerate(lines):
            if not re.search(r"[\s-]Window \[", line):
                continue
            for spec in re.findall(r"windowspecdefinition\((.*?)specifiedwindowframe", line):
                if not re.search(r"\b(__slice|slice|run)#", spec):
                    below = " ".join(lines[i + 1 : i + 9])
                    assert re.search(r"Aggregate\(keys?=\[[^\]]*slice#", below), f"{name}: {line}"
                checked += 1
    assert checked > 20


def test_pruning_reaches_the_scan(spark, events):
    plan = _plan(u.user_activity_order(events))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "intent_score" not in schema and "dialog_id" not in schema
    assert "PushedFilters: [IsNotNull(activity_id)" in plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_one_shuffle_of_events_for_intents(spark):
    events = stage(catalog_bot.scoped(spark, SF), "events")
    assert _plan(u.resolve_intents(events)).count("Exchange hashpartitioning") == 1
    assert _plan(newest_per_key(events, ["activity_id"], ["time"], "drop")).count("Exchange hashpartitioning") == 1


def test_a_hot_conversation_is_spread(spark):
    """Rows of one conversation-day end up in many (group, slice) parts."""
    df = spark.range(50_000).select(
        F.lit("c").alias("conversation_id"), F.lit(dt.date(2024, 1, 1)).alias("event_date"),
        F.col("id").alias("event_id"), F.lit(None).cast("string").alias("activity_id"),
        F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("time"),
    )
    from parley.operators.ordered import minute_slice, position

    assert df.groupBy(minute_slice(df, "time")).count().agg(F.max("count")).head()[0] == 60
    wrong = position(df, d.KEYS, d.ORDER, minute_slice(df, "time")).where("pos <> event_id").count()
    assert wrong == 0


def test_client_types_read_their_input_once(spark):
    path = staging_path(spark, "app")
    spark.range(100).selectExpr("date_add(current_date(), cast(id % 3 as int)) AS date", "id % 7 AS client_type", "id % 11 AS user_id").write.parquet(path)
    out = gold.client_type_distribution(spark.read.parquet(path))
    assert _plan(out).count("FileScan") == 1
    assert {r.total_users for r in out.collect()} == {11}


def test_short_runs_go_through_the_passes_in_one_shuffle(spark):
    rows = gen.conversations(seed=11, count=50, max_size=90, utterances=True, sticky=True)
    numbered = u.prepared_utterances(d.in_scope(gen.frame(spark, rows)))
    merged = u.merge_passes(numbered)
    plan = _plan(merged)
    assert plan.count("Exchange hashpartitioning") == 1 and len(re.findall(r"[\s-]Window \[", plan)) == 2 * len(u.PASSES)
