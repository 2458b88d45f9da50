"""Stores that replace only what a delivery touches: buckets and groups."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import random_events as gen
from parley.operators import dialogs as d
from parley.plans import bot_reports
from parley.schemas import STORED_EVENT
from parley.sources.bucket_table import BucketTable
from parley.staging import stage, staging_path
from parley.streaming import ingest

SCHEMA = "k long, t int, v string"


def _plan(df):
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", 1000)
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 10000)
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def _table(spark, buckets=8):
    return BucketTable(spark, staging_path(spark, "bucket-test"), spark.createDataFrame([], SCHEMA).schema, ["k"], ["t"], buckets)


def test_merge_counts_and_rows(spark):
    table = _table(spark)
    table.merge(spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (3, 5, "d"), (None, 1, "x")], SCHEMA))
    # Newer, older, equal and new keys; a second row without key.
    table.merge(spark.createDataFrame([(1, 3, "e"), (2, 0, "f"), (3, 5, "d"), (4, 1, "g"), (None, 1, "x")], SCHEMA))
    assert _rows(table.read(), "k", "t", "v") == sorted(
        [(1, 3, "e"), (2, 1, "c"), (3, 5, "d"), (4, 1, "g"), (None, 1, "x"), (None, 1, "x")], key=str)
    told = {r.version: r for r in table.metrics().collect()}
    assert (told[0].inserted, told[0].updated, told[0].keyless) == (3, 0, 1)
    assert (told[1].inserted, told[1].updated, told[1].unchanged, told[1].copied, told[1].keyless) == (1, 1, 2, 0, 1)
    assert _rows(table.read(upto=0), "k", "v") == sorted([(1, "b"), (2, "c"), (3, "d"), (None, "x")], key=str)
    feed = _rows(table.change_feed(0), "k", "v", "_change_type")
    assert feed == sorted([(1, "b", "update_preimage"), (1, "e", "update_postimage"), (4, "g", "insert"), (None, "x", "insert")], key=str)


def test_unguarded_merge_takes_older_rows(spark):
    table = _table(spark)
    table.merge(spark.createDataFrame([(1, 2, "b")], SCHEMA))
    table.merge(spark.createDataFrame([(1, 1, "a")], SCHEMA), guard=False)
    assert _rows(table.read(), "k", "t", "v") == [(1, 1, "a")]


def test_merge_moves_changes_only(spark):
    table = _table(spark, 16)
    table.merge(spark.range(5000).selectExpr("id AS k", "1 AS t", "'a' AS v"))
    changes = spark.createDataFrame([(7, 2, "b")], SCHEMA).withColumn("_bucket", table.bucket_of())
    touched = [r[0] for r in changes.select("_bucket").collect()]
    plan = _plan(table.joined(changes, touched))
    # One exchange, of the changes; the base is read in its buckets, and only in the touched one.
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert f"({touched[0]})" in scan or f"= {touched[0]})" in scan or f"IN ({touched[0]})" in scan
    version = table.merge(spark.createDataFrame([(7, 2, "b"), (8, 2, "c")], SCHEMA))
    told = table.metrics().where(F.col("version") == version).first()
    assert told.buckets_written <= 2 and told.updated == 2 and told.copied < 5000 // 4
    feed = table.change_feed(version - 1, version)
    assert "Exchange" not in _plan(feed) and feed.count() == 4


def test_untouched_buckets_are_not_rewritten(spark):
    table = _table(spark, 16)
    table.merge(spark.range(500).selectExpr("id AS k", "1 AS t", "'a' AS v"))
    before = table.generations()
    table.merge(spark.createDataFrame([(7, 2, "b")], SCHEMA))
    after = table.generations()
    assert sum(before[b] != after[b] for b in before) == 1


def test_failed_merge_leaves_no_trace(spark):
    table = _table(spark)
    table.merge(spark.createDataFrame([(1, 1, "a")], SCHEMA))
    # A merge that stops after its data: a number is taken and files are there, but nothing is committed.
    spark.range(1).write.parquet(f"{table.root}/attempts/version=1")
    lost = spark.createDataFrame([(1, 9, "lost")], SCHEMA).withColumns({"_bucket": table.bucket_of(), "_generation": F.lit(1).cast("bigint")})
    lost.write.mode("append").insertInto(table.name)
    assert _rows(table.read(), "v") == [("a",)]
    assert table.merge(spark.createDataFrame([(1, 2, "b")], SCHEMA)) == 2
    assert _rows(table.read(), "v") == [("b",)]


def test_another_session_finds_the_table(spark):
    table = _table(spark)
    table.merge(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], SCHEMA))
    spark.sql(f"DROP TABLE {table.name}")
    again = BucketTable(spark, table.root, table.schema, ["k"], ["t"], table.buckets)
    assert _rows(again.read(), "k", "v") == [(1, "a"), (2, "b")]
    again.compact()
    assert set(again.generations().values()) == {1} and _rows(again.read(), "k", "v") == [(1, "a"), (2, "b")]


def test_merge_of_an_empty_batch(spark):
    table = _table(spark)
    table.merge(spark.createDataFrame([], SCHEMA))
    assert table.read().count() == 0
    table.merge(spark.createDataFrame([(1, 1, "a")], SCHEMA))
    table.merge(spark.createDataFrame([], SCHEMA))
    assert table.read().count() == 1 and table.change_feed(1).count() == 0


def test_feed_of_change_folders(spark):
    root = staging_path(spark, "feed-test")
    deliveries = [[(1, 1, "a"), (2, 1, "b"), (None, 1, "x")], [(1, 2, "c"), (3, 1, "d")], [(1, 1, "old"), (3, 2, "e"), (None, 1, "x")]]
    for number, rows in enumerate(deliveries):
        ingest.apply_batch(spark.createDataFrame(rows, SCHEMA), number, root, ["k"], ["t"])

    def feed(after, upto, guard=True):
        return _rows(ingest.change_feed(spark, root, ["k"], ["t"], after, upto, guard), "k", "v", "_change_type")

    assert feed(0, 1) == sorted([(1, "a", "update_preimage"), (1, "c", "update_postimage"), (3, "d", "insert")], key=str)
    assert feed(1, 2) == sorted([(3, "d", "update_preimage"), (3, "e", "update_postimage"), (None, "x", "insert")], key=str)
    assert (1, "old", "update_postimage") in feed(1, 2, guard=False)
    assert feed(-1, 2) == sorted([(1, "c", "insert"), (2, "b", "insert"), (3, "e", "insert"), (None, "x", "insert"), (None, "x", "insert")], key=str)
    ingest.compact(spark, root, ["k"], ["t"], 1)
    assert feed(1, 2) == sorted([(3, "d", "update_preimage"), (3, "e", "update_postimage"), (None, "x", "insert")], key=str)
    with pytest.raises(ValueError):
        feed(0, 2)


# --- groups ---------------------------------------------------------------


def _stored(df):
    return df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in STORED_EVENT.fields])


def _dialogs(df):
    return _rows(df, "event_date", "dialog", "conversation_id", "start_time", "end_time", "abandoned_left", "cancelled", "failed", "agent")


def test_late_events_recompute_their_groups(spark):
    events = _stored(gen.frame(spark, gen.conversations(seed=5, count=40, max_size=25, utterances=False))).cache()
    late = F.pmod(F.xxhash64("event_id"), F.lit(4)) == 0
    part = F.pmod(F.xxhash64("conversation_id"), F.lit(3)) == 0
    store = bot_reports.dialog_store(spark, staging_path(spark, "late"))
    bot_reports.deliver_dialogs(store, events.where(~(late & part)))
    before = {(r.event_date, r.conversation_id) for r in store.read().collect()}
    number = bot_reports.deliver_dialogs(store, events.where(late & part))
    assert _dialogs(store.read()) == _dialogs(d.segment_dialogs(d.in_scope(events)))
    touched = {(r.event_date, r.conversation_id) for r in d.in_scope(events.where(late & part)).select(*d.KEYS).distinct().collect()}
    kept = {(r.event_date, r.conversation_id) for r in store.read().where("batch_id = 0").collect()}
    assert kept <= before and not kept & touched
    # The same delivery again, under its number and as another one, changes nothing.
    bot_reports.deliver_dialogs(store, events.where(late & part), number)
    assert store.deliveries() == [0, 1]
    bot_reports.deliver_dialogs(store, events.where(late & part))
    assert _dialogs(store.read()) == _dialogs(d.segment_dialogs(d.in_scope(events)))
    # As of the first delivery, and after compaction.
    assert _dialogs(store.read(upto=0)) == _dialogs(d.segment_dialogs(d.in_scope(events.where(~(late & part)))))
    expected = _dialogs(store.read())
    store.compact(1)
    assert _dialogs(store.read()) == expected
    store.compact(2)
    assert _dialogs(store.read()) == expected


def test_delivery_reads_touched_days_only(spark):
    events = _stored(gen.frame(spark, gen.conversations(seed=6, count=30, max_size=10, utterances=False)))
    store = bot_reports.dialog_store(spark, staging_path(spark, "late-plan"))
    bot_reports.deliver_dialogs(store, events)
    day = events.select(F.max("event_date")).first()[0]
    touched = d.in_scope(events.where(F.col("event_date") == F.lit(day))).select(*d.KEYS).distinct()
    plan = _plan(store.affected(touched, 0))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "source" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*" + str((day - dt.date(1970, 1, 1)).days), scan) or str(day) in scan


def test_group_without_results_loses_its_rows(spark):
    from parley.sources.group_store import GroupStore

    source = spark.createDataFrame([], "day date, g string, id long, v int").schema
    result = spark.createDataFrame([], "day date, g string, total long").schema
    store = GroupStore(spark, staging_path(spark, "groups"), ["day", "g"], source, result, ["id"])
    sums = lambda rows: rows.groupBy("day", "g").agg(F.sum("v").alias("total")).where("total > 0")
    row = lambda i, g, v: (dt.date(2024, 1, 1), g, i, v)
    store.deliver(spark.createDataFrame([row(1, "a", 5), row(2, "b", 7), row(None, "b", 1), (None, "a", 9, 9)], source), sums)
    assert _rows(store.read(), "g", "total") == [("a", 5), ("b", 8)]
    store.deliver(spark.createDataFrame([row(3, "a", -5)], source), sums)
    assert _rows(store.read(), "g", "total") == [("b", 8)]
    store.deliver(spark.createDataFrame([], source), sums)
    assert _rows(store.read(), "g", "total") == [("b", 8)] and _rows(store.read(upto=0), "g", "total") == [("a", 5), ("b", 8)]


def test_rows_delivered_once_are_not_shuffled(spark):
    """Only keys are counted; the rows themselves are reduced where a key repeats."""
    events = _stored(gen.frame(spark, gen.conversations(seed=8, count=30, max_size=10, utterances=False)))
    store = bot_reports.dialog_store(spark, staging_path(spark, "late-once"))
    bot_reports.deliver_dialogs(store, events)
    touched = d.in_scope(events).select(*d.KEYS).distinct()
    once = store.affected(touched, 0)
    assert once.count() == d.in_scope(events).count()
    assert "max_by" not in _plan(once) and "SortAggregate" not in _plan(once)
    assert "text" not in re.search(r"ReadSchema: struct<([^>]*)>", _plan(once.select("name"))).group(1)


@pytest.mark.parametrize("many", [0, 1 << 18])
def test_newest_of_repeated_keeps_the_rows_of_newest_per_key(spark, monkeypatch, many):
    from parley.operators import latest

    monkeypatch.setattr(latest, "MANY_REPEATED", many)
    rows = [(1, 1, "a"), (1, 2, "b"), (2, 5, "c"), (3, 1, "d"), (3, 1, "d"), (4, None, "e"), (4, 0, "f"), (None, 1, "x"), (None, 1, "x"), (None, 2, "y")]
    for some in (rows, rows[2:3] + rows[7:], []):
        df = stage(spark.createDataFrame(some, SCHEMA), "repeated-test")
        out = latest.newest_of_repeated(df, ["k"], ["t"])
        assert out.columns == df.columns
        assert _rows(out, "k", "t", "v") == _rows(latest.newest_per_key(df, ["k"], ["t"]), "k", "t", "v")
