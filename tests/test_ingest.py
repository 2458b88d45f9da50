"""Hourly batch ingest, streaming ingest, listener: end to end on small files."""

import datetime as dt
import json
import os
import tempfile
import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from parley.operators import dialogs, logs, utterances
from parley.operators.upsert import table_diff
from parley.plans import hourly_ingest as h
from parley.schemas import EVENT_HINTS, PROGRESS_LOG, RAW_EVENT
from parley.sources import jsonlines, tables
from parley.sources.bot_events import bot_events_from_raw
from parley.streaming import ingest
from parley.streaming.listener import ProgressLog


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines) + "\n")


def _event(op, time_, **more):
    return {"time": time_, "OperationId": op, "Name": "E", "_BilledSize": 1, "Properties": {"k": "a=1, b=2"}, **more}


def test_hourly_ingest(spark):
    root = tempfile.mkdtemp()
    source, table, audit, rejects = (f"{root}/{x}" for x in ("source", "bronze", "audit", "rejects"))
    one = _event("1", "2022-11-10T02:10:00.0000000Z", Measurements={"m": 1.5})
    two = _event("2", "2022-11-10T02:20:00.0000000Z")
    _write(f"{source}/y=2022/m=11/d=10/h=02/m=00", "a.json", [one, one, "not json", '{"time": "cut'])
    _write(f"{source}/y=2022/m=11/d=10/h=02/m=00", "b.json", [one, two])
    _write(f"{source}/y=2022/m=11/d=10/h=03/m=00", "c.json", [one])
    fields = ["time", "OperationId", "Properties", "Measurements", "NewField"]

    run = lambda a, b: h.run_hourly_ingest(
        spark, source, table, audit, rejects, fields, dt.datetime(2022, 11, 10, a), dt.datetime(2022, 11, 10, b)
    )
    assert run(1, 2) == 0
    rows = h.read_bronze(spark, table).collect()
    assert sorted(r.OperationId for r in rows) == ["1", "2"]
    assert {str(r.partition_key) for r in rows} == {"202211100200"}
    first = next(r for r in rows if r.OperationId == "1")
    assert first.Properties == {"k": "a=1, b=2"} and first.Measurements == {"m": "1.5"} and first.NewField is None
    assert sorted(r.value for r in tables.read_appended(spark, rejects).collect()) == ["not json", '{"time": "cut']

    logged = tables.read_appended(spark, audit).collect()
    assert {r.file_name for r in logged} == {"a.json", "b.json"}
    assert {(r.source_folder, r.total_records_read, r.version, r.operation) for r in logged} == {("2022-11-10:02", 6, 0, "CREATE")}
    assert logged[0].operation_metrics == {"numOutputRows": "2"}

    # The watermark continues after the last logged hour; repeats change nothing.
    start, end = h.next_window(spark, audit, dt.datetime(2022, 11, 10, 4, 30))
    assert (start, end) == (dt.datetime(2022, 11, 10, 2), dt.datetime(2022, 11, 10, 3))
    assert run(start.hour, end.hour) == 1
    assert run(1, 3) == 2
    assert h.read_bronze(spark, table).count() == 3
    assert run(10, 11) is None
    start, _ = h.next_window(spark, f"{root}/nothing", dt.datetime(2022, 11, 10, 4, 30))
    assert start == dt.datetime(2022, 11, 10, 2)


def test_merges_tell_what_they_inserted(spark, tmp_path):
    source, table, audit, rejects = (f"{tmp_path}/{x}" for x in ("source", "bronze", "audit", "rejects"))
    folder = f"{source}/y=2022/m=11/d=10/h="
    _write(f"{folder}02/m=00", "a.json", [_event("1", "t"), _event("2", "t"), "bad"])
    run = lambda a, b: h.run_hourly_ingest(
        spark, source, table, audit, rejects, ["OperationId"], dt.datetime(2022, 11, 10, a), dt.datetime(2022, 11, 10, b))
    run(1, 2)
    # Two lines of a read hour are new beside the two known ones; a later hour holds a line of the same text, which is another key.
    _write(f"{folder}02/m=00", "b.json", [_event("3", "t"), _event("4", "t")])
    _write(f"{folder}03/m=00", "c.json", [_event("1", "t")])
    run(1, 3)
    told = {r.version: r.operation_metrics for r in tables.read_appended(spark, audit).collect()}
    assert told == {0: {"numOutputRows": "2"}, 1: {"numOutputRows": "5", "numTargetRowsInserted": "3", "numTargetRowsUpdated": "2"}}


def test_undeclared_fields_are_kept(spark, tmp_path):
    one, two = _event("1", "2022-11-10T02:10:00Z"), _event("2", "2022-11-10T02:10:00Z", Fresh={"deep": 1}, Other="o")
    _write(f"{tmp_path}/y=2022/m=11/d=10/h=02/m=00", "a.json", [one, two, "", "[broken"])
    rows = {r.OperationId: r for r in jsonlines.read_events(spark, str(tmp_path), RAW_EVENT).collect()}
    assert rows["1"]._rescued_data is None and json.loads(rows["2"]._rescued_data) == {"Fresh": '{"deep":1}', "Other": "o"}
    assert rows[None]._rescued_data == "[broken" and len(rows) == 3
    store = f"{tmp_path}-schemas"
    first = jsonlines.stored_schema(spark, str(tmp_path), store, EVENT_HINTS)
    _write(f"{tmp_path}/y=2022/m=11/d=10/h=03/m=00", "b.json", [_event("3", "2022-11-10T03:10:00Z", Newest=1)])
    second = jsonlines.stored_schema(spark, str(tmp_path), store, EVENT_HINTS)
    assert second.fields[: len(first.fields)] == first.fields and second.fieldNames()[-1] == "Newest"
    assert jsonlines.stored_schema(spark, str(tmp_path), store, EVENT_HINTS) == second and tables.versions(spark, store) == [0, 1]


@pytest.mark.parametrize("fails_at", [1, 2, 3])
def test_hourly_ingest_repeats_after_a_failure(spark, tmp_path, monkeypatch, fails_at):
    """The run fails after each of its writes; the next one leaves no doubled rows."""
    source, table, audit, rejects = (f"{tmp_path}/{x}" for x in ("source", "bronze", "audit", "rejects"))
    _write(f"{source}/y=2022/m=11/d=10/h=02/m=00", "a.json", [_event("1", "2022-11-10T02:10:00Z"), "bad"])
    run = lambda: h.run_hourly_ingest(
        spark, source, table, audit, rejects, ["time", "OperationId"], dt.datetime(2022, 11, 10, 1), dt.datetime(2022, 11, 10, 2))
    write, written = DataFrameWriter.parquet, []

    def failing(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        if "batch_id=" in path:
            written.append(path)
            if len(written) == fails_at:
                raise OSError("lost")

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(OSError):
        run()
    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    run()
    assert h.read_bronze(spark, table).count() == 1
    # A failure after the last write leaves a complete load; repeating it is a second load of the same lines.
    loads = 2 if fails_at == 3 else 1
    assert spark.read.parquet(rejects).count() == spark.read.parquet(audit).count() == loads
    assert tables.versions(spark, audit, "batch_id") == list(range(loads))


def test_figures_cover_more_batches_than_the_query_keeps(spark, tmp_path):
    root, source = f"{tmp_path}/root", f"{tmp_path}/source"
    for i in range(105):
        _write(source, f"{i}.json", [_event(str(i), "2022-11-10T02:10:00Z"), "bad"][: 1 + i % 2])
    stream = jsonlines.stream_events(spark, source, RAW_EVENT, max_files_per_trigger=1)
    ingest.start_upsert(stream, root, ["OperationId"], ["time"]).awaitTermination()
    told = ingest.read_figures(spark, root).groupBy().sum("cnt", "malformed").first()
    assert tuple(told) == (157, 52)
    history = ingest.history(spark, root)
    assert history.count() == 105 and history.groupBy().sum("rows_written", "files_read").first()[:] == (157, 105)


def test_stream_upsert_late_rows_restart_and_rejects(spark):
    root, source = tempfile.mkdtemp(), tempfile.mkdtemp()
    day = f"{source}/10/05"
    _write(day, "a.json", [
        _event("1", "2022-11-10T02:00:00Z", ItemCount=1), _event("1", "2022-11-10T03:00:00Z", ItemCount=2),
        _event(None, "2022-11-10T02:00:00Z"), _event(None, "2022-11-10T02:00:01Z"),
        "oops", _event("3", "2022-11-10T02:00:00Z", _BilledSize="big"),
    ])

    def run():
        stream = ingest.observed(jsonlines.stream_events(spark, source, RAW_EVENT))
        query = ingest.start_upsert(stream, root, ["OperationId"], ["time"], query_name="demo")
        query.awaitTermination()
        return query

    first = run()
    seen = [p.observedMetrics["metric"] for p in first.recentProgress if "metric" in p.observedMetrics]
    assert sum(m["cnt"] for m in seen) == 6 and sum(m["malformed"] for m in seen) == 2
    assert tuple(ingest.read_figures(spark, root).groupBy().sum("cnt", "malformed").first()) == (6, 2)
    read = lambda **kw: {
        (r.OperationId, r.time, r.ItemCount) for r in ingest.read_current(spark, root, ["OperationId"], ["time"], **kw).collect()
    }
    assert ("1", "2022-11-10T03:00:00Z", 2) in read() and len(read()) == 5  # "oops" has no key either

    # A late file must not take the row back, unless last-write-wins is asked for.
    _write(day, "b.json", [_event("1", "2022-11-10T01:00:00Z", ItemCount=9), _event("2", "2022-11-10T01:00:00Z")])
    run()
    assert ("1", "2022-11-10T03:00:00Z", 2) in read() and ("1", "2022-11-10T01:00:00Z", 9) in read(guard=False)
    assert read(upto=0) == read() - {("2", "2022-11-10T01:00:00Z", None)}
    changes = table_diff(
        ingest.read_current(spark, root, ["OperationId"], ["time"], upto=0, null_keys="drop").drop("batch_id"),
        ingest.read_current(spark, root, ["OperationId"], ["time"], upto=1, null_keys="drop").drop("batch_id"),
        ["OperationId"],
    )
    assert [(r.OperationId, r._change_type) for r in changes.collect()] == [("2", "insert")]

    # Replaying a batch and compacting leave the table as it is.
    before = read()
    batch = jsonlines.read_events(spark, f"{day}/b.json", RAW_EVENT).withColumn("row_created_metadata", F.col("_metadata"))
    ingest.apply_batch(batch, 1, root, ["OperationId"], ["time"])
    assert read() == before
    ingest.compact(spark, root, ["OperationId"], ["time"], upto=0, cluster_column="time", partitions=2)
    assert read() == before
    ingest.compact(spark, root, ["OperationId"], ["time"], upto=1)
    assert read() == before
    assert run().recentProgress is not None and read() == before

    audit = spark.read.parquet(f"{root}/audit").collect()
    assert {(r.file_name, r.ingest_id) for r in audit} == {("a.json", 0), ("b.json", 1)}


def test_listener_log_is_parsed(spark):
    folder, source, root = (tempfile.mkdtemp() for _ in range(3))
    folder = f"{folder}/log"
    _write(source, "a.json", [_event("1", "2022-11-10T02:00:00Z")])
    listener = ProgressLog(spark, folder)
    spark.streams.addListener(listener)
    try:
        stream = jsonlines.stream_events(spark, source, RAW_EVENT)
        query = ingest.start_upsert(stream, root, ["OperationId"], ["time"], query_name="logged")
        query.awaitTermination()
        for _ in range(100):
            if os.path.isdir(folder) and any(f.startswith("part") for f in os.listdir(folder)):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    rows = logs.parse_progress(
        (raw := spark.read.schema(PROGRESS_LOG).json(folder).select("*", "_metadata")), raw["_metadata.file_path"]
    ).collect()
    status = [r.status for r in rows]
    assert {"STREAM_STARTED", "STREAM_UPDATED", "STREAM_TERMINATED"} <= set(status)
    assert {r.stream_id for r in rows} == {str(query.id)}
    updated = next(r for r in rows if r.status == "STREAM_UPDATED" and r.batch_id == 0)
    assert updated.num_input_rows == 1 and updated.trigger_execution_ms > 0 and updated.stream_name == "logged"
    assert all(r.source_file for r in rows)


def test_raw_lines_to_dialogs_and_utterances(spark):
    source = tempfile.mkdtemp()
    say = lambda at, name, role="TDL.Chatbot.Master", **p: {
        "time": f"2022-11-10T02:00:{at:02d}.1234567Z", "Name": name, "AppRoleName": role,
        "Properties": {"conversationId": "c1-in", "activityId": "a1", **p},
    }
    _write(source, "a.json", [
        say(1, "BotMessageReceived", text="Where is my order?"),
        say(2, "WaterfallStep", InstanceId="i1", StepName="InitialStepAsync", DialogId="MainDialog.WaterfallDialog"),
        say(3, "LuisResult", "TCP.Chatbot.Shop", intent="TrackOrder", intentScore="0.9"),
        say(4, "WaterfallComplete", InstanceId="i1"),
        {"time": "2022-11-10T05:00:00Z", "Name": "Heartbeat", "Properties": {"EventName": "x"}},
    ])
    schema = jsonlines.infer_schema(spark, source, EVENT_HINTS)
    events = dialogs.in_scope(bot_events_from_raw(spark.read.schema(schema).json(source)))
    d = dialogs.segment_dialogs(events).collect()
    assert [(r.dialog, r.abandoned_left, r.failed, r.agent) for r in d] == [("D1|i1", False, False, False)]
    assert (d[0].start_time.second, d[0].end_time.second) == (2, 4)
    known = spark.createDataFrame([("D1|i1",)], "dialog string")
    assert dialogs.segment_dialogs(events, known=known).count() == 0
    s = utterances.score_utterances(events).collect()
    assert [(r.text, r.intent, r.master_score, r.child_score, r.final_score) for r in s] == [
        ("Where is my order?", "TrackOrder", 0.5, 0.5, 1.0)
    ]
    stored = spark.createDataFrame([("a1",)], "activity_id string")
    assert utterances.new_utterances(utterances.score_utterances(events), stored).count() == 0
