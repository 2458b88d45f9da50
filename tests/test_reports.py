"""Observed metrics, expectations with their log, sketches and log schemas."""

import os

import pytest
from pyspark.sql import functions as F

from parley.operators import gold, logs, quality
from parley.schemas import RAW_EVENT
from parley.sources.jsonlines import stream_events
from parley.staging import staging_path
from parley.streaming import ingest
from parley.streaming.listener import ObservedLog, missing_batches, read_observed


def test_more_batches_than_a_query_remembers(spark, tmp_path):
    source, root, folder = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/log"
    os.makedirs(source)
    count = 104
    for i in range(count):
        with open(f"{source}/{i:03d}.json", "w") as out:
            out.write(f'{{"UserId":"u{i}","ItemCount":{i}}}\n' + ("broken\n" if i % 4 == 0 else ""))
    listener = ObservedLog(spark, folder)
    spark.streams.addListener(listener)
    try:
        stream = ingest.observed(stream_events(spark, source, RAW_EVENT, max_files_per_trigger=1))
        query = ingest.start_append(stream, root, f"{root}-checkpoint")
        query.awaitTermination()
        assert listener.wait_for_end(query.runId)
    finally:
        spark.streams.removeListener(listener)
    assert len(query.recentProgress) <= 100
    stored = read_observed(spark, folder)
    assert stored.count() == count and missing_batches(stored).count() == 0
    told = stored.agg(F.sum(F.col("metrics")["cnt"].cast("int")), F.sum(F.col("metrics")["malformed"].cast("int"))).first()
    assert tuple(told) == (count + count // 4, count // 4)


def test_replayed_batches_count_once(spark, tmp_path):
    line = '{"query_id":"q","run_id":"%s","batch_id":%d,"name":"m","time":"2024-01-01T00:00:%02dZ","metrics":{"cnt":"%d"}}'
    with open(f"{tmp_path}/a", "w") as out:
        out.write("\n".join([line % ("r1", 0, 1, 5), line % ("r1", 1, 2, 7), line % ("r1", 1, 2, 7), line % ("r2", 1, 9, 8), line % ("r2", 4, 10, 1)]))
    stored = read_observed(spark, str(tmp_path))
    assert sorted((r.batch_id, r.run_id, r.metrics["cnt"]) for r in stored.collect()) == [(0, "r1", "5"), (1, "r2", "8"), (4, "r2", "1")]
    assert [(r.after, r.before) for r in missing_batches(stored).collect()] == [(1, 4)]


SUITE = [quality.not_null("a"), quality.between("b", 0, 10), quality.Expectation("both", "a = b")]


def test_quarantine_and_log(spark):
    root, log = staging_path(spark, "quarantine"), staging_path(spark, "quarantine-log")
    rows = [(1, 1), (None, 5), (2, 99), (2, None), (None, None)]
    df = spark.createDataFrame(rows, "a int, b int")
    good, bad = quality.split_by_expectations(df, SUITE, root, log, "t", 0)
    assert [tuple(r) for r in good.collect()] == [(1, 1)]
    names = bad.select("a", "b", quality.names_of(F.col("_failed"), SUITE).alias("names")).collect()
    assert sorted(((r.a, r.b, tuple(r.names)) for r in names), key=str) == sorted([
        (None, 5, ("a not null", "both")), (2, 99, ("b between 0 and 10", "both")), (2, None, ("both",)), (None, None, ("a not null", "both"))], key=str)
    report = lambda: sorted((r.name, r.passed_records, r.failed_records) for r in logs.expectation_report(spark.read.parquet(log)).collect())
    assert report() == [("a not null", 3, 2), ("b between 0 and 10", 4, 1), ("both", 1, 4)]
    # The same run again replaces its rows and its entry; another run adds one.
    quality.split_by_expectations(df, SUITE, root, log, "t", 0)
    assert len(report()) == 3
    empty, nothing = quality.split_by_expectations(df.where("false"), SUITE, root, log, "t", 1)
    assert len(report()) == 6 and empty.count() == nothing.count() == 0
    with pytest.raises(ValueError):
        quality.failed_rules(SUITE * 22)


def test_details_are_parsed_once(spark):
    log = spark.createDataFrame(
        [("e1", "2024", '{"flow_definition":{"output_dataset":"d","schema":{"b":1,"a":2}}}'), ("e2", "2024", '{"flow_progress":{"metrics":{"n":1},"data_quality":{"expectations":[{"name":"x","dataset":"d","passed_records":3,"failed_records":1}]}}}'),
         ("e3", "2024", "{}"), ("e4", "2024", "broken"), ("e5", "2024", None)], "id string, timestamp string, details string")
    for report in (logs.flow_definitions, logs.expectation_report):
        plan = report(log)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("details#") and plan.count("get_json_object") == 0
    assert [tuple(r) for r in logs.flow_definitions(log).collect()] == [("d", None, None, '{"b":1,"a":2}', '{"output_dataset":"d","schema":{"b":1,"a":2}}')]
    assert [tuple(r) for r in logs.expectation_report(log).collect()] == [("e2", "d", "x", 1, 3)]
    ddl = logs.details_schema(log).first()[0]
    parsed = log.select(F.from_json("details", F.lit(ddl)).alias("d")).select("d.flow_progress.metrics.n").where("n IS NOT NULL")
    assert [r.n for r in parsed.collect()] == [1]


def test_sketches_unite(spark):
    rows = spark.range(60_000).selectExpr(
        "date_add(DATE '2024-01-01', CAST(id % 7 AS INT)) AS date", "CASE WHEN id % 3 = 0 THEN 'PC' END AS client_type", "id % 20000 AS user_id")
    sketches = gold.user_sketches(rows)
    for by in ([], ["client_type"], ["date"]):
        exact = rows.groupBy(*by).agg(F.count_distinct("user_id").alias("exact"))
        told = gold.users_of(sketches, by)
        both = sorted(told.collect(), key=lambda r: str(r[:len(by)])), sorted(exact.collect(), key=lambda r: str(r[:len(by)]))
        assert all(abs(a.users - b.exact) <= a.bound < b.exact / 10 for a, b in zip(*both))
