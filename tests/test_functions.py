import datetime as dt

import pytest
from pyspark.sql import functions as F

from parley.functions import text as t
from parley.functions import times
from parley.operators import gold, logs, quality
from parley.schemas import PROGRESS_LOG
from parley.staging import staging_path


def _one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"])
    return df.select(column.alias("x")).head()[0]


@pytest.mark.parametrize(
    "line, expected",
    [
        ('{"a": 1, "b": {"c": 2}}', {"a": "1", "b": '{"c":2}'}),
        ('{"a": "x, y=z"}', {"a": "x, y=z"}),
        ("not json", None), ('{"a": 1', None), ("[1]", None), (None, None), ('{"a": null}', {"a": None}),
    ],
)
def test_json_to_map(spark, line, expected):
    assert _one(spark, t.json_to_map(F.lit(line).cast("string"))) == expected


def test_json_nested_map_keeps_commas(spark):
    assert _one(spark, t.json_nested_map(F.lit('{"p": {"k": "a=1, b=2"}}'), "p")) == {"k": "a=1, b=2"}


@pytest.mark.parametrize(
    "text, kind, expected",
    [
        ("{a=1, b=2}", "int", {"a": 1, "b": 2}), ("{a=x, b=}", "string", {"a": "x", "b": ""}),
        ("{a=1, a=2}", "int", {"a": 2}), ("{a=1, b}", "int", {"a": 1, "b": None}), ("{}", "string", {}),
        (None, "string", None), ("{a=z}", "int", {"a": None}),
    ],
)
def test_kv_text_to_map(spark, text, kind, expected):
    assert _one(spark, t.kv_text_to_map(F.lit(text).cast("string"), kind)) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("numFilesOutstanding=12", 12), ('{"numFilesOutstanding":"7"}', 7), ('{"numFilesOutstanding" : 3}', 3), ("none", None)],
)
def test_outstanding_files(spark, text, expected):
    assert _one(spark, t.extract_int(F.lit(text), t.OUTSTANDING_FILES)) == expected


def test_hour_folder_parts(spark):
    path = "dbfs:/x/batch/y=2022/m=11/d=10/h=03/m=00/part.json"
    assert _one(spark, t.partition_key(F.lit(path))) == "202211100300"
    assert _one(spark, t.source_folder(F.lit(path))) == "2022-11-10:03"
    assert _one(spark, t.partition_key(F.lit("/elsewhere/part.json"))) is None


def test_hourly_suffixes_exclude_the_start(spark):
    got = [r[0] for r in times.hourly_suffixes(spark, dt.datetime(2022, 11, 9, 2), dt.datetime(2022, 11, 10, 4)).collect()]
    assert len(got) == 26
    assert got[0] == "y=2022/m=11/d=09/h=03/m=00" and got[-1] == "y=2022/m=11/d=10/h=04/m=00"
    with pytest.raises(ValueError):
        times.hourly_suffixes(spark, dt.datetime(2022, 1, 1), dt.datetime(2022, 1, 1))


def test_days_and_window(spark):
    days = _one(spark, times.days_between(F.lit(dt.date(2022, 2, 27)), F.lit(dt.date(2022, 3, 2))))
    assert days == [dt.date(2022, 2, 27), dt.date(2022, 2, 28), dt.date(2022, 3, 1)]
    assert _one(spark, times.days_between(F.lit(dt.date(2022, 3, 2)), F.lit(dt.date(2022, 3, 2)))) == []
    assert times.date_window("", dt.date(2022, 11, 10), dt.date(2022, 11, 11)) == (dt.date(2022, 11, 10),) * 2
    first, last = times.date_window("yesterday")
    assert first == last
    with pytest.raises(ValueError):
        times.date_window("")


def test_safe_cast(spark):
    assert _one(spark, times.safe_cast(F.lit("x"), "int")) is None
    assert _one(spark, times.safe_cast(F.lit("2022-11-02T02:28:01.5208813Z"), "timestamp")).microsecond == 520881


def test_gold_counts_and_missing_values(spark):
    df = spark.sql(
        "SELECT DATE'2024-01-01' AS date, * FROM VALUES ('PC', 'u1'), ('PC', 'u1'), ('PC', 'u2'), (NULL, 'u2'), ('TV', NULL) "
        "AS t(client_type, user_id)"
    )
    got = {(r.client_type, r.user_base, r.total_users, r.percent_users) for r in gold.client_type_distribution(df).collect()}
    assert got == {("PC", 2, 2, 100.0), (None, 1, 2, 50.0), ("TV", 0, 2, 0.0)}
    assert gold.daily_users(df).head()[1] == 2
    assert gold.daily_users(df, approx=True).head()[1] == 2


def test_expectations(spark):
    df = spark.sql("SELECT * FROM VALUES ('2024-01-31', 5.0), ('2024-13-01', 11.0), (NULL, NULL) AS t(d, n)")
    suite = [quality.matches_date_format("d", "%Y-%m-%d"), quality.between("n", "0", "10"), quality.not_null("d")]
    path = staging_path(spark, "suite")
    quality.save_suite(spark, suite, path)
    assert sorted(quality.load_suite(spark, path), key=lambda e: e.name) == sorted(suite, key=lambda e: e.name)
    rows = {r.expectation: (r.evaluated, r.failed, r.success) for r in quality.report(df, suite).collect()}
    assert rows == {
        "d matches %Y-%m-%d": (2, 1, False), "n between 0 and 10": (2, 1, False), "d not null": (3, 1, False)
    }


def test_expect_or_drop_observes(spark):
    from pyspark.sql import Observation

    seen = Observation("quality")
    df = spark.sql("SELECT * FROM VALUES ('a'), (NULL), ('b') AS t(c)")
    assert quality.expect_or_drop(df, quality.not_null("c"), seen).count() == 2
    assert seen.get == {"passed": 2, "failed": 1}


def test_progress_lines_without_report(spark):
    path = staging_path(spark, "log")
    lines = [
        ('{"EVENT_TIME": "2024-01-01 10:00:00.5", "STATUS": "STREAM_STARTED", "STREAM_ID": "q", "RUN_ID": "r", "STREAM_NAME": "n"}',),
        ('{"EVENT_TIME": "2024-01-01 10:00:01", "STATUS": "STREAM_UPDATED", "BATCH_INFO": "{broken"}',),
    ]
    spark.createDataFrame(lines, "value string").write.text(path)
    rows = {r.status: r for r in logs.parse_progress(spark.read.schema(PROGRESS_LOG).json(path)).collect()}
    started = rows["STREAM_STARTED"]
    assert (started.stream_id, started.stream_name, started.event_time, started.batch_id) == ("q", "n", started.input_time, None)
    assert rows["STREAM_UPDATED"].stream_id is None
