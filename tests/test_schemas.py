"""Schemas that grow with new files, fields rescued one by one, and gold tables kept up by changes."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.plans.gold_incremental import GoldTables
from parley.operators import gold
from parley.sources.jsonlines import CORRUPT, parse_events, rescue_events
from parley.sources.schema_store import BOOLEAN, DOUBLE, INT, LONG, NESTED, STRING, SchemaStore, type_of
from parley.staging import staging_path


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def _types(schema):
    return {f.name: f.dataType.simpleString() for f in schema.fields}


@pytest.mark.parametrize("bits, name", [
    (BOOLEAN, "boolean"), (INT, "int"), (INT | LONG, "bigint"), (LONG | DOUBLE, "double"), (INT | DOUBLE, "double"),
    (BOOLEAN | INT, "string"), (STRING, "string"), (INT | STRING, "string"), (NESTED, "string"), (NESTED | DOUBLE, "string"),
])
def test_lattice(bits, name):
    assert type_of(bits).simpleString() == name


def test_runs_read_new_files_only(spark, tmp_path):
    source, store = f"{tmp_path}/in", SchemaStore(spark, f"{tmp_path}/store")
    _write(source, "a.json", [{"n": 1, "big": 1, "x": None, "o": {"p": 1}}, "[1]", "broken", ""])
    assert _types(store.update(source)) == {"big": "int", "n": "int", "o": "string"}
    _write(source, "b.json", [{"n": 2.5, "big": 1 << 40, "x": True, "late": "t"}])
    assert [r.path.rsplit("/", 1)[1] for r in store.new_files(source).collect()] == ["b.json"]
    assert _types(store.update(source)) == {"big": "bigint", "n": "double", "o": "string", "late": "string", "x": "boolean"}
    assert list(store.schema().names)[:3] == ["big", "n", "o"]
    # Nothing new: no run, no version.
    assert store.update(source) == store.schema() and store.versions() == [0, 1] and store._runs() == [0, 1]
    # Another text type; a hint outranks what was met.
    _write(source, "c.json", [{"n": "many"}])
    assert _types(store.update(source, "o map<string,int>, extra int")) == {
        "big": "bigint", "n": "string", "o": "map<string,int>", "late": "string", "x": "boolean", "extra": "int"}
    assert [r.run for r in store._state("files", "path string, modificationTime timestamp, length long").orderBy("run").collect()] == [0, 1, 2]


def test_failed_run_is_repeated(spark, tmp_path):
    source, store = f"{tmp_path}/in", SchemaStore(spark, f"{tmp_path}/store")
    _write(source, "a.json", [{"n": 1}])
    # Fields were written, the files were not: the run does not count.
    spark.createDataFrame([("ghost", 1)], "field string, bits int").write.parquet(f"{tmp_path}/store/fields/run=0")
    assert _types(store.update(source)) == {"n": "int"}


def test_rows_of_older_schemas_are_widened(spark, tmp_path):
    source, table, store = f"{tmp_path}/in", f"{tmp_path}/rows", SchemaStore(spark, f"{tmp_path}/store")
    for name, rows in (("a", [{"n": 1}]), ("b", [{"n": 2.5, "m": 1}])):
        _write(f"{source}/{name}", "x.json", rows)
        schema = store.update(source)
        store.append(rescue_events(spark.read.text(f"{source}/{name}"), schema), table)
    got = store.read(table)
    assert _types(got.schema) == {"n": "double", "m": "int", CORRUPT: "string"}
    assert sorted((r.n, r.m) for r in got.collect()) == sorted([(1.0, None), (2.5, 1)], key=lambda r: r[0])


SCHEMA = T.StructType([T.StructField(n, t) for n, t in {
    "s": T.StringType(), "i": T.IntegerType(), "l": T.LongType(), "d": T.DoubleType(), "b": T.BooleanType(), "t": T.TimestampType(),
    "m": T.MapType(T.StringType(), T.StringType()), "a": T.ArrayType(T.IntegerType()),
}.items()])


@pytest.mark.parametrize("line, good, rescued", [
    ({"s": "x", "i": 1, "l": 1 << 40, "d": 1, "b": True, "t": "2024-01-02 03:04:05", "m": {"k": "v"}, "a": [1, 2]},
     {"s": "x", "i": 1, "l": 1 << 40, "d": 1.0, "b": True, "t": dt.datetime(2024, 1, 2, 3, 4, 5), "m": {"k": "v"}, "a": [1, 2]}, None),
    ({"i": "1", "l": 2, "d": "bad"}, {"l": 2}, {"i": "1", "d": "bad"}),
    ({"i": 1 << 40, "b": 1, "a": 3, "s": 5}, {"s": "5"}, {"i": 1 << 40, "b": 1, "a": 3}),
    ({"t": "never", "m": [1], "x": {"y": [None]}, "i": None}, {}, {"t": "never", "m": [1], "x": {"y": [None]}}),
    ({}, {}, None),
    ("{\"i\":1", {}, {"_line": "{\"i\":1"}),
    ("[1]", {}, {"_line": "[1]"}),
])
def test_rescue_by_field(spark, line, good, rescued):
    text = line if isinstance(line, str) else json.dumps(line)
    row = rescue_events(spark.createDataFrame([(text, "f.json", 7)], "value string, f string, kept int"), SCHEMA, F.col("f")).first()
    assert {k: row[k] for k in SCHEMA.names if row[k] is not None} == good and row.kept == 7
    told = json.loads(row[CORRUPT]) if row[CORRUPT] else None
    assert told == (rescued and {**rescued, "_file_path": "f.json"})


def test_one_bad_field_does_not_cost_the_line(spark):
    lines = spark.createDataFrame([('{"i":"x","l":2}',)], "value string")
    assert parse_events(lines, SCHEMA).first()[CORRUPT] == '{"i":"x","l":2}'
    row = rescue_events(lines, SCHEMA).first()
    assert (row.i, row.l, row[CORRUPT]) == (None, 2, '{"i":"x"}')


def test_each_line_is_parsed_once(spark):
    plan = rescue_events(spark.read.text(os.path.dirname(__file__)), SCHEMA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json") + plan.lower().count("parsejson") <= 2  # the expression and its name


# --- gold -----------------------------------------------------------------

FEED = "date date, client_type string, user_id string, activity_type string, app_role_name string, item_count int, _change_type string"


def _event(day, client, user, role="r", items=1, kind="insert"):
    return (day and dt.date(2024, 1, day), client, user, "message", role, items, kind)


def _gold(tables):
    out = {}
    for name in tables.tables:
        out[name] = sorted((tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in tables.read(name).collect()), key=str)
    return out


def _whole(spark, rows):
    events = spark.createDataFrame(rows, FEED).where("date IS NOT NULL")
    frames = {"daily_users": gold.daily_users(events), "client_types": gold.client_type_distribution(events), "channels": gold.user_channels(events)}
    return {n: sorted((tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in f.collect()), key=str) for n, f in frames.items()}


def test_counts_fall_when_rows_go(spark):
    tables = GoldTables(spark, staging_path(spark, "gold-test"))
    first = [_event(1, "PC", "u1"), _event(1, "PC", "u1", "q"), _event(1, "PC", "u2"), _event(2, None, "u1", items=None), _event(3, "TV", None), _event(None, "PC", "u9")]
    tables.apply(spark.createDataFrame(first, FEED), 0)
    assert _gold(tables) == _whole(spark, first)
    # One of u1's two rows goes, u2 becomes u3, and the third day empties.
    feed = [_event(1, "PC", "u1", "q", kind="delete"), _event(1, "PC", "u2", kind="update_preimage"), _event(1, "PC", "u3", items=5, kind="update_postimage"), _event(3, "TV", None, kind="delete")]
    now = [_event(1, "PC", "u1"), _event(1, "PC", "u3", items=5), _event(2, None, "u1", items=None)]
    tables.apply(spark.createDataFrame(feed, FEED), 1)
    assert _gold(tables) == _whole(spark, now)
    # The second day was not written again.
    assert tables.tables["channels"][0].owners()[dt.date(2024, 1, 2)] == 0 and tables.facts.owners()[dt.date(2024, 1, 1)] == 1
    # Repeating the last delivery retracts nothing twice; an earlier one is refused.
    tables.apply(spark.createDataFrame(feed, FEED), 1)
    assert _gold(tables) == _whole(spark, now)
    with pytest.raises(ValueError):
        tables.apply(spark.createDataFrame(feed, FEED), 0)
    tables.apply(spark.createDataFrame([], FEED), 2)
    assert _gold(tables) == _whole(spark, now)


def test_failure_between_the_tables_is_repaired(spark, monkeypatch):
    tables = GoldTables(spark, staging_path(spark, "gold-failure"))
    tables.apply(spark.createDataFrame([_event(1, "PC", "u1"), _event(1, "PC", "u2")], FEED), 0)
    feed = spark.createDataFrame([_event(1, "PC", "u2", kind="delete")], FEED)
    channels = tables.tables["channels"][0]
    with monkeypatch.context() as broken:
        broken.setattr(channels, "replace", lambda *a: (_ for _ in ()).throw(OSError("disk")))
        with pytest.raises(OSError):
            tables.apply(feed, 1)
    tables.apply(feed, 1)
    assert _gold(tables) == _whole(spark, [_event(1, "PC", "u1")])


def test_only_changed_dates_are_read(spark):
    tables = GoldTables(spark, staging_path(spark, "gold-plan"))
    tables.apply(spark.createDataFrame([_event(d, "PC", "u1") for d in range(1, 6)], FEED), 0)
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    plan = tables.facts.read([dt.date(2024, 1, 3)])._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    assert "PartitionFilters" in scan and "version" in scan and "date" in scan.split("PartitionFilters")[1]
    assert tables.facts.read([dt.date(2024, 1, 3)]).inputFiles().__len__() >= 1
