from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from parley.operators.latest import newest_per_key
from parley.operators.upsert import cluster_by, table_diff, upsert, upsert_partial
from parley.schemas import CLIENT_TYPE_DISTRIBUTION
from parley.sources import jsonlines, tables
from parley.functions.columns import flatten_map_dynamic, pivot_entries, select_paths
from parley.staging import staging_path, staging_root


def _df(spark, rows, schema="id string, time int, v string"):
    return spark.createDataFrame(rows, schema)


def _set(df):
    return {tuple(r) for r in df.collect()}


def test_newest_per_key_and_null_keys(spark):
    df = _df(spark, [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), (None, 1, "n"), (None, 2, "m")])
    assert _set(newest_per_key(df, ["id"], ["time"])) == {("a", 3, "y"), (None, 1, "n"), (None, 2, "m")}
    assert _set(newest_per_key(df, ["id"], ["time"], "collapse")) == {("a", 3, "y"), (None, 2, "m")}
    assert _set(newest_per_key(df, ["id"], ["time"], "drop")) == {("a", 3, "y")}


def test_newest_per_key_ties_do_not_depend_on_order(spark):
    rows = [("a", 1, c) for c in "pqrstu"]
    assert _set(newest_per_key(_df(spark, rows), ["id"], ["time"])) == _set(
        newest_per_key(_df(spark, rows[::-1]).repartition(5), ["id"], ["time"])
    )


def test_newest_per_key_keeps_map_columns(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1, map('k', 'x')), ('a', 2, map('k', 'y')) AS t(id, time, m)")
    assert newest_per_key(df, ["id"], ["time"]).collect()[0].m == {"k": "y"}


def test_upsert_guard_and_last_write(spark):
    target = _df(spark, [("a", 5, "old"), ("b", 1, "keep")])
    changes = _df(spark, [("a", 3, "late"), ("c", 1, "new"), ("c", 2, "newer")])
    assert _set(upsert(target, changes, ["id"], ["time"])) == {("a", 5, "old"), ("b", 1, "keep"), ("c", 2, "newer")}
    assert _set(upsert(target, changes, ["id"], ["time"], guard=False)) == {
        ("a", 3, "late"), ("b", 1, "keep"), ("c", 2, "newer")
    }


def test_upsert_equal_sequence_goes_to_the_change(spark):
    out = upsert(_df(spark, [("a", 1, "old")]), _df(spark, [("a", 1, "new")]), ["id"], ["time"])
    assert _set(out) == {("a", 1, "new")}


def test_upsert_is_replay_safe(spark):
    target, changes = _df(spark, [("a", 1, "x")]), _df(spark, [("a", 2, "y"), ("b", 1, "z")])
    once = upsert(target, changes, ["id"], ["time"])
    assert _set(upsert(once, changes, ["id"], ["time"])) == _set(once)


def test_upsert_preserves_and_evolves(spark):
    target = _df(spark, [("a", 1, "created")], "id string, time int, made string")
    changes = _df(spark, [("a", 2, "again", "n"), ("b", 1, "first", "m")], "id string, time int, made string, extra string")
    out = upsert(target, changes, ["id"], ["time"], preserve=["made"])
    assert out.columns == ["id", "time", "made", "extra"]
    assert _set(out) == {("a", 2, "created", "n"), ("b", 1, "first", "m")}


def test_upsert_partial_matches_missing_keys(spark):
    target = _df(spark, [("d1", None, 1, "t")], "date string, kind string, n int, note string")
    updates = _df(spark, [("d1", None, 2, "s"), ("d2", "x", 3, "s")], "date string, kind string, n int, note string")
    out = upsert_partial(target, updates, ["date", "kind"], ["n"])
    assert _set(out) == {("d1", None, 2, "t"), ("d2", "x", 3, "s")}


def test_table_diff(spark):
    old = spark.sql("SELECT * FROM VALUES ('a', map('k', 1)), ('b', map('k', 1)), ('c', map('k', 1)) AS t(id, m)")
    new = spark.sql("SELECT * FROM VALUES ('a', map('k', 1)), ('b', map('k', 2)), ('d', map('k', 9)) AS t(id, m)")
    got = {(r.id, r.m["k"], r._change_type) for r in table_diff(old, new, ["id"]).collect()}
    assert got == {("b", 1, "update_preimage"), ("b", 2, "update_postimage"), ("c", 1, "delete"), ("d", 9, "insert")}


def test_versions_restore_and_clone(spark):
    root, copy = staging_path(spark, "t"), staging_path(spark, "t")
    tables.write_version(_df(spark, [("a", 1, "x")]), root)
    tables.write_version(_df(spark, [("a", 2, "y")]).withColumn("w", F.lit(1)), root)
    assert tables.versions(spark, root) == [0, 1]
    assert tables.read_version(spark, root).columns == ["id", "time", "v", "w"]
    assert tables.restore_version(spark, root, 0) == 2
    tables.clone(spark, root, copy)
    assert _set(tables.read_version(spark, copy)) == {("a", 1, "x")}
    with pytest.raises(FileNotFoundError):
        tables.read_version(spark, staging_path(spark, "none"))


def test_enforce_schema_fails_on_missing_value(spark):
    good = spark.sql("SELECT DATE'2024-01-01' AS date, 'PC' AS client_type, 1 AS user_base, 2 AS total_users, 50 AS percent_users")
    out = tables.enforce_schema(good, CLIENT_TYPE_DISTRIBUTION)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in CLIENT_TYPE_DISTRIBUTION.fields]
    assert out.count() == 1
    with pytest.raises(Exception, match="NOT NULL"):
        tables.enforce_schema(good.withColumn("date", F.lit(None).cast("date")), CLIENT_TYPE_DISTRIBUTION).collect()


def test_cluster_by_gives_disjoint_ranges(spark):
    df = spark.range(1000).withColumn("t", F.hash("id"))
    ranges = (
        cluster_by(df, "t", 4).groupBy(F.spark_partition_id().alias("p")).agg(F.min("t").alias("a"), F.max("t").alias("z"))
        .orderBy("a").collect()
    )
    assert len(ranges) == 4
    assert all(x.z < y.a for x, y in zip(ranges, ranges[1:]))


def test_schema_hints_evolution_and_store(spark):
    path = staging_path(spark, "json")
    spark.createDataFrame([('{"a": 1, "Properties": {"x": 1}}',)], "value string").write.text(path)
    first = jsonlines.infer_schema(spark, path, "properties MAP<STRING,STRING>, added INT")
    assert first["Properties"].dataType.simpleString() == "map<string,string>"
    assert first["added"].dataType.simpleString() == "int"
    kept = staging_path(spark, "schema")
    jsonlines.save_schema(spark, first, kept)
    later = jsonlines.T.StructType.fromDDL("a STRING, fresh DOUBLE")
    evolved = jsonlines.evolve_schema(jsonlines.load_schema(spark, kept), later)
    assert evolved.fieldNames()[-1] == "fresh"
    assert evolved["a"].dataType == first["a"].dataType


def test_paths_ignore_case_and_absent_columns(spark):
    df = spark.sql("SELECT map('k', 'v') AS Properties, named_struct('f', 1) AS s, 2 AS Name")
    row = select_paths(df, {"properties.k": "k", "S.f": "f", "name": "n", "gone.k": "g", "gone": "h"}).collect()[0]
    assert tuple(row) == ("v", 1, 2, None, None)


def test_rare_map_keys_stay_in_a_map(spark):
    df = spark.range(20).select("id", F.create_map(F.lit("all"), F.lit(1), F.col("id").cast("string"), F.lit(2)).alias("m"))
    wide = flatten_map_dynamic(df, "m", "m_", columns=3)
    assert wide.columns == ["id", "m_rest", "m_0", "m_1", "m_all"]
    rows = {r.id: r for r in wide.collect()}
    assert rows[0].m_rest == {} and rows[0].m_0 == 2 and rows[7].m_rest == {"7": 2} and rows[7].m_all == 1


def test_undeclared_keys_of_a_pivot_stay_in_a_map(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", "x"), (1, "b", "y"), (2, "c", None)], "id int, k string, v string")
    rows = {r.id: (r.a, r.rest) for r in pivot_entries(df, ["id"], "k", "v", ["a"]).collect()}
    assert rows == {1: ("x", {"b": "y"}), 2: (None, {"c": None})}


def test_latest_and_upsert_scan_their_inputs_once(spark, tmp_path):
    spark.range(10).selectExpr("id % 3 AS k", "id AS s", "map('a', id) AS m").write.parquet(f"{tmp_path}/t")
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan")
    rows = spark.read.parquet(f"{tmp_path}/t")
    assert scans(newest_per_key(rows, ["k"], ["s"])) == 1
    assert scans(upsert(rows, rows.where("s > 5"), ["k"], ["s"])) == 2


def test_staging_follows_the_session_setting(spark):
    def session(master, **conf):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k.replace(".", "_"), d)), sparkContext=context)

    assert staging_root(session("yarn", spark_checkpoint_dir="hdfs://shared/cp/")) == "hdfs://shared/cp"
    own = staging_root(session("local[2]"))
    assert "parley-staging-" in own and staging_root(session("local[2]")) == own
    assert staging_root(spark) == (spark.conf.get("spark.checkpoint.dir", None) or own).rstrip("/")
    with pytest.raises(RuntimeError):
        staging_root(session("yarn"))
