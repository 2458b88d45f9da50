"""Catalogue: aggregates, keyed tables, quality, ingest and text functions over ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions import columns as c
from parley.functions import text as t
from parley.functions.times import hour_folder, hours_between, safe_cast
from parley.operators import audit as a
from parley.operators import gold, logs, quality, upsert as ups
from parley.operators.latest import newest_per_key
from parley.plans.gold_incremental import GoldTables
from parley.plans.hourly_ingest import parse_lines, split_rejects
from parley.schemas import CLIENT_TYPE_DISTRIBUTION
from parley.sources import jsonlines, tables
from parley.sources.bucket_table import BucketTable
from parley.sources.jsonlines import read_lines
from parley.sources.schema_store import SchemaStore
from parley.staging import stage, staging_path
from parley.streaming import ingest


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


# --- aggregates -----------------------------------------------------------


def app_events(spark, sf_dir):
    """``events`` in the roles the daily aggregates read."""
    return events(spark, sf_dir).select(
        F.to_date("ts").alias("date"),
        F.col("event_type").alias("client_type"),
        F.col("event_type").alias("activity_type"),
        "user_id",
        t.extract_int("props", r'"k": (\d+)').alias("item_count"),
        F.concat(F.lit("role"), (F.col("event_id") % 3).cast("string")).alias("app_role_name"),
    )


def gold_daily_users(spark, sf_dir):
    return gold.daily_users(app_events(spark, sf_dir))


def gold_client_type_distribution(spark, sf_dir):
    out = gold.client_type_distribution(app_events(spark, sf_dir))
    return out.withColumn("percent_users", F.round("percent_users", 6))


def gold_user_channel(spark, sf_dir):
    out = gold.user_channels(app_events(spark, sf_dir))
    return out.withColumn("communication_channel", F.array_join("communication_channel", ","))


#: Rows that the second delivery changes (another user, one item more) and the third deletes.
_UPDATED = "event_id % 7 = 3 AND date BETWEEN DATE '2024-01-10' AND DATE '2024-01-14'"
_DELETED = "(event_id % 11 = 5 OR client_type = 'signup') AND date BETWEEN DATE '2024-01-13' AND DATE '2024-01-16'"


def _gold_tables(spark, sf_dir) -> GoldTables:
    """Three deliveries of a feed: everything, updates on five dates, deletes on four."""
    tables_ = GoldTables(spark, staging_path(spark, "gold"))
    rows = events(spark, sf_dir).select("event_id", F.to_date("ts").alias("date"), F.col("event_type").alias("client_type"),
        F.col("event_type").alias("activity_type"), F.col("user_id").cast("string").alias("user_id"),
        t.extract_int("props", r'"k": (\d+)').alias("item_count"), F.concat(F.lit("role"), (F.col("event_id") % 3).cast("string")).alias("app_role_name"))
    updated = rows.withColumns({"user_id": F.concat(F.col("user_id"), F.lit("x")), "item_count": F.col("item_count") + 1})
    kept = F.when(F.expr(_UPDATED), 1).otherwise(0) == 0
    marked = lambda df, kind: df.withColumn("_change_type", F.lit(kind))
    tables_.apply(marked(rows, "insert"), 0)
    tables_.apply(marked(rows.where(_UPDATED), "update_preimage").unionByName(marked(updated.where(_UPDATED), "update_postimage")), 1)
    current = rows.where(kept).unionByName(updated.where(_UPDATED))
    tables_.apply(marked(current.where(_DELETED), "delete"), 2)
    return tables_


def gold_incremental(spark, sf_dir):
    """Client types per day after three deliveries of changes, and the delivery that last wrote the day."""
    found = _gold_tables(spark, sf_dir)
    written = spark.createDataFrame(list(found.tables["client_types"][0].owners().items()), "date date, delivery int")
    return found.read("client_types").withColumn("percent_users", F.round("percent_users", 6)).join(written, "date")


def gold_incremental_channels(spark, sf_dir):
    out = _gold_tables(spark, sf_dir).read("channels")
    return out.withColumn("communication_channel", F.array_join("communication_channel", ","))


def gold_incremental_users(spark, sf_dir):
    return _gold_tables(spark, sf_dir).read("daily_users")


_APP = """
WITH app AS (SELECT CAST(ts AS DATE) AS date, event_type AS client_type, event_type AS activity_type, user_id,
  CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS item_count,
  concat('role', CAST(event_id % 3 AS VARCHAR)) AS app_role_name FROM events)"""

_CHANGED = f"""
WITH raw AS (SELECT event_id, CAST(ts AS DATE) AS date, event_type AS client_type, event_type AS activity_type, CAST(user_id AS VARCHAR) AS user_id,
  CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS item_count, concat('role', CAST(event_id % 3 AS VARCHAR)) AS app_role_name FROM events),
app AS (SELECT date, client_type, activity_type, CASE WHEN {_UPDATED} THEN concat(user_id, 'x') ELSE user_id END AS user_id,
  CASE WHEN {_UPDATED} THEN item_count + 1 ELSE item_count END AS item_count, app_role_name FROM raw WHERE NOT ({_DELETED}))"""

# --- keyed tables ---------------------------------------------------------

KEY = ["user_id", "event_type"]


def _parts(spark, sf_dir):
    """Two deliveries that cover the table and overlap: up to the 20th, and from the 11th on."""
    rows = events(spark, sf_dir)
    return rows.where(F.to_date("ts") <= "2024-01-20"), rows.where(F.to_date("ts") >= "2024-01-11")


def dedupe_latest(spark, sf_dir):
    return newest_per_key(events(spark, sf_dir), KEY, ["ts", "event_id"])


def upsert_latest(spark, sf_dir):
    """Last write wins: the older delivery arrives last and replaces newer rows."""
    early, late = _parts(spark, sf_dir)
    return ups.upsert(newest_per_key(late, KEY, ["ts", "event_id"]), early, KEY, ["ts", "event_id"], guard=False)


def cdc_scd1(spark, sf_dir):
    """Greatest sequence wins: the older delivery arrives last and changes nothing."""
    early, late = _parts(spark, sf_dir)
    return ups.upsert(newest_per_key(late, KEY, ["ts", "event_id"]), early, KEY, ["ts", "event_id"], guard=True)


def _bucketed(spark, sf_dir, label: str) -> BucketTable:
    return BucketTable(spark, staging_path(spark, label), events(spark, sf_dir).schema, KEY, ["ts", "event_id"], 16)


def bucketed_upsert(spark, sf_dir):
    """The same two deliveries as ``upsert_latest``, merged into a bucketed table."""
    early, late = _parts(spark, sf_dir)
    table = _bucketed(spark, sf_dir, "bucketed")
    table.merge(late)
    table.merge(early, guard=False)
    return table.read()


#: Three deliveries: overlapping ranges of time, the last one for some users only.
_DELIVERIES = (
    "ts < TIMESTAMP '2024-01-12 00:00:00'",
    "ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-21 00:00:00' AND user_id % 3 <> 0",
    "ts >= TIMESTAMP '2024-01-16 00:00:00' AND user_id % 50 = 7",
)


def _delivered(spark, sf_dir, label: str) -> BucketTable:
    table = _bucketed(spark, sf_dir, label)
    for part in _DELIVERIES:
        table.merge(events(spark, sf_dir).where(part))
    return table


def merge_metrics(spark, sf_dir):
    """What each of three merges did to the keys."""
    return _delivered(spark, sf_dir, "metrics").metrics().select("version", "inserted", "updated", "unchanged")


def change_feed(spark, sf_dir):
    """Changes of the second and third merge together, from the buckets they replaced."""
    return _delivered(spark, sf_dir, "feed").change_feed(0, 2)


def change_feed_folders(spark, sf_dir):
    """The same feed from change folders, of which the first is folded into a base."""
    root, rows = staging_path(spark, "feed-folders"), events(spark, sf_dir)
    for number, part in enumerate(_DELIVERIES):
        ingest.apply_batch(rows.where(part), number, root, KEY, ["ts", "event_id"])
        if number == 0:
            ingest.compact(spark, root, KEY, ["ts", "event_id"], 0)
    return ingest.change_feed(spark, root, KEY, ["ts", "event_id"], 0, 2).drop("batch_id")


def _sides(spark, sf_dir):
    """Two tables that hold every event between them: all views only in the first, all clicks only in the second."""
    rows = events(spark, sf_dir)
    old = rows.where("event_type = 'view' OR event_type <> 'click' AND to_date(ts) <= DATE '2024-01-20'")
    new = rows.where("event_type = 'click' OR event_type <> 'view' AND to_date(ts) >= DATE '2024-01-11'")
    return newest_per_key(old, KEY, ["ts", "event_id"]), newest_per_key(new, KEY, ["ts", "event_id"])


def upsert_partial(spark, sf_dir):
    stored, newest = _sides(spark, sf_dir)
    return ups.upsert_partial(stored, newest, KEY, ["value", "props"])


def table_diff(spark, sf_dir):
    return ups.table_diff(*_sides(spark, sf_dir), KEY)


def cluster_by_time(spark, sf_dir):
    return stage(ups.cluster_by(events(spark, sf_dir), "ts"), "clustered")


def snapshot_roundtrip(spark, sf_dir):
    """Version 0 and 1, restore of 0 as 2, clone of the newest."""
    root, copy = staging_path(spark, "snapshots"), staging_path(spark, "clone")
    rows = events(spark, sf_dir)
    tables.write_version(rows, root)
    tables.write_version(rows.withColumn("value", F.lit(0.0)), root)
    tables.restore_version(spark, root, 0)
    tables.clone(spark, root, copy)
    return tables.read_version(spark, copy)


_LATEST = """
WITH tg AS (SELECT * FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20'), ch AS (SELECT * FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-11'),
tn AS (SELECT * FROM tg QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1),
cn AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)"""

# Of every key the newest row of each delivery, as one number of time and id.
_FED = "WITH dl AS (" + " UNION ALL ".join(
    f"""SELECT CAST({number} AS BIGINT) AS version, user_id, event_type, max(epoch_us(ts)::HUGEINT * 1000000000 + event_id) AS seq
      FROM events WHERE {part} GROUP BY ALL""" for number, part in enumerate(_DELIVERIES)) + ")"

_SIDES = """
WITH o AS (SELECT * FROM events WHERE event_type = 'view' OR event_type <> 'click' AND CAST(ts AS DATE) <= DATE '2024-01-20'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1),
n AS (SELECT * FROM events WHERE event_type = 'click' OR event_type <> 'view' AND CAST(ts AS DATE) >= DATE '2024-01-11'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)"""

# --- JSON, maps, text -----------------------------------------------------


def json_to_map(spark, sf_dir):
    parsed = t.json_to_map(F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "p": '), "props", F.lit("}")))
    return events(spark, sf_dir).select("event_id", parsed.alias("m")).select(
        "event_id", F.col("m")["id"].alias("id"), F.col("m")["absent"].alias("absent"), F.size("m").alias("entries")
    )


def json_nested_map(spark, sf_dir):
    text = F.concat(F.lit('{"props": '), "props", F.lit(', "note": "a=1, b=2"}'))
    return events(spark, sf_dir).select(
        "event_id",
        t.json_nested_map(text, "props")["k"].alias("k"),
        t.json_to_map(text)["note"].alias("note"),
    )


def kv_text_to_map(spark, sf_dir):
    text = F.concat(
        F.lit("{k="), F.get_json_object("props", "$.k"), F.lit(", user="), F.col("user_id").cast("string"), F.lit(", bad=x}")
    )
    m = t.kv_text_to_map(text, "int")
    return events(spark, sf_dir).select(
        "event_id", m["k"].alias("k"), m["user"].alias("user"), m["bad"].alias("bad")
    )


def _with_properties(spark, sf_dir):
    """Events with a property map whose keys differ per event type."""
    return events(spark, sf_dir).select(
        "event_id",
        F.map_concat(
            t.json_to_map("props"),
            F.create_map(F.concat(F.lit("on_"), "event_type"), F.col("user_id").cast("string")),
        ).alias("properties"),
    )


def map_explode(spark, sf_dir):
    return c.explode_map(_with_properties(spark, sf_dir), "properties")


def map_flatten_dynamic(spark, sf_dir):
    return c.flatten_map_dynamic(_with_properties(spark, sf_dir), "properties")


def props_project(spark, sf_dir):
    return c.select_paths(
        _with_properties(spark, sf_dir),
        {"event_id": "event_id", "Properties.k": "k", "properties.on_click": "clicked_by", "properties.nothing": "nothing"},
    )


def pivot_properties(spark, sf_dir):
    entries = c.explode_map(_with_properties(spark, sf_dir), "properties")
    wide = c.pivot_entries(entries, ["event_id"], "key", "value", ["k", "on_click", "on_view"])
    return wide.withColumn("rest", F.when(F.size("rest") > 0, F.to_json("rest")))


_PROPS = """
WITH pr AS (SELECT event_id, event_type, user_id, regexp_extract(props, '"k": ([0-9]+)', 1) AS k FROM events)"""


def regex_extract_int(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", t.extract_int("url", r"page=(\d+)").alias("page")
    )


def md5_row_key(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", t.line_key("props").alias("line_md5"))


def _landing_path(ts: str):
    return F.concat(F.lit("file:/landing/"), hour_folder(F.col(ts)), F.lit("/part-0.json"))


def path_partition_key(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", _landing_path("ts").alias("path")).select(
        "event_id", t.partition_key(F.col("path")).alias("partition_key"), t.source_folder(F.col("path")).alias("source_folder")
    )


def cast_safe(spark, sf_dir):
    mixed = F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    day = F.when(F.col("event_id") % 5 == 0, F.lit("someday")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return events(spark, sf_dir).select(
        "event_id", safe_cast(mixed, "double").alias("value"), safe_cast(day, "date").alias("day")
    )


def hourly_suffixes(spark, sf_dir):
    """Hours after the first up to the last event of every user."""
    hour = F.expr("date_trunc('HOUR', ts)").cast("timestamp_ntz")
    spans = events(spark, sf_dir).groupBy("user_id").agg(F.min(hour).alias("a"), F.max(hour).alias("b"))
    hours = spans.select("user_id", F.explode(hours_between(F.col("a"), F.col("b"))).alias("hour"))
    return hours.select("user_id", hour_folder(F.col("hour")).alias("suffix"))


# --- ingest ---------------------------------------------------------------

def event_lines(spark, sf_dir):
    """Every event as one JSON line."""
    return events(spark, sf_dir).select(
        "ts",
        F.concat(
            F.lit('{"time": "'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('0Z", "Name": "'), "event_type",
            F.lit('", "UserId": "u'), F.col("user_id").cast("string"), F.lit('", "ItemCount": '), F.col("event_id").cast("string"),
            F.lit(', "Properties": '), "props", F.lit("}"),
        ).alias("value"),
    )


def with_extra(lines: DataFrame) -> DataFrame:
    """A field nobody declared in a third of the lines."""
    second = F.second("ts")
    extended = F.concat(F.regexp_replace("value", r"\}$", ""), F.lit(', "Extra": "x'), second.cast("string"), F.lit('"}'))
    return lines.withColumn("value", F.when(second < 20, extended).otherwise(F.col("value")))


def landed_lines(spark, sf_dir, twice: bool = False, extra: bool = False) -> str:
    """JSON lines in hour folders; returns the folder."""
    lines = event_lines(spark, sf_dir)
    if extra:
        lines = with_extra(lines)
    if twice:
        lines = lines.unionByName(lines)
    path = staging_path(spark, "landing")
    # By folder first: otherwise every task would open a file in every folder.
    lines.select(
        "value", F.date_format("ts", "yyyy").alias("y"), F.date_format("ts", "MM").alias("m"),
        F.date_format("ts", "dd").alias("d"), F.date_format("ts", "HH").alias("h"),
    ).repartition("y", "m", "d", "h").write.partitionBy("y", "m", "d", "h").text(path)
    return path


_FIELDS = ["time", "Name", "UserId", "ItemCount", "Properties"]


def jsonl_text_parse(spark, sf_dir):
    good, _ = split_rejects(parse_lines(read_lines(spark, landed_lines(spark, sf_dir, twice=True)), _FIELDS))
    return good.select(
        "line_md5", "partition_key", "time", F.col("Name").alias("name"), F.col("UserId").alias("user_id"),
        F.col("ItemCount").alias("item_count"), F.col("Properties")["k"].alias("k"),
    )


def ingest_all_fields(spark, sf_dir):
    """Declared fields as columns, the others in ``rest``: no field of a line is lost."""
    good, _ = split_rejects(parse_lines(read_lines(spark, landed_lines(spark, sf_dir, extra=True)), ["time", "Name", "Properties"]))
    return good.select(
        F.col("Name").alias("name"), F.col("Properties")["k"].alias("k"), F.col("rest")["UserId"].alias("user_id"),
        F.col("rest")["ItemCount"].alias("item_count"), F.col("rest")["Extra"].alias("extra"), F.size("rest").alias("others"),
    )


def ingest_distinct_lines(spark, sf_dir):
    lines = event_lines(spark, sf_dir).select("value")
    return lines.unionByName(lines).dropDuplicates()


def ingest_high_watermark(spark, sf_dir):
    paths = events(spark, sf_dir).select(t.source_folder(_landing_path("ts")).alias("source_folder"))
    return a.high_watermark(paths)


def file_audit_log(spark, sf_dir):
    lines = read_lines(spark, landed_lines(spark, sf_dir))
    read = Observation("lines_read")
    per_folder = lines.observe(read, F.count(F.lit(1)).alias("n"))
    stored = tables.write_version(per_folder.select("value"), staging_path(spark, "stored"))
    return a.file_audit(lines, read.get["n"], stored, "CREATE", {"numOutputRows": read.get["n"]}).select(
        "source_folder", "total_records_read", "version", "operation",
        F.col("operation_metrics")["numOutputRows"].alias("rows_written"),
    )


def audit_latest_version(spark, sf_dir):
    """Write history of one version per event day; the newest row."""
    history = events(spark, sf_dir).groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("rows_in")).select(
        F.datediff("day", F.lit("2024-01-01")).cast("bigint").alias("version"), F.lit("MERGE").alias("operation"), "rows_in"
    )
    return a.latest_version(history)


_LINES = """
WITH ln AS (SELECT ts, user_id, event_id, event_type, props, concat('{"time": "', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '0Z", "Name": "', event_type,
  '", "UserId": "u', CAST(user_id AS VARCHAR), '", "ItemCount": ', CAST(event_id AS VARCHAR), ', "Properties": ', props, '}') AS value,
  strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS h FROM events)"""

# --- quality and schemas --------------------------------------------------


def _channels(spark, sf_dir):
    return gold.user_channels(app_events(spark, sf_dir)).withColumn("date", F.col("date").cast("string"))


def expect_or_drop(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("client_type", F.nullif("event_type", F.lit("error")))
    return quality.expect_or_drop(rows, quality.not_null("client_type")).select("event_id", "client_type")


def expect_report(spark, sf_dir):
    suite = [quality.matches_date_format("date", "%Y-%m-%d"), quality.between("interactions", "0", "700")]
    path = staging_path(spark, "suite")
    quality.save_suite(spark, suite, path)
    return quality.report(_channels(spark, sf_dir), quality.load_suite(spark, path))


def expectation_round_trip(spark, sf_dir):
    """Three rules in one pass over the events of two datasets; the report on the log that this wrote, with rows kept and in quarantine."""
    root, log = staging_path(spark, "judged"), staging_path(spark, "judged-log")
    suite = [quality.not_null("client_type"), quality.between("k", "0", "60"), quality.Expectation("odd user", "user_id % 2 = 1", "event_type = 'click'")]
    rows = events(spark, sf_dir).withColumns({
        "client_type": F.nullif("event_type", F.lit("error")), "k": t.extract_int("props", r'"k": (\d+)')})
    counts = None
    for dataset, part in (("early", F.to_date("ts") < "2024-01-16"), ("late", F.to_date("ts") >= "2024-01-16")):
        good, bad = quality.split_by_expectations(rows.where(part), suite, f"{root}/{dataset}", log, dataset, 0)
        told = good.agg(F.count(F.lit(1)).alias("kept")).crossJoin(bad.agg(F.count(F.lit(1)).alias("quarantined"))).withColumn("dataset", F.lit(dataset))
        counts = told if counts is None else counts.unionByName(told)
    return logs.expectation_report(spark.read.parquet(log).select("id", "timestamp", "details")).join(counts, "dataset")


def sketch_users(spark, sf_dir):
    """Users per client type over a week's sketches, and whether the exact count lies within the stated bound."""
    rows = app_events(spark, sf_dir).where("date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'")
    sketches = stage(gold.user_sketches(app_events(spark, sf_dir)), "user-sketches")
    told = gold.users_of(sketches.where("date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'"), ["client_type"])
    exact = rows.groupBy("client_type").agg(F.count_distinct("user_id").alias("exact"))
    return told.join(exact, "client_type").select("client_type", "exact", (F.abs(F.col("users") - F.col("exact")) <= F.col("bound")).alias("within"))


def schema_enforce(spark, sf_dir):
    rows = gold.client_type_distribution(app_events(spark, sf_dir))
    return tables.enforce_schema(rows, CLIENT_TYPE_DISTRIBUTION).withColumn("percent_users", F.round("percent_users", 6))


def schema_hints(spark, sf_dir):
    path = staging_path(spark, "hinted")
    event_lines(spark, sf_dir).select("value").write.text(path)
    schema = jsonlines.infer_schema(spark, path, "Properties MAP<STRING,STRING>, ItemCount STRING")
    return spark.read.schema(schema).json(path).select(
        F.col("ItemCount").alias("item_count"), F.col("Properties")["k"].alias("k"), F.col("Name").alias("name")
    )


def json_malformed_capture(spark, sf_dir):
    """A third of the lines is cut short, a third has a text where a number belongs."""
    broken = (
        F.when(F.col("event_id") % 3 == 0, F.substr("props", F.lit(1), F.lit(4)))
        .when(F.col("event_id") % 3 == 1, F.regexp_replace("props", r"(\d+)", '"n$1"'))
        .otherwise(F.col("props"))
    )
    path = staging_path(spark, "broken")
    events(spark, sf_dir).select(broken).write.text(path)
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return jsonlines.read_events(spark, path, schema).select("k", jsonlines.CORRUPT)


def schema_widening(spark, sf_dir):
    """Three landings: a count that is an int, then a double, then a text, with a flag that comes second. Types and rows after each."""
    source, store, table = (staging_path(spark, x) for x in ("widening", "widening-schemas", "widening-rows"))
    number, day = F.col("event_id").cast("string"), F.dayofmonth("ts")
    count = F.when(day <= 10, number).when(day <= 20, F.concat(number, F.lit(".5"))).otherwise(F.concat(F.lit('"n'), number, F.lit('"')))
    line = F.concat(F.lit('{"id":'), number, F.lit(',"count":'), count, F.when(day > 10, ',"late":true').otherwise(""), F.lit("}"))
    lines = events(spark, sf_dir).select(line.alias("value"), F.greatest(F.ceil(day / 10), F.lit(1)).alias("part"))
    kept, types = SchemaStore(spark, store), []
    for part in ("part <= 1", "part = 2", "part >= 3"):
        folder = f"{source}/{staging_path(spark, 'part').rsplit('/', 1)[1]}"
        lines.where(part).select("value").write.text(folder)
        schema = kept.update(source)
        types.append(schema["count"].dataType.simpleString())
        kept.append(jsonlines.rescue_events(spark.read.text(folder), schema), table)
    rows = kept.read(table)
    return rows.select("id", "count", "late", jsonlines.CORRUPT, F.lit(",".join(types)).alias("types"))


def rescue_single_fields(spark, sf_dir):
    """A line in three has a text for its number, one in five an undeclared field, one in seven is cut short."""
    number = F.col("event_id").cast("string")
    line = F.concat(
        F.lit('{"id":'), number, F.lit(',"user":"u'), F.col("user_id").cast("string"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('","n":"x'), number, F.lit('"'))).otherwise(F.concat(F.lit('","n":'), number)),
        F.when(F.col("event_id") % 5 == 0, ',"extra":{"a":[1,2]}').otherwise(""), F.lit(',"ratio":0.5}'))
    path = staging_path(spark, "rescue")
    events(spark, sf_dir).select(F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{"), number)).otherwise(line)).write.text(path)
    schema = T.StructType.fromDDL("id long, user string, n int, ratio double")
    # The folder is this run's own; its name is not part of the result.
    rows = jsonlines.rescue_events(spark.read.text(path).select("value", "_metadata.file_path"), schema, F.lit("here"))
    return rows.drop("file_path")


def schema_evolve_union(spark, sf_dir):
    """Two appends, the second with a new column; read back merged."""
    rows = events(spark, sf_dir)
    path = staging_path(spark, "evolving")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    tables.append(rows.where(F.col("ts") < middle).select("event_id", "user_id"), path)
    tables.append(rows.where(F.col("ts") >= middle).select("event_id", "user_id", "event_type"), path)
    wanted = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()), T.StructField("region", T.StringType()),
    ])
    return c.with_expected(tables.read_appended(spark, path), wanted)


# --- SQL side -------------------------------------------------------------

ORACLES = {
    "gold_daily_users": _APP + " SELECT date, count(DISTINCT user_id) AS total_users FROM app GROUP BY 1",
    "gold_client_type_distribution": _APP + """,
        tu AS (SELECT date, count(DISTINCT user_id) AS total_users FROM app GROUP BY 1)
        SELECT date, client_type, count(DISTINCT user_id) AS user_base, any_value(total_users) AS total_users,
          round(count(DISTINCT user_id) / any_value(total_users) * 100.0::DOUBLE, 6) AS percent_users
        FROM app JOIN tu USING (date) GROUP BY 1, 2""",
    "gold_incremental": _CHANGED + """,
        totals AS (SELECT date, count(DISTINCT user_id) AS total_users FROM app GROUP BY 1)
        SELECT date, client_type, count(DISTINCT user_id) AS user_base, any_value(total_users) AS total_users,
          round(count(DISTINCT user_id) / CAST(any_value(total_users) AS DOUBLE) * 100.0, 6) AS percent_users,
          CASE WHEN date BETWEEN DATE '2024-01-13' AND DATE '2024-01-16' THEN 2 WHEN date BETWEEN DATE '2024-01-10' AND DATE '2024-01-14' THEN 1 ELSE 0 END AS delivery
        FROM app JOIN totals USING (date) GROUP BY 1, 2""",
    "gold_incremental_channels": _CHANGED + """ SELECT date, user_id, activity_type, CAST(sum(item_count) AS DOUBLE) AS interactions,
        string_agg(DISTINCT app_role_name, ',' ORDER BY app_role_name) AS communication_channel FROM app GROUP BY 1, 2, 3""",
    "gold_incremental_users": _CHANGED + " SELECT date, count(DISTINCT user_id) AS total_users FROM app GROUP BY 1",
    "gold_user_channel": _APP + """ SELECT date, user_id, activity_type, CAST(sum(item_count) AS DOUBLE) AS interactions,
        array_to_string(list_sort(list(DISTINCT app_role_name)), ',') AS communication_channel FROM app GROUP BY 1, 2, 3""",
    "dedupe_latest": """SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "upsert_latest": _LATEST + """ SELECT * FROM tn UNION ALL
        SELECT * FROM cn WHERE NOT EXISTS (SELECT 1 FROM tn WHERE cn.user_id = tn.user_id AND cn.event_type = tn.event_type)""",
    "cdc_scd1": """SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "bucketed_upsert": _LATEST + """ SELECT * FROM tn UNION ALL
        SELECT * FROM cn WHERE NOT EXISTS (SELECT 1 FROM tn WHERE cn.user_id = tn.user_id AND cn.event_type = tn.event_type)""",
    "merge_metrics": _FED + """,
        w AS (SELECT *, max(seq) OVER (PARTITION BY user_id, event_type ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM dl)
        SELECT version, count(*) FILTER (WHERE was IS NULL) AS inserted, count(*) FILTER (WHERE seq > was) AS updated,
          count(*) FILTER (WHERE seq <= was) AS unchanged FROM w GROUP BY 1""",
    **{name: _FED + """,
        j AS (SELECT max(seq) FILTER (WHERE version = 0) % 1000000000 AS oid, max(seq) % 1000000000 AS nid FROM dl GROUP BY user_id, event_type)
        SELECT e.*, 'insert' AS _change_type FROM j JOIN events e ON e.event_id = j.nid WHERE oid IS NULL UNION ALL
        SELECT e.*, 'update_preimage' FROM j JOIN events e ON e.event_id = j.oid WHERE nid <> oid UNION ALL
        SELECT e.*, 'update_postimage' FROM j JOIN events e ON e.event_id = j.nid WHERE nid <> oid"""
       for name in ("change_feed", "change_feed_folders")},
    "upsert_partial": _SIDES + """
        SELECT coalesce(o.event_id, n.event_id) AS event_id, coalesce(o.ts, n.ts) AS ts, coalesce(o.user_id, n.user_id) AS user_id,
          coalesce(o.event_type, n.event_type) AS event_type, coalesce(n.value, o.value) AS value, coalesce(n.props, o.props) AS props
        FROM o FULL JOIN n ON o.user_id = n.user_id AND o.event_type = n.event_type""",
    "table_diff": _SIDES + """,
        j AS (SELECT o.event_id AS oid, n.event_id AS nid FROM o FULL JOIN n ON o.user_id = n.user_id AND o.event_type = n.event_type)
        SELECT e.*, 'insert' AS _change_type FROM j JOIN events e ON e.event_id = j.nid WHERE oid IS NULL UNION ALL
        SELECT e.*, 'delete' FROM j JOIN events e ON e.event_id = j.oid WHERE nid IS NULL UNION ALL
        SELECT e.*, 'update_preimage' FROM j JOIN events e ON e.event_id = j.oid WHERE nid <> oid UNION ALL
        SELECT e.*, 'update_postimage' FROM j JOIN events e ON e.event_id = j.nid WHERE nid <> oid""",
    "cluster_by_time": "SELECT * FROM events",
    "snapshot_roundtrip": "SELECT * FROM events",
    "json_to_map": "SELECT event_id, CAST(event_id AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS absent, 2 AS entries FROM events",
    "json_nested_map": _PROPS + " SELECT event_id, k, 'a=1, b=2' AS note FROM pr",
    "kv_text_to_map": _PROPS + ' SELECT event_id, CAST(k AS INTEGER) AS k, CAST(user_id AS INTEGER) AS "user", CAST(NULL AS INTEGER) AS bad FROM pr',
    "map_explode": _PROPS + """ SELECT event_id, 'k' AS key, k AS value FROM pr UNION ALL
        SELECT event_id, concat('on_', event_type), CAST(user_id AS VARCHAR) FROM pr""",
    "map_flatten_dynamic": _PROPS + " SELECT event_id, k AS Properties_k" + "".join(
        f", CASE WHEN event_type = '{e}' THEN CAST(user_id AS VARCHAR) END AS Properties_on_{e}"
        for e in ("click", "error", "purchase", "signup", "view")
    ) + " FROM pr",
    "props_project": _PROPS + """ SELECT event_id, k, CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) END AS clicked_by,
        CAST(NULL AS VARCHAR) AS nothing FROM pr""",
    "pivot_properties": _PROPS + """ SELECT event_id, k, CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) END AS on_click,
        CASE WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR) END AS on_view,
        CASE WHEN event_type NOT IN ('click', 'view') THEN concat('{"on_', event_type, '":"', CAST(user_id AS VARCHAR), '"}') END AS rest FROM pr""",
    "regex_extract_int": "SELECT page_id, TRY_CAST(regexp_extract(url, 'page=([0-9]+)', 1) AS INTEGER) AS page FROM pages",
    "md5_row_key": "SELECT event_id, md5(props) AS line_md5 FROM events",
    "path_partition_key": """SELECT event_id, strftime(ts, '%Y%m%d%H') || '00' AS partition_key,
        strftime(ts, '%Y-%m-%d:%H') AS source_folder FROM events""",
    "cast_safe": """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value,
        CASE WHEN event_id % 5 <> 0 THEN CAST(ts AS DATE) END AS day FROM events""",
    "hourly_suffixes": """WITH sp AS (SELECT user_id, min(date_trunc('hour', ts)) AS a, max(date_trunc('hour', ts)) AS z FROM events GROUP BY 1),
        hs AS (SELECT user_id, unnest(generate_series(a + INTERVAL 1 HOUR, z, INTERVAL 1 HOUR)) AS hr FROM sp)
        SELECT user_id, strftime(hr, 'y=%Y/m=%m/d=%d/h=%H/m=00') AS suffix FROM hs""",
    "jsonl_text_parse": _LINES + """ SELECT md5(value) AS line_md5, replace(day, '-', '') || h || '00' AS partition_key,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0Z' AS time, event_type AS name, concat('u', CAST(user_id AS VARCHAR)) AS user_id,
        CAST(event_id AS VARCHAR) AS item_count, regexp_extract(props, '"k": ([0-9]+)', 1) AS k FROM ln""",
    "ingest_all_fields": """SELECT event_type AS name, regexp_extract(props, '"k": ([0-9]+)', 1) AS k, concat('u', CAST(user_id AS VARCHAR)) AS user_id,
        CAST(event_id AS VARCHAR) AS item_count, CASE WHEN second(ts) < 20 THEN concat('x', CAST(second(ts) AS VARCHAR)) END AS extra,
        CAST(CASE WHEN second(ts) < 20 THEN 3 ELSE 2 END AS INTEGER) AS others FROM events""",
    "ingest_distinct_lines": _LINES + " SELECT DISTINCT value FROM ln",
    "ingest_high_watermark": "SELECT max(strftime(ts, '%Y-%m-%d:%H')) AS high_watermark FROM events",
    "file_audit_log": _LINES + """ SELECT DISTINCT day || ':' || h AS source_folder, (SELECT count(*) FROM events) AS total_records_read,
        CAST(0 AS BIGINT) AS version, 'CREATE' AS operation, (SELECT CAST(count(*) AS VARCHAR) FROM events) AS rows_written FROM ln""",
    "audit_latest_version": """SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS version, 'MERGE' AS operation,
        count(*) AS rows_in FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 1""",
    "expect_or_drop": "SELECT event_id, event_type AS client_type FROM events WHERE event_type <> 'error'",
    "expect_report": _APP + """,
        ch AS (SELECT sum(item_count) AS interactions FROM app GROUP BY date, user_id, activity_type)
        SELECT 'date matches %Y-%m-%d' AS expectation, count(*) AS evaluated, CAST(0 AS BIGINT) AS failed, true AS success FROM ch UNION ALL
        SELECT 'interactions between 0 and 700', count(*), count(*) FILTER (WHERE interactions NOT BETWEEN 0 AND 700),
          count(*) FILTER (WHERE interactions NOT BETWEEN 0 AND 700) = 0 FROM ch""",
    "expectation_round_trip": """WITH e AS (SELECT *, CASE WHEN CAST(ts AS DATE) < DATE '2024-01-16' THEN 'early' ELSE 'late' END AS dataset,
          event_type = 'error' AS f0, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) > 60 AS f1, event_type = 'click' AND user_id % 2 <> 1 AS f2 FROM events),
        s AS (SELECT dataset, count(*) AS n, count(*) FILTER (WHERE f0) AS f0, count(*) FILTER (WHERE f1) AS f1, count(*) FILTER (WHERE f2) AS f2,
          count(*) FILTER (WHERE f0 OR f1 OR f2) AS quarantined FROM e GROUP BY 1),
        r AS (SELECT dataset, n, quarantined, unnest(['client_type not null', 'k between 0 and 60', 'odd user']) AS name, unnest([f0, f1, f2]) AS failed FROM s)
        SELECT concat(dataset, '-0') AS id, dataset, name, failed AS failed_records, n - failed AS passed_records, n - quarantined AS kept, quarantined FROM r""",
    "sketch_users": _APP + """ SELECT client_type, count(DISTINCT user_id) AS exact, true AS within FROM app
        WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY 1""",
    "schema_hints": """SELECT CAST(event_id AS VARCHAR) AS item_count, regexp_extract(props, '"k": ([0-9]+)', 1) AS k,
        event_type AS name FROM events""",
    "json_malformed_capture": """SELECT CASE WHEN event_id % 3 = 2 THEN CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) END AS k,
        CASE WHEN event_id % 3 = 0 THEN substr(props, 1, 4) WHEN event_id % 3 = 1 THEN regexp_replace(props, '([0-9]+)', '"n\\1"') END AS _rescued_data
        FROM events""",
    "schema_widening": """SELECT event_id AS id, CASE WHEN day(ts) <= 10 THEN CAST(event_id AS VARCHAR) WHEN day(ts) <= 20 THEN concat(CAST(event_id AS VARCHAR), '.5')
          ELSE concat('n', CAST(event_id AS VARCHAR)) END AS count, CASE WHEN day(ts) > 10 THEN true END AS late, CAST(NULL AS VARCHAR) AS _rescued_data,
        'int,double,string' AS types FROM events""",
    "rescue_single_fields": """SELECT CASE WHEN event_id % 7 <> 0 THEN event_id END AS id, CASE WHEN event_id % 7 <> 0 THEN concat('u', CAST(user_id AS VARCHAR)) END AS user,
        CASE WHEN event_id % 7 <> 0 AND event_id % 3 <> 0 THEN CAST(event_id AS INTEGER) END AS n, CASE WHEN event_id % 7 <> 0 THEN 0.5::DOUBLE END AS ratio,
        CASE WHEN event_id % 7 = 0 THEN concat('{"_line":"{', event_id, '","_file_path":"here"}')
          WHEN event_id % 5 = 0 OR event_id % 3 = 0 THEN concat('{', CASE WHEN event_id % 5 = 0 THEN '"extra":{"a":[1,2]},' ELSE '' END,
            CASE WHEN event_id % 3 = 0 THEN concat('"n":"x', event_id, '",') ELSE '' END, '"_file_path":"here"}') END AS _rescued_data FROM events""",
    "schema_evolve_union": """SELECT event_id, user_id, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN event_type END AS event_type,
        CAST(NULL AS VARCHAR) AS region FROM events""",
}
ORACLES["schema_enforce"] = ORACLES["gold_client_type_distribution"]

QUERIES = {name: globals()[name] for name in ORACLES}
