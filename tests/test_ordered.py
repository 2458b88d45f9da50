import random

from pyspark.sql import functions as F

from parley.operators import ordered


def _rows(seed, n):
    rng = random.Random(seed)
    return [(rng.choice("ab"), i, rng.choice([0, 1, 2])) for i in rng.sample(range(n * 2), n)]


def test_running_totals_across_slices(spark):
    rows = _rows(1, 300)
    df = spark.createDataFrame(rows, "g string, p long, v int")
    out = ordered.running_totals(
        df, ["g"], ["p"], F.floor(F.col("p") / 7).cast("bigint"), {"upto": F.col("v")}, {"whole": F.col("v")}
    ).collect()
    for r in out:
        assert r.upto == sum(v for g, p, v in rows if g == r.g and p <= r.p)
        assert r.whole == sum(v for g, p, v in rows if g == r.g)
    assert len(out) == len(rows)


def test_position_orders_missing_times_last(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', TIMESTAMP_NTZ'2024-01-01 00:00:30', 3), ('a', NULL, 1), "
        "('a', TIMESTAMP_NTZ'2024-01-01 09:00:00', 2), ('b', NULL, 5) AS t(g, time, id)"
    )
    out = ordered.position(df, ["g"], ["time", "id"], ordered.minute_slice(df, "time"))
    assert {(r.g, r.id, r.pos) for r in out.collect()} == {("a", 3, 0), ("a", 2, 1), ("a", 1, 2), ("b", 5, 0)}


def test_minute_slice_of_both_timestamp_types_is_monotone(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP'2024-10-26 20:00:00', TIMESTAMP'2024-10-27 06:00:00', INTERVAL 7 MINUTES)) AS a")
    df = df.withColumn("b", F.col("a").cast("timestamp_ntz"))
    out = df.select(
        "a", ordered.minute_slice(df, "a", 10).alias("x"), ordered.minute_slice(df, "b", 10).alias("y")
    ).orderBy("a").collect()
    assert [r.x for r in out] == sorted(r.x for r in out)
    assert [r.y for r in out] == sorted(r.y for r in out)
    assert len({r.x for r in out}) > 50


def test_fill_forward_across_slices_and_reset(spark):
    rng = random.Random(3)
    rows = [("a", p, 1) for p in range(100)] + [("b", p, 1) for p in range(5)]
    marks = {(g, p): rng.choice([None, 1, 2, 3]) for g, p in [("a", rng.randrange(100)) for _ in range(12)]}
    left = spark.createDataFrame(rows, "g string, p long, side int").withColumn("s", F.floor(F.col("p") / 9).cast("bigint"))
    right = spark.createDataFrame(
        [(g, p, rng.choice([0, 2]), v) for (g, p), v in marks.items()], "g string, p long, side int, v int"
    ).withColumn("s", F.floor(F.col("p") / 9).cast("bigint"))
    placed = {(r.g, r.p): (r.side, r.v) for r in right.collect()}
    out = ordered.fill_forward(left, right, ["g"], ["p"], ["side"], "s", ["v"]).collect()
    assert len(out) == 105
    for r in out:
        before = [(p, v) for (g, p), (side, v) in placed.items() if g == r.g and (p < r.p or (p == r.p and side == 0))]
        assert r.v == (max(before, key=lambda m: m[0])[1] if before else None)
