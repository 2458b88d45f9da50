"""Daily user aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_users(events: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct users per date; ``approx`` trades exactness for a small sketch."""
    count = F.approx_count_distinct("user_id") if approx else F.count_distinct("user_id")
    return events.groupBy("date").agg(count.alias("total_users"))


def client_type_distribution(events: DataFrame) -> DataFrame:
    """Users per client type and date, and their share of the users of that date.

    Both counts come from one scan with two grouping sets, reduced per user
    before the shuffle. The total then reaches the client types of its date by
    a window over the result, which has one row per date and client type.
    Undated rows have no total.
    """
    counts = events.groupingSets([["date", "client_type"], ["date"]], "date", "client_type").agg(
        F.count_distinct("user_id").alias("user_base"), F.grouping("client_type").alias("is_total")
    )
    of_date = Window.partitionBy("date")
    total = F.max(F.when(F.col("is_total") == 1, F.col("user_base"))).over(of_date)
    return (
        counts.withColumn("total_users", F.when(F.col("date").isNotNull(), total))
        .where(F.col("is_total") == 0)
        .drop("is_total")
        .withColumn("percent_users", F.try_divide(F.col("user_base"), F.col("total_users")) * F.lit(100.0))
    )


def user_channels(events: DataFrame) -> DataFrame:
    """Interactions and channels used, per date, user and activity type."""
    return events.groupBy("date", "user_id", "activity_type").agg(
        F.sum("item_count").cast("double").alias("interactions"),
        F.array_sort(F.collect_set("app_role_name")).alias("communication_channel"),
    )


#: Standard error of a user sketch, relative to the count: 0.83 / sqrt(2 ** SKETCH_BITS).
SKETCH_BITS = 12
SKETCH_ERROR = 0.83 / 2 ** (SKETCH_BITS / 2)


def user_sketches(events: DataFrame) -> DataFrame:
    """A mergeable sketch of the users per date and client type, of at most a few KB each.

    Sketches of any dates and types can be united later, which counts of distinct users cannot.
    """
    return events.groupBy("date", "client_type").agg(F.hll_sketch_agg(F.col("user_id").cast("string"), SKETCH_BITS).alias("users"))


def users_of(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct users of all rows of sketches, per ``by``, with the bound that three of a thousand estimates miss."""
    united = F.hll_sketch_estimate(F.hll_union_agg("users"))
    return sketches.groupBy(*by).agg(united.alias("users")).withColumn("bound", F.ceil(F.col("users") * 3 * SKETCH_ERROR).cast("bigint"))
