"""Gold tables kept up by the change feed of silver: the cost follows the changes.

``facts`` holds, per date, how many events support each (client type, user, activity type, channel), with the
sum of their item counts. A feed adds what it inserts and retracts what it replaces or deletes, so distinct counts
can fall as well as rise: a user counts while any event supports it. Only dates that the feed names are read,
recomputed and written, in the facts and in every gold table.

Deliveries of the feed are numbered and come in order. Delivery N is version N of every table and starts from the facts
before it, so repeating it after a failure gives the same tables and retracts nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.operators import gold
from parley.schemas import CLIENT_TYPE_DISTRIBUTION, DAILY_USERS, USER_PREFERRED_CHANNEL
from parley.sources.partition_versions import PartitionVersions
from parley.sources.tables import enforce_schema
from parley.staging import stage

GRAIN = ["date", "client_type", "user_id", "activity_type", "app_role_name"]
FACTS = T.StructType([
    T.StructField("date", T.DateType(), False),
    *[T.StructField(c, T.StringType()) for c in GRAIN[1:]],
    T.StructField("events", T.LongType()), T.StructField("counted", T.LongType()), T.StructField("items", T.LongType()),
])
#: What one row of a feed does to the number of events.
SIGN = {"insert": 1, "update_postimage": 1, "update_preimage": -1, "delete": -1}


def deltas(feed: DataFrame) -> DataFrame:
    """Signed sums per grain of a feed of events (``GRAIN``, ``item_count``, ``_change_type``); undated events have no place."""
    sign = F.lit(0)
    for kind, value in SIGN.items():
        sign = F.when(F.col("_change_type") == kind, value).otherwise(sign)
    counted = F.when(F.col("item_count").isNotNull(), sign).otherwise(0)
    return (
        feed.where(F.col("date").isNotNull())
        .groupBy(*GRAIN)
        .agg(
            F.sum(sign).cast("bigint").alias("events"), F.sum(counted).cast("bigint").alias("counted"),
            F.coalesce(F.sum(F.col("item_count") * sign), F.lit(0)).cast("bigint").alias("items"),
        )
    )


def user_channels(facts: DataFrame) -> DataFrame:
    """``gold.user_channels`` from facts."""
    return facts.groupBy("date", "user_id", "activity_type").agg(
        F.sum(F.when(F.col("counted") > 0, F.col("items"))).cast("double").alias("interactions"),
        F.array_sort(F.collect_set("app_role_name")).alias("communication_channel"),
    )


class GoldTables:
    """The facts and the gold tables below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.facts = PartitionVersions(spark, f"{root}/facts", FACTS, "date")
        self.tables = {
            "daily_users": (PartitionVersions(spark, f"{root}/daily_users", DAILY_USERS, "date"), gold.daily_users),
            "client_types": (PartitionVersions(spark, f"{root}/client_types", CLIENT_TYPE_DISTRIBUTION, "date"), gold.client_type_distribution),
            "channels": (PartitionVersions(spark, f"{root}/channels", USER_PREFERRED_CHANNEL, "date"), user_channels),
        }

    def apply(self, feed: DataFrame, number: int) -> None:
        """Bring everything to the state after delivery ``number`` of the feed."""
        change = stage(deltas(feed), "gold-deltas")
        dates = change.select("date").distinct()
        # One value per changed date: they choose the folders to read.
        changed = [r[0] for r in dates.collect()]
        before = self.facts.read(changed, upto=number - 1)
        sums = [F.sum(c).alias(c) for c in ("events", "counted", "items")]
        self.facts.replace(before.unionByName(change).groupBy(*GRAIN).agg(*sums).where(F.col("events") > 0), dates, number)
        facts = self.facts.read(changed, upto=number)
        for table, compute in self.tables.values():
            table.replace(enforce_schema(compute(facts), table.schema), dates, number)

    def read(self, name: str) -> DataFrame:
        return self.tables[name][0].read()
