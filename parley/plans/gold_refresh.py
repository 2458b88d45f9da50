"""Gold tables from silver: channel use per user, users per client type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.columns import select_paths
from parley.operators import gold, quality
from parley.operators.upsert import table_diff, upsert_partial
from parley.schemas import CLIENT_TYPE_DISTRIBUTION, USER_PREFERRED_CHANNEL
from parley.sources import tables

#: Columns the gold tables read, from silver.
BASE_COLUMNS = {
    "time": "time", "UserId": "user_id", "ClientType": "client_type", "AppRoleName": "app_role_name",
    "ItemCount": "item_count", "Properties.activityType": "activity_type",
}

DISTRIBUTION_KEYS = ["date", "client_type"]

#: Checks on the channel table.
CHANNEL_SUITE = (
    quality.matches_date_format("date", "%Y-%m-%d"),
    quality.between("interactions", "0", "9999999"),
)


def gold_base(silver: DataFrame) -> DataFrame:
    """The columns the gold tables need, with the date of the event."""
    base = select_paths(silver, BASE_COLUMNS)
    return base.withColumn("date", F.to_date(F.col("time").try_cast("timestamp"))).drop("time")


def refresh_user_channels(silver: DataFrame, root: str) -> int:
    """Replace the channel table; undated events have no place in it."""
    rows = gold.user_channels(gold_base(silver).where(F.col("date").isNotNull()))
    return tables.write_version(tables.enforce_schema(rows, USER_PREFERRED_CHANNEL), root)


def refresh_client_types(silver: DataFrame, root: str, drop_missing_type: bool = False) -> int:
    """Merge the distribution into its table: known keys get new figures, the rest is kept.

    ``drop_missing_type`` leaves out rows without a client type.
    """
    spark = silver.sparkSession
    rows = gold.client_type_distribution(gold_base(silver).where(F.col("date").isNotNull()))
    if drop_missing_type:
        rows = quality.expect_or_drop(rows, quality.not_null("client_type"))
    rows = tables.enforce_schema(rows, CLIENT_TYPE_DISTRIBUTION)
    if tables.versions(spark, root):
        stored = tables.read_version(spark, root)
        rows = upsert_partial(stored, rows, DISTRIBUTION_KEYS, ["user_base", "total_users", "percent_users"])
    return tables.write_version(rows, root)


def client_type_changes(spark: SparkSession, root: str, old: int, new: int) -> DataFrame:
    """Change feed of the distribution between two versions."""
    return table_diff(
        tables.read_version(spark, root, old), tables.read_version(spark, root, new), DISTRIBUTION_KEYS
    )


def channel_report(
    spark: SparkSession, root: str, suite: Sequence[quality.Expectation] = CHANNEL_SUITE
) -> DataFrame:
    """Expectation results for the newest channel table."""
    return quality.report(tables.read_version(spark, root).withColumn("date", F.col("date").cast("string")), suite)
