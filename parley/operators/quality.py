"""Data expectations: drop, report, quarantine with an event log, and suites kept as JSON."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Date directives and their pattern letters.
DATE_DIRECTIVES = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss"}


@dataclass(frozen=True)
class Expectation:
    """``holds`` must be true wherever ``applies`` is (both SQL conditions)."""

    name: str
    holds: str
    applies: str = "true"


def matches_date_format(column: str, directives: str) -> Expectation:
    """Text of ``column`` can be read by a strftime format; missing values are skipped."""
    pattern = directives
    for directive, letters in DATE_DIRECTIVES.items():
        pattern = pattern.replace(directive, letters)
    return Expectation(
        f"{column} matches {directives}",
        f"try_to_timestamp({column}, '{pattern}') IS NOT NULL",
        f"{column} IS NOT NULL",
    )


def between(column: str, low: float | str, high: float | str) -> Expectation:
    """Values within bounds (numbers, also given as text); missing values are skipped."""
    return Expectation(
        f"{column} between {low} and {high}",
        f"{column} BETWEEN CAST('{low}' AS DOUBLE) AND CAST('{high}' AS DOUBLE)",
        f"{column} IS NOT NULL",
    )


def not_null(column: str) -> Expectation:
    return Expectation(f"{column} not null", f"{column} IS NOT NULL")


def expect_or_drop(
    df: DataFrame, expectation: Expectation, observation: Observation | str | None = None
) -> DataFrame:
    """Rows that meet the expectation; an unknown outcome counts as failed.

    The observation, if given, reports ``passed`` and ``failed`` rows.
    """
    ok = F.coalesce(F.expr(f"NOT ({expectation.applies}) OR ({expectation.holds})"), F.lit(False))
    if observation is not None:
        df = df.observe(
            observation, F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed")
        )
    return df.where(ok)


def report(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """One row per expectation with evaluated and failed rows, from one pass."""
    aggregates, rows = [], []
    for i, e in enumerate(suite):
        applies = F.coalesce(F.expr(e.applies), F.lit(False))
        holds = F.coalesce(F.expr(e.holds), F.lit(False))
        aggregates += [F.count_if(applies).alias(f"n{i}"), F.count_if(applies & ~holds).alias(f"f{i}")]
        rows.append(F.struct(
            F.lit(e.name).alias("expectation"), F.col(f"n{i}").alias("evaluated"), F.col(f"f{i}").alias("failed"),
            (F.col(f"f{i}") == 0).alias("success"),
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def failed_rules(suite: Sequence[Expectation]) -> Column:
    """Bit i is set where expectation i does not hold; an unknown outcome counts as failed."""
    if len(suite) > 63:
        raise ValueError("a mask holds 63 expectations")
    mask = F.lit(0).cast("bigint")
    for i, e in enumerate(suite):
        ok = F.coalesce(F.expr(f"NOT ({e.applies}) OR ({e.holds})"), F.lit(False))
        mask = mask.bitwiseOR(F.when(ok, F.lit(0)).otherwise(F.lit(1 << i)).cast("bigint"))
    return mask


def split_by_expectations(
    df: DataFrame, suite: Sequence[Expectation], root: str, log: str, dataset: str, run: int
) -> tuple[DataFrame, DataFrame]:
    """Judge all rows by all expectations in one pass; returns rows that meet them and rows in quarantine.

    Both lie below ``root/run=N``; quarantined rows have ``_failed``, the bit mask of the expectations they miss. The
    counts become one entry of the event log below ``log``, in the shape that ``logs.expectation_report`` reads.
    It is written last, to a folder of the run, so a repeated run replaces rows and entry alike.
    """
    spark, seen = df.sparkSession, Observation()
    marked = df.withColumn("_failed", failed_rules(suite))
    counts = [F.count(F.lit(1)).alias("all")] + [
        F.count_if(F.col("_failed").bitwiseAND(F.lit(1 << i)) != 0).alias(f"f{i}") for i in range(len(suite))
    ] + [F.count_if(F.col("_failed") != 0).alias("dropped")]
    folder = f"{root}/run={run}"
    marked.observe(seen, *counts).withColumn("_kept", F.col("_failed") == 0).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").partitionBy("_kept").parquet(folder)
    told = seen.get
    expectations = [
        {"name": e.name, "dataset": dataset, "passed_records": told["all"] - told[f"f{i}"], "failed_records": told[f"f{i}"]} for i, e in enumerate(suite)
    ]
    details = {"flow_progress": {
        "metrics": {"num_output_rows": told["all"] - told["dropped"]},
        "data_quality": {"dropped_records": told["dropped"], "expectations": expectations},
    }}
    entry = spark.range(1).select(F.lit(f"{dataset}-{run}").alias("id"), F.current_timestamp().alias("timestamp"), F.lit(json.dumps(details)).alias("details"))
    entry.write.mode("overwrite").parquet(f"{log}/dataset={dataset}/run={run}")
    kept = spark.read.schema(T.StructType([*marked.schema.fields, T.StructField("_kept", T.BooleanType())])).parquet(folder)
    return kept.where("_kept").select(*df.columns), kept.where("NOT _kept").select(*df.columns, "_failed")


def names_of(mask: Column, suite: Sequence[Expectation]) -> Column:
    """The names of the expectations in a mask."""
    return F.array_compact(F.array(*[F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(e.name)) for i, e in enumerate(suite)]))


def save_suite(spark: SparkSession, suite: Sequence[Expectation], path: str) -> None:
    """Write a suite as JSON lines to a new folder."""
    lines = [(json.dumps(asdict(e)),) for e in suite]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(path)


def load_suite(spark: SparkSession, path: str) -> list[Expectation]:
    return [Expectation(**json.loads(r[0])) for r in spark.read.text(path).collect()]
