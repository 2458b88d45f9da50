"""Ordered operators that never gather one group into one task.

A plain window over a conversation puts the whole conversation into one task,
which fails when one conversation holds a large share of all rows. Here the
ordered axis of every group is cut into slices. A window runs inside each
(group, slice), and what must flow across slices (a running total, the last
value seen) travels as one extra *carry* row per slice, computed from a table
with one row per (group, slice).

Bounds. With ``minute_slice`` a group that is confined to one day has at most
1,440 slices (one more for missing times), and a slice holds one minute of one
group. With ``block_slice`` a slice holds at most 16,384 positions by
construction and a group of N rows has N / 16,384 slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A slice of dense positions holds 2 ** BLOCK_BITS of them (16,384).
BLOCK_BITS = 14

#: Slice number of rows without a time: they sort last.
LAST_SLICE = (1 << 62)

_MARK = "__is_row"
_SLICE = "__slice"


def minute_slice(df: DataFrame, time: str, minutes: int = 1) -> Column:
    """Number of the ``minutes``-wide slice a row's time falls into."""
    col = F.col(time)
    if isinstance(df.schema[time].dataType, T.TimestampNTZType):
        # Wall-clock minutes; no zone conversion, so always monotone.
        total = F.datediff(col.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 1440 \
            + F.hour(col) * 60 + F.minute(col)
    else:
        total = F.floor(F.unix_seconds(col) / 60)
    return F.coalesce(F.floor(total / F.lit(minutes)).cast("bigint"), F.lit(LAST_SLICE))


def block_slice(position: str) -> Column:
    """Slice of a dense position: 16,384 consecutive positions each."""
    return F.shiftright(F.col(position), BLOCK_BITS).cast("bigint")


def order_key(*columns: str) -> Column:
    """Comparable struct that sorts like the columns with missing values last."""
    parts = []
    for c in columns:
        parts += [F.col(c).isNull().alias(f"{c}_missing"), F.col(c).alias(c)]
    return F.struct(*parts)


def _nulls_last(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    slice_by: Column,
    totals: Mapping[str, Column],
    group_totals: Mapping[str, Column] | None = None,
    group_max: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add inclusive running sums of ``totals`` and whole-group sums and maxima.

    ``slice_by`` must be non-decreasing along ``order_by``. Group values reach
    the rows on the carry rows, so a large group needs no join on its key.
    ``df`` is read twice: once for the values per slice, once for the rows.
    """
    group_totals, group_max = dict(group_totals or {}), dict(group_max or {})
    rows = df.withColumns(
        {_SLICE: slice_by, **{f"__v_{name}": value.cast("bigint") for name, value in totals.items()}}
    )

    sums = {**totals, **group_totals}
    per_slice = (
        df.select(
            *keys,
            slice_by.alias(_SLICE),
            *[v.cast("bigint").alias(f"__v_{n}") for n, v in sums.items()],
            *[v.alias(f"__v_{n}") for n, v in group_max.items()],
        )
        .groupBy(*keys, _SLICE)
        .agg(*[F.sum(f"__v_{n}").alias(f"__v_{n}") for n in sums], *[F.max(f"__v_{n}").alias(f"__v_{n}") for n in group_max])
    )
    group = Window.partitionBy(*keys)
    before = group.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_slice.select(
        *keys,
        _SLICE,
        F.lit(0).alias(_MARK),
        *[F.coalesce(F.sum(f"__v_{n}").over(before), F.lit(0)).alias(f"__v_{n}") for n in totals],
        *[F.sum(f"__v_{n}").over(group).alias(f"__g_{n}") for n in group_totals],
        *[F.max(f"__v_{n}").over(group).alias(f"__g_{n}") for n in group_max],
    )

    merged = rows.withColumn(_MARK, F.lit(1)).unionByName(carry, allowMissingColumns=True)
    # The slice comes first: sorting compares the first column's prefix before whole rows.
    upto = (
        Window.partitionBy(_SLICE, *keys)
        .orderBy(_MARK, *_nulls_last(order_by))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    whole = [*group_totals, *group_max]
    return (
        merged.withColumns(
            {name: F.sum(f"__v_{name}").over(upto) for name in totals}
            | {name: F.first(f"__g_{name}").over(upto) for name in whole}
        )
        .where(F.col(_MARK) == 1)
        .select(*df.columns, *totals, *whole)
    )


def position(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    slice_by: Column,
    name: str = "pos",
) -> DataFrame:
    """Zero-based position of each row within its group."""
    out = running_totals(df, keys, order_by, slice_by, {name: F.lit(1)})
    return out.withColumn(name, F.col(name) - 1)


def fill_forward(
    rows: DataFrame,
    marks: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    ties: Sequence[str],
    slice_name: str,
    values: Sequence[str],
) -> DataFrame:
    """Give every row the ``values`` of the latest mark before it.

    ``rows`` and ``marks`` both carry ``keys``, the ``order_by`` columns, the
    ``ties`` columns (which order rows and marks that share a place) and the
    slice number ``slice_name``. The values of a mark are packed into one
    struct, so a mark with missing values resets the fill.
    """
    packed = marks.withColumn("__mark", F.struct(*values)).drop(*values)

    # Last mark of each slice, pushed on to the later slices that hold rows.
    last_mark = packed.groupBy(*keys, slice_name).agg(
        F.max_by("__mark", order_key(*order_by, *ties)).alias("__mark")
    )
    before = Window.partitionBy(*keys).orderBy(slice_name).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        rows.select(*keys, slice_name)
        .distinct()
        .unionByName(last_mark, allowMissingColumns=True)
        .groupBy(*keys, slice_name)
        .agg(F.first("__mark", ignorenulls=True).alias("__mark"))
        .withColumn("__mark", F.last("__mark", ignorenulls=True).over(before))
        .where(F.col("__mark").isNotNull())
        .withColumn(_MARK, F.lit(0))
    )

    merged = (
        rows.withColumn(_MARK, F.lit(2))
        .unionByName(packed.withColumn(_MARK, F.lit(1)), allowMissingColumns=True)
        .unionByName(carry, allowMissingColumns=True)
    )
    inside = (
        Window.partitionBy(*keys, slice_name)
        .orderBy((F.col(_MARK) != 0).cast("int"), *_nulls_last([*order_by, *ties]))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = merged.withColumn("__mark", F.last("__mark", ignorenulls=True).over(inside)).where(F.col(_MARK) == 2)
    return filled.select(*rows.columns, *[F.col("__mark")[v].alias(v) for v in values])
