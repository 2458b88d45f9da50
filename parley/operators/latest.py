"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.staging import stage

_ALONE = "__alone"

#: Up to this many repeated keys are sent to every task.
MANY_REPEATED = 1 << 18


def comparable(value: Column, kind: T.DataType) -> Column:
    """A value that can be hashed and compared: a map as its sorted entries."""
    if isinstance(kind, T.MapType) and "map<" not in kind.valueType.simpleString():
        return F.array_sort(F.map_entries(value))
    return F.to_json(value) if "map<" in kind.simpleString() else value  # maps inside other values


def row_digest(df: DataFrame, leave_out: Sequence[str] = ()) -> Column:
    """64-bit digest of a row."""
    parts = [comparable(F.col(f.name), f.dataType) for f in df.schema.fields if f.name not in leave_out]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("bigint")


def any_key_null(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for key in keys:
        out = out | F.col(key).isNull()
    return out


def newest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    null_keys: str = "append",
) -> DataFrame:
    """Keep the row with the greatest ``sequence`` tuple for every key.

    This is an aggregate, so rows of a hot key are reduced before the shuffle;
    a ranking window would move them all into one task. Ties are broken by the
    row digest, so the result does not depend on input order.

    ``null_keys``: rows with a missing key are all kept (``append``), reduced
    as one key (``collapse``) or removed (``drop``).
    """
    if null_keys not in ("append", "collapse", "drop"):
        raise ValueError(f"null_keys: {null_keys}")
    others = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in sequence], row_digest(df, keys))
    grouping = list(keys)
    if null_keys == "drop":
        df = df.where(~any_key_null(keys))
    elif null_keys == "append":
        # A row without key is a group of its own, so one scan and one aggregate serve both kinds.
        df = df.withColumn(_ALONE, F.when(any_key_null(keys), F.monotonically_increasing_id()))
        grouping.append(_ALONE)
    return (
        df.groupBy(*grouping)
        .agg(F.max_by(F.struct(*others), rank).alias("__row"))
        .select(*keys, *[F.col("__row")[c].alias(c) for c in others])
        .select(*[c for c in df.columns if c != _ALONE])
    )


def newest_of_repeated(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """The rows of :func:`newest_per_key`, for stored tables whose keys seldom repeat.

    The keys alone are counted first. Rows whose key comes once, or is missing, stay where they are:
    they are neither shuffled nor read in columns that nobody asks for. Where many keys repeat, all rows are reduced.
    """
    repeated = stage(
        df.where(~any_key_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*keys),
        "repeated-keys",
    )
    found = repeated.count()
    if not found:
        return df
    if found > MANY_REPEATED:
        return newest_per_key(df, keys, sequence)
    keys = list(keys)
    once = df.join(F.broadcast(repeated), keys, "left_anti")
    newest = newest_per_key(df.join(F.broadcast(repeated), keys, "left_semi"), keys, sequence, "drop")
    return once.unionByName(newest).select(*df.columns)
