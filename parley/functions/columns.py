"""Projection helpers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path_column(df: DataFrame, path: str) -> Column:
    """A column, or a key of a map column as ``map_column.key``.

    Names match without regard to case. A column or map that is not there
    gives a missing value.
    """
    fields = {f.name.lower(): f for f in df.schema.fields}
    head, _, key = path.partition(".")
    field = fields.get(head.lower())
    if field is None:
        return F.lit(None).cast("string")
    if not key:
        return F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.MapType):
        return F.col(f"`{field.name}`")[key]
    return F.col(f"`{field.name}`.`{key}`")


def select_paths(df: DataFrame, columns: Mapping[str, str], keep: Iterable[Column | str] = ()) -> DataFrame:
    """One projection from ``{source path: new name}``."""
    return df.select(*[path_column(df, path).alias(name) for path, name in columns.items()], *keep)


def with_expected(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in order; absent ones are missing values."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def flatten_map(df: DataFrame, column: str, keys: Sequence[str], prefix: str = "Properties_") -> DataFrame:
    """The keys of a map as columns, in place of the map."""
    return df.select("*", *[F.col(column)[k].alias(f"{prefix}{k}") for k in keys]).drop(column)


def frequent_keys(df: DataFrame, column: str, columns: int) -> list[str]:
    """The ``columns`` most frequent keys of a map column, and one more if there are others; by frequency."""
    counted = df.select(F.explode(F.map_keys(column)).alias("key")).groupBy("key").count()
    return [r.key for r in counted.orderBy(F.desc("count"), "key").limit(columns + 1).collect()]


def flatten_map_dynamic(df: DataFrame, column: str, prefix: str = "Properties_", columns: int = 1000) -> DataFrame:
    """``flatten_map`` with the keys found in the data (one extra pass), in the order of their names.

    A table has room for so many columns only. Entries of less frequent keys
    stay together in the map ``<prefix>rest``, which is there if they are.
    """
    found = frequent_keys(df, column, columns)
    keys = sorted(found[:columns])
    if len(found) <= columns:
        return flatten_map(df, column, keys, prefix)
    rest = F.map_filter(column, lambda k, _: ~k.isin(*keys))
    return flatten_map(df.withColumn(f"{prefix}rest", rest), column, keys, prefix)


def explode_map(df: DataFrame, column: str, key: str = "key", value: str = "value") -> DataFrame:
    """One row per map entry; rows with a missing or empty map have none."""
    return df.select(*[c for c in df.columns if c != column], F.explode(column).alias(key, value))


def pivot_entries(
    df: DataFrame, by: Sequence[str], key: str, value: str, keys: Sequence[str], rest: str = "rest"
) -> DataFrame:
    """Declared entry keys as columns, one row per ``by``; other keys together in the map ``rest``.

    Of several values of a key one that is not missing counts.
    """
    single = df.groupBy(*by, key).agg(F.first(value, ignorenulls=True).alias("__value"))
    other = F.when(~F.col(key).isin(*keys), F.struct(F.col(key), F.col("__value")))
    return single.groupBy(*by).agg(
        *[F.max(F.when(F.col(key) == k, F.col("__value"))).alias(k) for k in keys],
        F.map_from_entries(F.array_sort(F.collect_list(other))).alias(rest),
    )
