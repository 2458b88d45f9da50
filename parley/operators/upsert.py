"""Keyed table operators on Parquet: upsert, partial update, change feed, clustering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.operators.latest import any_key_null, comparable, newest_per_key, row_digest

_FROM = "__from_changes"


def upsert(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    guard: bool = True,
    preserve: Sequence[str] = (),
    null_keys: str = "append",
) -> DataFrame:
    """The target after the newest change of every key was applied.

    ``guard``: a change older than the stored row loses (the sequence decides,
    equal sequences go to the change). Without it a change always replaces the
    stored row. ``preserve`` columns keep the stored value on a match. New
    columns on either side are allowed. Rows with a missing key never match:
    they are appended, or treated by ``null_keys`` as in ``newest_per_key``.

    One aggregate over both inputs, so rows of a hot key are reduced before
    the single shuffle.
    """
    tagged = target.withColumn(_FROM, F.lit(0)).unionByName(
        changes.withColumn(_FROM, F.lit(1)), allowMissingColumns=True
    )
    order = [*sequence, _FROM] if guard else [_FROM, *sequence]
    newest = newest_per_key(tagged, keys, order, null_keys)
    if preserve:
        stored = [c for c in preserve if c in target.columns]
        kept = (
            target.where(~any_key_null(keys))
            .groupBy(*keys)
            .agg(F.max_by(F.struct(*stored), F.struct(*sequence)).alias("__stored"))
        )
        newest = newest.join(kept, list(keys), "left").withColumns(
            {
                c: F.when(F.col("__stored").isNotNull(), F.col("__stored")[c]).otherwise(F.col(c))
                for c in stored
            }
        )
    return newest.select(*[c for c in tagged.columns if c != _FROM])


def upsert_partial(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], set_columns: Sequence[str]
) -> DataFrame:
    """On a match only ``set_columns`` are replaced; new keys are inserted whole.

    Keys compare null-safe, so a missing key part matches a missing one.
    """
    t = target.withColumn("__t", F.lit(True)).alias("t")
    s = updates.withColumn("__s", F.lit(True)).alias("s")
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
    out = []
    for c in target.columns:
        old = F.col(f"t.{c}")
        new = F.col(f"s.{c}") if c in updates.columns else F.lit(None)
        if c in set_columns:
            value = F.when(F.col("__s").isNotNull(), new).otherwise(old)
        else:
            value = F.when(F.col("__t").isNotNull(), old).otherwise(new)
        out.append(value.alias(c))
    return t.join(s, condition, "full_outer").select(*out)


def table_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Change feed between two versions of a keyed table.

    Without ``null_safe`` the keys are never missing and compare plainly, which leaves the sides' partitioning usable.

    ``_change_type`` is insert, delete, update_preimage or update_postimage;
    rows that did not change are left out.
    """
    columns = list(dict.fromkeys([*old.columns, *new.columns]))
    types = {**dict(new.dtypes), **dict(old.dtypes)}
    kinds = {f.name: f.dataType for f in [*new.schema.fields, *old.schema.fields]}

    def image(df: DataFrame, name: str) -> DataFrame:
        parts = [
            (F.col(c) if c in df.columns else F.lit(None).cast(types[c])).alias(c) for c in columns
        ]
        return df.select(*[F.col(k).alias(f"__{name}_{k}") for k in keys], F.struct(*parts).alias(name))

    def image_of(name: str) -> Column:
        return F.struct(*[comparable(F.col(name)[c], kinds[c]) for c in columns])

    left, right = image(old, "old"), image(new, "new")
    condition = F.lit(True)
    for k in keys:
        left_key, right_key = F.col(f"__old_{k}"), F.col(f"__new_{k}")
        condition = condition & (left_key.eqNullSafe(right_key) if null_safe else left_key == right_key)
    both = left.join(right, condition, "full_outer")

    def change(kind: str, name: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(name).alias("row"))

    changes = (
        F.when(F.col("old").isNull(), F.array(change("insert", "new")))
        .when(F.col("new").isNull(), F.array(change("delete", "old")))
        .when(
            ~image_of("old").eqNullSafe(image_of("new")),
            F.array(change("update_preimage", "old"), change("update_postimage", "new")),
        )
    )
    return both.select(F.explode(changes).alias("c")).select("c.row.*", "c._change_type")


def cluster_by(df: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """Rows in ranges of ``column``, sorted within each file.

    Files are split by sampled ranges of (column, row digest), so they stay
    even when very many rows share one value, and the narrow min/max statistics
    of each file let readers skip it.
    """
    bounds = [F.col(column), row_digest(df, [column])]
    ranged = df.repartitionByRange(partitions, *bounds) if partitions else df.repartitionByRange(*bounds)
    return ranged.sortWithinPartitions(column)
