"""A table kept per group, where late rows recompute their groups only.

A *group* is what must be computed as a whole, such as a conversation's day.
Every delivery N of source rows writes three folders:

* ``source/batch_id=N/<day>``: the rows as delivered,
* ``rows/batch_id=N/<day>``: the results of all groups the delivery touched,
* ``touched/batch_id=N``: these groups. It is written last and commits the delivery.

The results of a group are those of the last delivery that touched it, even if
that left none. A repeated delivery with the same number replaces its folders.
Source and results are partitioned by day, so a delivery reads the days it
touches, and ``compact`` folds deliveries into a base. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.operators.latest import newest_of_repeated
from parley.sources.tables import versions

BATCH = "batch_id"


class GroupStore:
    """Where the folders are and what identifies a group and a source row.

    ``group`` starts with the day column. ``row_key`` and ``sequence`` pick the newest of
    source rows delivered more than once; rows without a key are all kept.
    """

    def __init__(
        self, spark: SparkSession, root: str, group: Sequence[str], source: T.StructType, result: T.StructType,
        row_key: Sequence[str], sequence: Sequence[str] = (),
    ):
        self.spark, self.root, self.group, self.day = spark, root, list(group), group[0]
        self.source, self.result = source, result
        self.row_key, self.sequence = list(row_key), list(sequence)
        self.groups = T.StructType([source[c] for c in self.group])

    def deliveries(self) -> list[int]:
        """Committed deliveries."""
        return versions(self.spark, f"{self.root}/touched", BATCH)

    def _write(self, df: DataFrame, kind: str, number: int, name: str = BATCH) -> None:
        # Static: what a failed run left in other days' folders goes too.
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(self.day).parquet(
            f"{self.root}/{kind}/{name}={number}")

    def _read(self, kind: str, schema: T.StructType, numbers: Sequence[int], name: str = BATCH) -> DataFrame:
        full = T.StructType([*schema.fields, T.StructField(name, T.LongType())])
        reader = self.spark.read.schema(full).option("basePath", f"{self.root}/{kind}")
        paths = [f"{self.root}/{kind}/{name}={n}" for n in numbers]
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], full)

    def _since(self, upto: int | None) -> tuple[int | None, list[int]]:
        """The newest base not beyond ``upto``, and the deliveries after it."""
        bases = [n for n in versions(self.spark, f"{self.root}/base-rows") if upto is None or n <= upto]
        base = bases[-1] if bases else None
        later = [n for n in self.deliveries() if (base is None or n > base) and (upto is None or n <= upto)]
        return base, later

    def _source(self, upto: int) -> DataFrame:
        """Source rows up to a delivery; the delivery itself need not be committed."""
        base, later = self._since(upto)
        numbers = sorted({*later, *([] if base == upto else [upto])})
        rows = self._read("source", self.source, numbers)
        if base is not None:
            folded = self._read("base-source", self.source, [base], "version")
            rows = rows.unionByName(folded.withColumnRenamed("version", BATCH))
        return rows

    def affected(self, touched: DataFrame, upto: int) -> DataFrame:
        """All source rows of the touched groups, each row once.

        The days are listed first: they become partition filters, so other days' folders are not even opened.
        """
        days = [r[0] for r in touched.select(self.day).distinct().collect()]
        rows = self._source(upto).where(F.col(self.day).isin(days)).join(touched, self.group, "left_semi")
        return newest_of_repeated(rows, self.row_key, [*self.sequence, BATCH]).select(*self.source.names)

    def deliver(self, rows: DataFrame, compute: Callable[[DataFrame], DataFrame], number: int | None = None) -> int:
        """Store a delivery and recompute the groups it touches; returns its number.

        ``compute`` maps the source rows of whole groups to their results, which hold the group's columns.
        Rows without a group are left out.
        """
        if number is None:
            done = self.deliveries()
            number = done[-1] + 1 if done else 0
        known = [F.col(c).isNotNull() for c in self.group]
        for condition in known:
            rows = rows.where(condition)
        self._write(rows.select(*[F.col(f.name).cast(f.dataType) for f in self.source.fields]), "source", number)
        touched = self._read("source", self.source, [number]).select(*self.group).distinct()
        results = compute(self.affected(touched, number))
        self._write(results.select(*[F.col(f.name).cast(f.dataType) for f in self.result.fields]), "rows", number)
        touched.write.mode("overwrite").parquet(f"{self.root}/touched/{BATCH}={number}")
        return number

    def read(self, upto: int | None = None, days: tuple[object, object] | None = None) -> DataFrame:
        """Results with the ``batch_id`` that computed them, as of a delivery (default: now), of a range of days (inclusive)."""
        base, later = self._since(upto)
        owners = self._read("touched", self.groups, later)
        rows = self._read("rows", self.result, later)
        folded = self._read("base-rows", T.StructType([*self.result.fields, T.StructField(BATCH, T.LongType())]), [] if base is None else [base], "version")
        if days is not None:
            owners, rows, folded = (x.where(F.col(self.day).between(*map(F.lit, days))) for x in (owners, rows, folded))
        owners = owners.groupBy(*self.group).agg(F.max(BATCH).alias(BATCH))
        current = rows.join(owners, [*self.group, BATCH], "left_semi")
        kept = folded.drop("version").join(owners, self.group, "left_anti")
        return current.unionByName(kept).select(*self.result.names, BATCH)

    def compact(self, upto: int) -> None:
        """Fold the deliveries up to one into a base, which later readers use instead."""
        if upto not in self.deliveries():
            raise ValueError(f"delivery {upto} is not committed")
        source = newest_of_repeated(self._source(upto), self.row_key, [*self.sequence, BATCH])
        self._write(source.select(*self.source.names), "base-source", upto, "version")
        self._write(self.read(upto), "base-rows", upto, "version")
