"""A keyed table in hash buckets: a merge reads and rewrites the buckets it touches.

``data/_bucket=B/_generation=V`` holds bucket B as merge V left it, bucketed and sorted by the keys in
Spark's own way, so a join of the table with changes dealt to the same buckets moves the changes only.
Folders of a merge:

* ``attempts/version=V`` takes the number, so that a failed merge's files are never taken for another's,
* ``loose/version=V``: rows without a key, which match nothing and are appended,
* ``metrics/version=V``: what the merge did,
* ``commits/version=V``: the buckets it replaced. It is written last and commits the merge.

The table as of V is, for each bucket, its newest generation up to V. The number of buckets bounds what the
driver gets from any step. One writer at a time; ``compact`` puts all buckets into one generation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.operators.latest import any_key_null, comparable, newest_per_key
from parley.operators.upsert import table_diff
from parley.sources.jsonlines import existing_paths
from parley.sources.tables import next_version, versions
from parley.staging import stage

BUCKET, GENERATION = "_bucket", "_generation"
OUTCOMES = ("inserted", "updated", "unchanged", "copied")


class BucketTable:
    """``schema`` with unique ``keys``; of two rows of a key the greater ``sequence`` wins."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], sequence: Sequence[str], buckets: int):
        self.spark, self.root, self.schema, self.buckets = spark, root, schema, buckets
        self.keys, self.sequence = list(keys), list(sequence)
        self.name = f"buckets_{hashlib.md5(root.encode()).hexdigest()[:16]}"
        if not spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            by = ", ".join(f"`{k}`" for k in self.keys)
            spark.sql(
                f"CREATE TABLE {self.name} ({columns}, {BUCKET} INT, {GENERATION} BIGINT) USING parquet PARTITIONED BY ({BUCKET}, {GENERATION}) "
                f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{root}/data'")
            if existing_paths(spark, [f"{root}/data"]):
                spark.catalog.recoverPartitions(self.name)

    def bucket_of(self) -> Column:
        """The bucket of a row, as Spark numbers buckets."""
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets)).cast("int")

    def committed(self, upto: int | None = None) -> list[int]:
        return [v for v in versions(self.spark, f"{self.root}/commits") if upto is None or v <= upto]

    def generations(self, upto: int | None = None) -> dict[int, int]:
        """The newest generation of each bucket that has one."""
        done = self.committed(upto)
        if not done:
            return {}
        listed = self.spark.read.schema(f"{BUCKET} int, version bigint").option("basePath", f"{self.root}/commits")
        rows = listed.parquet(*[f"{self.root}/commits/version={v}" for v in done]).groupBy(BUCKET).agg(F.max("version")).collect()
        return {bucket: version for bucket, version in rows}

    def scan(self, generations: dict[int, int]) -> DataFrame:
        """The buckets named, as a bucketed scan of their folders alone."""
        by_version: dict[int, list[int]] = {}
        for bucket, version in generations.items():
            by_version.setdefault(version, []).append(bucket)
        wanted = F.lit(False)
        for version, found in sorted(by_version.items()):
            wanted = wanted | ((F.col(GENERATION) == version) & F.col(BUCKET).isin(sorted(found)))
        return self.spark.table(self.name).where(wanted).select(*self.schema.names)

    def _loose(self, after: int, upto: int | None) -> DataFrame:
        found = [v for v in self.committed(upto) if v > after]
        if not found:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/loose/version={v}" for v in found])

    def read(self, upto: int | None = None) -> DataFrame:
        """The table as of a merge (default: now)."""
        return self.scan(self.generations(upto)).unionByName(self._loose(-1, upto))

    def joined(self, newest: DataFrame, touched: Sequence[int], guard: bool = True) -> DataFrame:
        """``row, outcome`` of every key of the touched buckets, given one change per key at most."""
        current = self.generations()
        stored = self.scan({b: current[b] for b in touched if b in current})
        changes = newest.repartition(self.buckets, *self.keys)
        names = self.schema.names
        left = stored.select(*self.keys, F.struct(*names).alias("old"))
        right = changes.select(*[F.col(k).alias(f"__{k}") for k in self.keys], F.struct(*names).alias("new"))
        same_key = F.lit(True)
        for k in self.keys:
            same_key = same_key & (F.col(k) == F.col(f"__{k}"))

        def image(side: str, columns: Sequence[str]) -> Column:
            return F.struct(*[comparable(F.col(side)[c], self.schema[c].dataType) for c in columns])

        both = F.col("old").isNotNull() & F.col("new").isNotNull()
        wins = image("new", self.sequence) >= image("old", self.sequence) if guard else F.lit(True)
        outcome = (
            F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), "copied")
            .when(both & wins & ~image("old", names).eqNullSafe(image("new", names)), "updated").otherwise("unchanged")
        )
        return left.join(right, same_key, "full_outer").withColumn("outcome", outcome).select(
            F.when(F.col("outcome").isin("inserted", "updated"), F.col("new")).otherwise(F.col("old")).alias("row"), "outcome")

    def merge(self, changes: DataFrame, guard: bool = True) -> int:
        """Merge changes; returns the number of the merge.

        ``guard``: a change older than the stored row loses. Of several changes of a key the newest counts.
        Keys are reduced before the only shuffle, and neither side repeats one, so no key is hot in the join.
        """
        spark, version = self.spark, next_version(self.spark, f"{self.root}/attempts")
        spark.range(1).write.parquet(f"{self.root}/attempts/version={version}")
        typed = changes.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        typed = stage(typed, "merge-input")
        newest = stage(newest_per_key(typed, self.keys, self.sequence, "drop").withColumn(BUCKET, self.bucket_of()), "merge-changes")
        touched = sorted(r[0] for r in newest.select(BUCKET).distinct().collect())
        known = len([b for b in self.generations() if b in set(touched)])
        seen, left_out = Observation(), Observation()
        counts = [F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES]
        rows = self.joined(newest, touched, guard).observe(seen, *counts).select("row.*")
        rows.withColumns({BUCKET: self.bucket_of(), GENERATION: F.lit(version).cast("bigint")}).write.mode("append").insertInto(self.name)
        typed.where(any_key_null(self.keys)).observe(left_out, F.count(F.lit(1)).alias("keyless")).write.mode("overwrite").parquet(f"{self.root}/loose/version={version}")
        self._commit(version, newest.select(BUCKET).distinct(), {**seen.get, **left_out.get, "buckets_read": known, "buckets_written": len(touched)})
        return version

    def _commit(self, version: int, replaced: DataFrame, figures: dict[str, int]) -> None:
        columns = [F.lit(figures.get(c, 0)).cast("bigint").alias(c) for c in (*OUTCOMES, "keyless", "buckets_read", "buckets_written")]
        self.spark.range(1).select(*columns).write.mode("overwrite").parquet(f"{self.root}/metrics/version={version}")
        replaced.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commits/version={version}")

    def metrics(self) -> DataFrame:
        """One row per committed merge: keys inserted, updated, unchanged (equal or older), copied along; rows without key; buckets."""
        done = self.committed()
        schema = ", ".join(f"{c} bigint" for c in ("version", *OUTCOMES, "keyless", "buckets_read", "buckets_written"))
        if not done:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/metrics")
        return reader.parquet(*[f"{self.root}/metrics/version={v}" for v in done])

    def change_feed(self, after: int, upto: int | None = None) -> DataFrame:
        """Changes of the merges after one up to another, as ``table_diff`` names them.

        Only buckets replaced in between are read, in their two generations; both scans lie in the same buckets, so nothing is shuffled.
        """
        old, new = self.generations(after), self.generations(upto)
        moved = [b for b, v in new.items() if old.get(b) != v]
        feed = table_diff(self.scan({b: old[b] for b in moved if b in old}), self.scan({b: new[b] for b in moved}), self.keys, null_safe=False)
        return feed.unionByName(self._loose(after, upto).withColumn("_change_type", F.lit("insert")))

    def compact(self) -> int:
        """Put all buckets into one new generation; returns its number. Rows without key stay where they are."""
        version = next_version(self.spark, f"{self.root}/attempts")
        self.spark.range(1).write.parquet(f"{self.root}/attempts/version={version}")
        current = self.generations()
        rows = self.scan(current).withColumns({BUCKET: self.bucket_of(), GENERATION: F.lit(version).cast("bigint")})
        rows.write.mode("append").insertInto(self.name)
        self.spark.createDataFrame([], self.schema).write.mode("overwrite").parquet(f"{self.root}/loose/version={version}")
        replaced = self.spark.createDataFrame([(b,) for b in current], f"{BUCKET} int")
        self._commit(version, replaced, {"buckets_read": len(current), "buckets_written": len(current)})
        return version
