"""The schema of a growing source, from its new files only.

Below the store's folder:

* ``version=K``: schemas, one whenever it changed,
* ``files/run=N``: the files a run has read (path, length, time of change); written last, it commits the run,
* ``fields/run=N``: what these files say about every field, as bits of the kinds of value met.

Bits of all runs are joined by OR, so files are read once, runs merge in any order, and types only widen:
boolean; int, long, double; and string, which holds everything, whatever is mixed. Objects and lists are text unless a hint gives their
type. A field that only ever was null has no type and no column yet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.sources.jsonlines import apply_hints, load_schema, save_schema
from parley.sources.tables import next_version, versions

BOOLEAN, INT, LONG, DOUBLE, STRING, NESTED = (1 << i for i in range(6))
FILE = "path string, modificationTime timestamp, length long"


def kind_of(value: Column) -> Column:
    """The bit of a variant value; 0 for null."""
    kind = F.schema_of_variant(value)
    whole = F.try_variant_get(value, "$", "bigint")
    return (
        F.when(kind == "VOID", 0).when(kind == "BOOLEAN", BOOLEAN)
        .when(kind == "BIGINT", F.when(whole.between(-(1 << 31), (1 << 31) - 1), INT).otherwise(LONG))
        .when(kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), DOUBLE)
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), NESTED)
        .otherwise(STRING)
    )


def type_of(bits: int) -> T.DataType | None:
    """The narrowest type that holds all kinds met."""
    if bits == 0:
        return None
    if bits == BOOLEAN:
        return T.BooleanType()
    if bits & (BOOLEAN | STRING | NESTED):
        return T.StringType()
    return T.DoubleType() if bits & DOUBLE else T.LongType() if bits & LONG else T.IntegerType()


def field_kinds(lines: DataFrame) -> DataFrame:
    """``field, bits`` over JSON lines (``value``): one aggregate, reduced per task. Lines that are no objects say nothing."""
    parsed = lines.select(F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>").alias("fields"))
    return parsed.select(F.explode("fields").alias("field", "v")).select("field", kind_of(F.col("v")).alias("bits")).groupBy("field").agg(
        F.bit_or("bits").alias("bits"))


class SchemaStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _runs(self) -> list[int]:
        return versions(self.spark, f"{self.root}/files", "run")

    def _state(self, kind: str, schema: str) -> DataFrame | None:
        done = self._runs()
        reader = self.spark.read.schema(f"{schema}, run long").option("basePath", f"{self.root}/{kind}")
        return reader.parquet(*[f"{self.root}/{kind}/run={n}" for n in done]) if done else None

    def versions(self) -> list[int]:
        return versions(self.spark, self.root)

    def schema(self, version: int | None = None) -> T.StructType:
        """A version, the newest by default."""
        return load_schema(self.spark, f"{self.root}/version={self.versions()[-1] if version is None else version}")

    def new_files(self, path: str) -> DataFrame:
        """Files below ``path`` that no run has read as they are now. Only the listing is read."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "modificationTime", "length")
        read = self._state("files", FILE)
        return listed if read is None else listed.join(read, ["path", "modificationTime", "length"], "left_anti")

    def update(self, path: str, hints: str = "", sampling_ratio: float = 1.0) -> T.StructType:
        """The schema after the new files below ``path``; a changed one becomes the next version.

        A ratio below 1 reads a share of their lines.
        """
        new = self.new_files(path).persist()
        try:
            wanted = [r.path for r in new.select("path").collect()]  # the paths a reader needs anyway
            if wanted:
                done = self._runs()
                run = done[-1] + 1 if done else 0
                lines = self.spark.read.text(wanted)
                if sampling_ratio < 1:
                    lines = lines.sample(sampling_ratio)
                field_kinds(lines).write.mode("overwrite").parquet(f"{self.root}/fields/run={run}")
                new.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/files/run={run}")
        finally:
            new.unpersist()
        return self._derived(hints)

    def _derived(self, hints: str) -> T.StructType:
        told = self._state("fields", "field string, bits int")
        fields = [] if told is None else told.groupBy("field").agg(F.bit_or("bits").alias("bits"), F.min("run").alias("run")).collect()
        # Fields keep their place; later ones follow by run and name.
        found = [T.StructField(r.field, type_of(r.bits)) for r in sorted(fields, key=lambda r: (r.run, r.field)) if r.bits]
        schema = apply_hints(T.StructType(found), hints) if hints else T.StructType(found)
        if self.versions():
            old = self.schema()
            place = {f.name: i for i, f in enumerate(old.fields)}
            schema = T.StructType(sorted(schema.fields, key=lambda f: place.get(f.name, len(place))))
            if schema == old:
                return old
        save_schema(self.spark, schema, f"{self.root}/version={next_version(self.spark, self.root)}")
        return schema

    def append(self, rows: DataFrame, table: str) -> None:
        """Add rows of the newest schema to a table that keeps every schema's rows in a folder of their own."""
        rows.write.mode("append").parquet(f"{table}/schema={self.versions()[-1]}")

    def read(self, table: str) -> DataFrame:
        """All rows of such a table in the newest schema: older ones are widened, fields they lack are null."""
        newest, out = self.schema(), None
        for version in versions(self.spark, table, "schema"):
            own = self.spark.read.parquet(f"{table}/schema={version}")
            known = set(own.columns)
            extra = [c for c in own.columns if c not in newest.names]
            part = own.select(*[
                (F.col(f"`{f.name}`").cast(f.dataType) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name) for f in newest.fields
            ], *extra)
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        if out is None:
            raise FileNotFoundError(f"nothing stored below {table}")
        return out
