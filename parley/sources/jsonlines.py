"""JSON-line files as batch or stream, with hints, evolution and rejects."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.text import json_to_map

CORRUPT = "_rescued_data"


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of ``paths`` that exist, on any file system Spark can reach."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).exists(p):
            out.append(path)
    return out


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Text lines as ``value`` with ``_metadata``; files that vanish are skipped."""
    return (
        spark.read.option("ignoreMissingFiles", True)
        .option("recursiveFileLookup", True)
        .text([paths] if isinstance(paths, str) else list(paths))
        .select("value", "_metadata")
    )


def apply_hints(schema: T.StructType, hints: str) -> T.StructType:
    """Replace the types of hinted fields (any case), and add those not there."""
    hinted = {f.name.lower(): f for f in T.StructType.fromDDL(hints).fields}
    fields = [
        T.StructField(f.name, hinted.pop(f.name.lower()).dataType, f.nullable) if f.name.lower() in hinted else f
        for f in schema.fields
    ]
    return T.StructType(fields + list(hinted.values()))


def infer_schema(spark: SparkSession, path: str, hints: str = "", sampling_ratio: float = 1.0) -> T.StructType:
    """Schema of JSON files with hints laid over it.

    A ratio below 1 reads a share of the lines; rare fields may then show up
    in a later run, where :func:`evolve_schema` adds them.
    """
    schema = (
        spark.read.option("samplingRatio", sampling_ratio).option("recursiveFileLookup", True).json(path).schema
    )
    return apply_hints(schema, hints) if hints else schema


def evolve_schema(stored: T.StructType, found: T.StructType) -> T.StructType:
    """``stored`` plus the fields of ``found`` it lacks; known types stay."""
    known = {f.name.lower() for f in stored.fields}
    return T.StructType(stored.fields + [f for f in found.fields if f.name.lower() not in known])


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """Keep a schema as one JSON line in a new folder."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(path).head()[0]))


def stored_schema(spark: SparkSession, path: str, store: str, hints: str = "", sampling_ratio: float = 1.0) -> T.StructType:
    """Schema of a source that may gain columns and widen types, kept below ``store``.

    Only files that no run has read yet are read; see :mod:`parley.sources.schema_store`.
    """
    from parley.sources.schema_store import SchemaStore

    return SchemaStore(spark, store).update(path, hints, sampling_ratio)


def parse_events(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of ``schema`` from JSON text in ``value``; other columns stay.

    ``_rescued_data`` holds what these fields cannot: the whole text if it is
    not an object or a value has a wrong type, else the undeclared fields as a
    JSON object. Names match exactly. Blank lines are no events.
    """
    wanted = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    names = [f.name for f in schema.fields]
    others = [c for c in lines.columns if c != "value"]
    parsed = lines.where(F.trim("value") != "").withColumns({
        "__event": F.from_json("value", wanted, options),
        "__rest": F.map_filter(json_to_map("value"), lambda k, _: ~k.isin(*names)),
    })
    rescued = F.coalesce(F.col("__event")[CORRUPT], F.when(F.size("__rest") > 0, F.to_json("__rest")))
    return parsed.select(*[F.col("__event")[n].alias(n) for n in names], rescued.alias(CORRUPT), *others)


def read_events(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """JSON events of files with ``_rescued_data`` (see :func:`parse_events`) and ``_metadata``."""
    paths = [path] if isinstance(path, str) else list(path)
    return parse_events(spark.read.option("recursiveFileLookup", True).text(paths).select("value", "_metadata"), schema)


def stream_events(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int = 1000
) -> DataFrame:
    """JSON files below ``path`` as a stream; ``_metadata`` also as ``row_created_metadata``.

    The source is text, so a schema that has grown continues the same checkpoint.
    """
    lines = (
        spark.readStream.option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files_per_trigger).text(path)
        .select("value", "_metadata", F.col("_metadata").alias("row_created_metadata"))
    )
    return parse_events(lines, schema)


def _fits(value: Column, kind: T.DataType) -> tuple[Column, Column]:
    """A variant as a typed value, and whether it is null or has the type's own JSON kind."""
    typed = F.try_variant_get(value, "$", kind.simpleString())
    shape = F.schema_of_variant(value)
    if isinstance(kind, T.StringType):
        return typed, F.lit(True)
    if isinstance(kind, T.BooleanType):
        own = shape == "BOOLEAN"
    elif isinstance(kind, T.IntegralType):
        own = shape == "BIGINT"
    elif isinstance(kind, (T.FractionalType, T.DecimalType)):
        own = shape.isin("BIGINT", "DOUBLE", "FLOAT") | shape.startswith("DECIMAL")
    elif isinstance(kind, (T.MapType, T.StructType)):
        own = shape.startswith("OBJECT")
    elif isinstance(kind, T.ArrayType):
        own = shape.startswith("ARRAY")
    else:
        own = shape == "STRING"  # dates and times
    fits = value.isNull() | (shape == "VOID") | F.coalesce(own & typed.isNotNull(), F.lit(False))
    return F.when(fits, typed), fits


def rescue_events(lines: DataFrame, schema: T.StructType, file_path: Column | None = None) -> DataFrame:
    """The fields of ``schema`` from JSON text in ``value``, rescued field by field; other columns stay.

    Each line is parsed once, into a variant. A field whose value does not have its type is null and goes, as it
    stands, into the JSON object ``_rescued_data``, with undeclared fields and the file's path (``_file_path``) if given;
    the line's other fields keep their columns. A line that is no JSON object goes there as ``_line``.
    Lines without anything to rescue have none. Names match exactly. Blank lines are no events.
    """
    others = [c for c in lines.columns if c != "value"]
    path = {} if file_path is None else {"__path": file_path}
    read = lines.where(F.trim("value") != "").withColumns({**path, "__fields": F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>")})
    typed = {f.name: _fits(F.col("__fields")[f.name], f.dataType) for f in schema.fields}
    names = F.array(*[F.lit(n) for n in typed]) if typed else F.array().cast("array<string>")
    bad = F.array_compact(F.array(*[F.when(~fits, F.lit(n)) for n, (_, fits) in typed.items()])) if typed else names
    rest = F.map_filter("__fields", lambda k, _: ~F.array_contains(names, k) | F.array_contains(bad, k))
    rest = F.coalesce(rest, F.create_map(F.lit("_line"), F.col("value").cast("variant")))
    if file_path is not None:
        told = F.map_concat(rest, F.create_map(F.lit("_file_path"), F.col("__path").cast("variant")))
    else:
        told = rest
    return read.select(
        *[value.alias(n) for n, (value, _) in typed.items()],
        F.when(F.size(rest) > 0, F.to_json(told)).alias(CORRUPT), *others)
