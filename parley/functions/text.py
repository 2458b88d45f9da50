"""Parsing of JSON and key=value text, digests and path parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layout of hour folders.
HOUR_FOLDER = r"y=(\d{4})/m=(\d{2})/d=(\d{2})/h=(\d{2})(?:/m=(\d{2}))?"
HOUR_FOLDER_FORMAT = "'y='yyyy'/m='MM'/d='dd'/h='HH'/m=00'"
OUTSTANDING_FILES = r'numFilesOutstanding"?\s*[=:]\s*"?(\d+)'


def json_to_map(column: Column | str) -> Column:
    """JSON object to a string map; nested values stay JSON text, bad input is missing."""
    return F.from_json(column, "MAP<STRING,STRING>")


def json_nested_map(column: Column | str, key: str) -> Column:
    """Nested object ``key`` of a JSON text as a string map."""
    return F.from_json(json_to_map(column)[key], "MAP<STRING,STRING>")


def kv_text_to_map(column: Column | str, value_type: str = "string") -> Column:
    """``{a=1, b=2}`` (how the JVM prints a map) to a map; the last of equal keys counts.

    Values that hold a comma or an equals sign cannot be told apart in this
    format; where the source is JSON use :func:`json_to_map`.
    """
    col = F.col(column) if isinstance(column, str) else column
    bare = F.regexp_replace(col, r"[{}]", "")
    pairs = F.filter(F.split(bare, ","), lambda p: F.trim(p) != "")
    entries = F.transform(
        pairs,
        lambda p: F.struct(
            F.trim(F.split_part(p, F.lit("="), F.lit(1))).alias("k"),
            F.when(F.contains(p, F.lit("=")), F.split_part(p, F.lit("="), F.lit(2))).alias("v"),
        ),
    )
    names = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    values = F.transform(
        names,
        lambda n: F.element_at(F.filter(entries, lambda e: e["k"] == n), -1)["v"].try_cast(value_type),
    )
    return F.map_from_arrays(names, values)


def extract_int(column: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern`` as an integer; missing when there is none."""
    return F.regexp_extract(column, pattern, group).try_cast("int")


def line_key(column: Column | str) -> Column:
    """Surrogate key of a text line."""
    return F.md5(column)


def partition_key(path: Column | str) -> Column:
    """``yyyymmddHHMM`` of the hour folder a file lies in."""
    parts = [F.regexp_extract(path, HOUR_FOLDER, i) for i in range(1, 6)]
    minute = F.when(parts[4] == "", F.lit("00")).otherwise(parts[4])
    return F.when(F.rlike(path, F.lit(HOUR_FOLDER)), F.concat(*parts[:4], minute))


def source_folder(path: Column | str) -> Column:
    """``yyyy-mm-dd:HH`` of the hour folder a file lies in; sorts by time."""
    year, month, day, hour = (F.regexp_extract(path, HOUR_FOLDER, i) for i in range(1, 5))
    return F.when(
        F.rlike(path, F.lit(HOUR_FOLDER)),
        F.concat(F.concat_ws("-", year, month, day), F.lit(":"), hour),
    )
