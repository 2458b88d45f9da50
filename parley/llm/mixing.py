"""Mix sources to target weights by prefix sums over hash-random keys.

Each document gets a pseudo-random key. The key range of every source is cut
into equal ranges (*slices*); the size before a slice is a prefix sum over one
row per slice, and the size before a document is the slice's offset plus a
running sum inside the slice. Where the running total crosses the source's
budget the source is cut. Budgets above the source's size repeat it.

No task sees a whole source: a slice is one of ``slices`` equal parts of it.
Only tables of one row per source (targets) are ordered as a whole.

Empty cases: no documents give no rows; a null text has size 0; a null source
is a source of its own, ordered last; sources of size 0 get target 0. Repeated
rows share a key and follow each other; since they are equal, so is the result.
Input columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import kept_aside, partitions

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3


def word_count(text: Column) -> Column:
    """Number of runs without blanks; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size`` (a row per source) with ``target``.

    Sources in code-point order, null last, take the weights in turn and share
    the total size. A target stops at ``repeats`` times the source's size; the
    excess goes to the others by weight. With the sources ordered by cap per
    weight the capped ones come first: one is capped if its cap lies below the
    level that the rest would get without it.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn(
        "weight", F.element_at(cycle, (((F.row_number().over(by_name) - 1) % len(weights)) + 1).cast("int")).cast("long")
    ).withColumn("cap", F.col("source_size") * repeats)
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.col("cap_before")).cast("double") / (F.col("weights") - F.col("weight_before"))
    stepped = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", level)
        .withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    )
    # The first source that is not capped sets the level of all others.
    shared = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)
    return stepped.withColumn("shared", shared["level"]).select(
        "source", "source_size",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("shared") * F.col("weight")).alias("target"),
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = MAX_REPEATS, seed: str = "mix", slices: int | None = None,
) -> DataFrame:
    """All columns of ``docs`` (``doc_id, text, source`` needed) with the words each document gives.

    Added: ``size`` (words), ``source_size``, ``target`` (of its source), ``before`` (words of the
    source in front of the document), ``epochs`` (whole passes over the source) and ``rest`` (words
    taken in the last, partial pass).
    """
    slices = slices or 4 * partitions(docs.sparkSession)
    docs = docs.drop("size", "source_size", "target", "before", "epochs", "rest")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col("text"), F.lit(""))))
    keyed = (
        docs.withColumn("size", word_count(F.col("text")))
        .withColumn("_key", key)
        .withColumn("_slice", F.floor(F.conv(F.substring("_key", 1, 6), 16, 10).cast("long") * slices / F.lit(1 << 24)).cast("int"))
    )
    per_slice = keyed.groupBy("source", "_slice").agg(F.sum("size").alias("slice_size"))
    in_front = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(per_slice.groupBy("source").agg(F.sum("slice_size").alias("source_size")), weights, repeats)
    placed = (
        per_slice.withColumn("offset", F.coalesce(F.sum("slice_size").over(in_front), F.lit(0))).alias("p")
        .join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")))
        .select(F.col("p.source").alias("_source"), F.col("_slice").alias("_at"), "offset", "source_size", "target")
    )
    running = Window.partitionBy("source", "_slice").orderBy("_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    budget = F.floor(F.col("target") - F.col("epochs") * F.col("source_size"))
    return (
        keyed.join(placed, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_slice") == F.col("_at")))
        .withColumn("before", F.col("offset") + F.coalesce(F.sum("size").over(running), F.lit(0)))
        .withColumn("epochs", epochs)
        .withColumn("rest", F.greatest(F.lit(0), F.least(F.col("size"), budget - F.col("before"))).cast("long"))
        .drop("_key", "_slice", "_source", "_at", "offset")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: whole texts, one row per pass that takes the document.

    The document that the budget cuts is taken in the last pass if at least half of it lies inside, and also
    if the source would have no document at all without it.
    """
    taken = mix(kept_aside(docs, "doc_id", "text", "source"), **options)
    only = (F.col("epochs") == 0) & (F.col("before") == 0)
    copies = F.col("epochs") + F.when((F.col("rest") > 0) & ((2 * F.col("rest") >= F.col("size")) | only), 1).otherwise(0)
    # Texts without words cost nothing; they are kept once.
    copies = F.when(F.col("size") == 0, 1).otherwise(copies)
    return taken.select("_row", F.explode(F.array_repeat(F.lit(0), copies.cast("int")))).select("_row.*")


def op7_mix_sources(spark, sf_dir):
    """Words that the mix takes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    taken = F.col("epochs") * F.col("size") + F.col("rest")
    return mix(docs).select("doc_id", "size", "source_size", "target", taken.alias("taken"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), ''), ':', coalesce(text, ''))) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3) + 1] AS BIGINT) AS weight, source_size * 3 AS cap FROM s),
l AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS DOUBLE) AS level,
         CAST(cap AS DOUBLE) / CAST(weight AS DOUBLE) AS ratio
  FROM w WINDOW b AS (ORDER BY CAST(cap AS DOUBLE) / CAST(weight AS DOUBLE), source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         CASE WHEN cap <= level * weight THEN CAST(cap AS DOUBLE)
              ELSE (SELECT arg_min(level, ratio) FROM l WHERE NOT cap <= level * weight) * weight END AS target
  FROM l),
e AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS bef
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(floor(target - epochs * source_size) AS BIGINT) - bef)) AS BIGINT) AS taken
FROM e
"""
