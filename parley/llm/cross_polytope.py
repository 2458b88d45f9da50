"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by a pseudo-rotation (three rounds of random signs and
a fast Hadamard transform) and assigned to the nearest signed axis. Each of
``TABLES`` tables uses rotations of its own; its key is the axis of
``AXES_PER_KEY`` rotations in turn. Every vector is stored once per table. A
query looks into the likeliest keys of each table (the share ``PROBES`` of the
axes, ``UNEVEN_PROBES`` where lengths differ), that is the combinations of axes with the largest sum of its rotated
coordinates, and the candidates found are scored exactly on the original vectors.

The nearness is the inner product, so vectors of different lengths are dealt to ranges of length, each up to ``RANGE``
times the next, and hashed with one more component that gives a vector the upper end of its range; a query gets 0 there. So
one very long vector does not flatten the others. Where all lengths are equal the component would be 0 and is left out.

A query for which the buckets give fewer rows than are due is compared with all vectors, in blocks; so are all queries of
a table of at most ``FEW`` times k vectors, of which the k nearest are a large part and lie in all directions.

Buckets are packed into chunks of bounded size, as are the queries that look
into them; the join on the key pairs chunks, not vectors, so a bucket that
holds a third of the table is many rows of bounded size. A task returns at most
k rows per query for all pairs of chunks it meets. Every vector is indexed; nothing is capped.

Defaults are for vectors without any structure, where the twentieth neighbour
has a cosine of 0.2 to 0.4 and hashing saves little; recall against brute force is
measured in the tests. Larger tables of clustered vectors want ``axes_per_key`` 2.

Vectors that are null, zero, or hold a null, NaN or infinite component, vectors
of another number of components than most (of equally many the greater), and rows without id take no part, for no inner
product with the others exists. Of rows with equal ids the smallest vector counts. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import small_batches, table
from parley.staging import stage

TABLES, PROBES, AXES_PER_KEY = 4, 0.28, 1
CHUNK, QUERY_CHUNK = 1024, 512
#: Ratio of the ends of a range of lengths.
RANGE = 1.25
#: Share of the axes that is probed where lengths differ: long neighbours lie at wider angles.
UNEVEN_PROBES = 0.36
FEW = 8
#: Rows that a task gathers before it keeps the best of them.
GATHERED = 500_000

RESULT = "query_id long, rank int, vec_id long, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """The rows after a pseudo-rotation fixed by ``seed``."""
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], size=(3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return x


def padded(x: np.ndarray, extra: np.ndarray | None) -> np.ndarray:
    """Rows with one more component, if given, and zeros up to a power of two."""
    used = x.shape[1] + (extra is not None)
    out = np.zeros((len(x), 1 << (used - 1).bit_length()))
    out[:, : x.shape[1]] = x
    if extra is not None:
        out[:, x.shape[1]] = extra
    return out


def signed_axes(x: np.ndarray) -> np.ndarray:
    """Coordinates along all signed axes."""
    return np.concatenate([x, -x], axis=1)


def keys(x: np.ndarray, tables: int, axes: int) -> np.ndarray:
    """Key of each padded row in each table."""
    out = np.zeros((len(x), tables), np.int64)
    for t in range(tables):
        for a in range(axes):
            y = signed_axes(rotated(x, 1000 * t + a))
            out[:, t] = out[:, t] * y.shape[1] + y.argmax(axis=1)
    return out


def probes(x: np.ndarray, tables: int, axes: int, share: float) -> np.ndarray:
    """The likeliest keys of each padded row in each table, as many as ``share`` of the axes."""
    out = []
    n = max(1, round(share * 2 * x.shape[1]))
    for t in range(tables):
        best, key = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
        for a in range(axes):
            y = signed_axes(rotated(x, 1000 * t + a))
            top = np.argsort(-y, axis=1, kind="stable")[:, :n]
            best = (best[:, :, None] + np.take_along_axis(y, top, 1)[:, None]).reshape(len(x), -1)
            key = (key[:, :, None] * y.shape[1] + top[:, None]).reshape(len(x), -1)
            keep = np.argsort(-best, axis=1, kind="stable")[:, :n]
            best, key = np.take_along_axis(best, keep, 1), np.take_along_axis(key, keep, 1)
        out.append(key)
    return np.stack(out, axis=1)


def beyond(x: np.ndarray) -> np.ndarray:
    """The component that gives each row the upper end of its range of lengths."""
    square = (x**2).sum(axis=1)
    end = RANGE ** np.ceil(np.log(square) / (2 * np.log(RANGE)) - 1e-9)
    return np.sqrt(np.maximum(0.0, end**2 - square))


def _hashed(vectors: DataFrame, uneven: bool, tables: int, axes: int, share: float | None = None) -> DataFrame:
    """``id, vector, table, key``: a row per table, or with ``share`` per table and key to look into."""

    @F.pandas_udf("array<array<long>>")
    def placed(batch: pd.Series) -> pd.Series:
        x = np.array(batch.tolist(), float)
        extra = None
        if uneven:
            extra = np.zeros(len(x)) if share else beyond(x)
        wide = padded(x, extra)
        found = probes(wide, tables, axes, share) if share else keys(wide, tables, axes)[:, :, None]
        return pd.Series([list(x) for x in found], dtype=object)

    by_table = vectors.select("id", "vector", F.posexplode(placed("vector")).alias("table", "keys"))
    return by_table.select("id", "vector", "table", F.explode("keys").alias("key"))


def _chunked(rows: DataFrame, size: int, name: str) -> DataFrame:
    """One row per chunk of a bucket: ``table, key`` and arrays of ids and vectors."""
    counts = rows.groupBy("table", "key").agg(F.ceil(F.count("*") / size).alias("chunks"))
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks"))
    packed = rows.join(counts, ["table", "key"]).groupBy("table", "key", chunk.alias("chunk")).agg(F.collect_list(F.struct("id", "vector")).alias("m"))
    return packed.select("table", "key", F.col("m.id").alias(f"{name}_ids"), F.flatten("m.vector").alias(f"{name}_values"))


def _blocks(rows: DataFrame, queries: DataFrame, count: int) -> DataFrame:
    """``query_ids, query_values, doc_ids, doc_values``: chunks of queries beside all chunks of rows."""
    shards = -(-count // CHUNK)
    asked = -(-queries.count() // QUERY_CHUNK)

    def packed(df, size, name):
        chunk = F.pmod(F.xxhash64("id"), F.lit(size)).alias("chunk")
        m = df.groupBy(chunk).agg(F.collect_list(F.struct("id", "vector")).alias("m"))
        return m.select("chunk", F.col("m.id").alias(f"{name}_ids"), F.flatten("m.vector").alias(f"{name}_values"))

    left = packed(queries, asked, "query").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>")))
    return left.join(packed(rows, shards, "doc"), "chunk").drop("chunk")


def nearest(
    vectors: DataFrame, is_query: Column, k: int, tables: int = TABLES, probe_share: float | None = None, axes: int = AXES_PER_KEY,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` (``id``, ``vector``) that are queries."""
    spark = vectors.sparkSession
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = vectors.select("id", F.col("vector").cast("array<double>").alias("vector")).filter(F.col("id").isNotNull() & finite)
    rows = stage(rows.groupBy("id").agg(F.min("vector").alias("vector")), "ann-vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    widths = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"), F.max(square).alias("longest"), F.min(square).alias("shortest"))
    usual = widths.orderBy(F.desc("n"), F.desc("width")).first()
    if usual is None:
        return spark.createDataFrame([], RESULT)
    # Chunks are large rows; few of them make a batch.
    small_batches(spark, 64)
    rows = rows.filter(F.size("vector") == usual.width)
    queries = rows.filter(is_query)
    uneven = usual.longest - usual.shortest > 1e-6 * usual.longest
    share = probe_share or (UNEVEN_PROBES if uneven else PROBES)

    def best(out):
        a, b, s = (np.concatenate(x) for x in zip(*out))
        order = np.lexsort((b, -s, a))
        a, b, s = a[order], b[order], s[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]  # a candidate met in two tables has one score
        a, b, s = a[new], b[new], s[new]
        first = np.arange(len(a)) - np.searchsorted(a, a) < k
        return a[first], b[first], s[first]

    def score(batches):
        out, gathered = [], 0
        for batch in batches:
            for q_ids, q, d_ids, d in batch.itertuples(index=False):
                q_ids, d_ids = np.asarray(q_ids, np.int64), np.asarray(d_ids, np.int64)
                q, d = np.asarray(q, float).reshape(len(q_ids), -1), np.asarray(d, float).reshape(len(d_ids), -1)
                by_id = np.argsort(d_ids)
                d_ids, d = d_ids[by_id], d[by_id]
                # Rounding makes equal vectors tie; of ties the stable sort keeps the smaller ids.
                close = np.round(q @ d.T, 12)
                close[q_ids[:, None] == d_ids[None]] = -np.inf
                if len(d_ids) > 4 * k:
                    limit = -np.partition(-close, k - 1, axis=1)[:, k - 1 : k]
                    i, j = np.nonzero((close >= limit) & (close > -np.inf))
                    order = np.lexsort((j, -close[i, j], i))
                    i, j = i[order], j[order]
                    first = np.arange(len(i)) - np.searchsorted(i, i) < k
                    i, j = i[first], j[first]
                else:
                    i, j = np.nonzero(close > -np.inf)
                out.append((q_ids[i], d_ids[j], (q[i] * d[j]).sum(axis=1)))
                gathered += len(i)
                if gathered > GATHERED:
                    out = [best(out)]
                    gathered = len(out[0][0])
                    if gathered > GATHERED / 2:
                        yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), out.pop())))
                        gathered = 0
        if out:
            yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), best(out))))

    def ranked(pairs: DataFrame) -> DataFrame:
        # A candidate met in several tables has one score.
        found = pairs.mapInPandas(score, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    if usual.n <= FEW * k:
        return ranked(_blocks(rows, queries, usual.n))
    index = _chunked(_hashed(rows, uneven, tables, axes), CHUNK, "doc")
    asked = _chunked(_hashed(queries, uneven, tables, axes, share), QUERY_CHUNK, "query")
    found = stage(ranked(asked.join(index, ["table", "key"]).select("query_ids", "query_values", "doc_ids", "doc_values")), "ann-found")
    enough = found.filter(F.col("rank") == min(k, usual.n - 1)).select(F.col("query_id").alias("id"))
    short = stage(queries.join(enough, "id", "left_anti"), "ann-short")
    if short.isEmpty():
        return found
    whole = ranked(_blocks(rows, short, usual.n))
    return found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(whole)


def op9_nearest(spark, sf_dir):
    """The 20 nearest vectors found of every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return nearest(vectors, F.col("id") % 20 == 0, 20)
